"""Byte-level BPE by prefix dynamic programming.

For each byte prefix of a piece exactly one token can end its encoding. The table of those last tokens gives the
encoding by walking back; it grows by appending bytes, and after an edit only the entries near it change.
A token fits behind the last token of a shorter prefix if no merge across their border comes before the merges that
made the two (their borders are undone in the order of rank to find out).

Pieces that a worker doesn't know yet are encoded together: the tables of thousands of pieces grow place by place, by
walks in a trie of the tokens, and the borders that no piece had before are checked together as well. Single pieces,
long ones and PrefixTable use the same rule a token at a time.

Texts are split by the tokenizer's pattern, and each match is encoded separately. Ids travel packed, as little-endian
unsigned 32-bit integers. Defined cases: a null text is the empty text and has no ids; bytes that aren't UTF-8 are
read as U+FFFD; texts of any length are encoded whole, a bounded number of matches at a time; null ids decode to no
bytes. Input columns are kept, except that the result columns replace columns of the same names.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, claim, table, text_bytes

#: Units and matches whose ids a worker keeps, in each of two generations; results don't depend on it.
CACHE_UNITS = 300_000
#: Pairs of tokens for which a worker keeps whether they fit; a power of two.
CACHE_PAIRS = 1 << 19
#: Bytes of a piece that is encoded together with others, and pieces at a time.
SHORT, TOGETHER = 64, 16_384
#: Fewer pieces than this are encoded one by one.
FEW = 24
#: Characters of texts whose units are looked up together.
BLOCK_CHARS = 1 << 21
#: Characters of a unit that is cut into some matches at a time and not kept.
LONG = 1000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Pairs:
    """A fixed map from integers to integers, for arrays of keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot = self._slot(keys)
        while len(keys):  # the first of each slot takes it if it is free; the others go on to the next
            _, first = np.unique(slot, return_index=True)
            won = first[self.keys[slot[first]] < 0]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys, -1 for those that aren't there."""
        slot = self._slot(keys)
        held = self.keys[slot]
        hit = held == keys
        out = np.where(hit, self.values[slot], -1)
        (todo,) = np.nonzero(~hit & (held >= 0))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (held >= 0)
            todo, slot = todo[on], slot[on]
        return out


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        if any(bytes([b]) not in ranks for b in range(256)) or max(ranks[bytes([b])] for b in range(256)) > 255:
            raise ValueError("the 256 single bytes must have the lowest ranks")
        n = len(self.tokens)
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        #: the two tokens whose merge makes each one; -1 if no merges do, -2 as long as it isn't known
        self._halves = np.full((n, 2), -2, np.int64)
        self._halves[[ranks[bytes([b])] for b in range(256)]] = -3
        self._known, self._fit = np.full(CACHE_PAIRS, -1, np.int64), np.zeros(CACHE_PAIRS, bool)
        self._array = self._tables = None

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    # single pieces ------------------------------------------------------------------------------------------------

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None if no sequence of merges does."""
        a, b = self._halves[token].tolist()
        if a == -2:
            parts = [bytes([x]) for x in self.tokens[token]]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(x + y, token), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
                if rank >= token:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            a, b = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (-1, -1)
            self._halves[token] = a, b
        return (a, b) if a >= 0 else None

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side in an encoding."""
        if len(self.tokens[right]) > 1 and self.halves(right) is None:
            return False
        before = 1 << 31  # merges of a lower rank than this would have come first
        while True:
            if self.ranks.get(self.tokens[left] + self.tokens[right], before) < before:
                return False
            if max(left, right) < 256:
                return True
            if left > right:  # the left token was made last: go back to before its last merge
                before, left = left, self.halves(left)[1]
            else:  # merges go from left to right, so one of the same rank across the border would have come first
                before, right = right + 1, self.halves(right)[0]

    def last_tokens(self, data: bytes, last: list[int]) -> None:
        """Extend last, which has an entry for each shorter prefix, to all prefixes of data."""
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(end - 1, max(-1, end - self.longest - 1), -1):
                token = self.ranks.get(data[start:end])
                if token is not None and (self.fits(last[start - 1], token) if start else end == 1 or self.halves(token) is not None):
                    break
            last.append(token)

    def encode(self, data: bytes) -> list[int]:
        last: list[int] = []
        self.last_tokens(data, last)
        return self.walk_back(data, last)

    def walk_back(self, data: bytes, last: list[int]) -> list[int]:
        out, end, tokens = [], len(data), self.tokens
        while end:
            out.append(last[end - 1])
            end -= len(tokens[out[-1]])
        return out[::-1]

    # many pieces --------------------------------------------------------------------------------------------------

    def tables(self) -> tuple[_Pairs, np.ndarray, _Pairs]:
        """Edges of the trie of tokens by (node, byte), the token of each node, and tokens by their parts (a, b)."""
        if self._tables is None:
            nodes, n = {b"": 0}, len(self.tokens)
            keys, values = [], []
            for token in self.ranks:
                for k in range(1, len(token) + 1):
                    if token[:k] not in nodes:
                        nodes[token[:k]] = len(nodes)
                        keys.append(nodes[token[: k - 1]] << 8 | token[k - 1])
                        values.append(nodes[token[:k]])
            of = np.full(len(nodes), -1, np.int64)
            of[[nodes[t] for t in self.ranks]] = list(self.ranks.values())
            splits = [
                (a * n + b, rank)
                for token, rank in self.ranks.items()
                for k in range(1, len(token))
                if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None
            ]
            pairs = np.array(splits, np.int64).reshape(-1, 2)
            self._tables = _Pairs(np.array(keys, np.int64), np.array(values, np.int32)), of, _Pairs(pairs[:, 0], pairs[:, 1].astype(np.int32))
        return self._tables

    def _half(self, tokens: np.ndarray, side: int) -> np.ndarray:
        for t in np.unique(tokens[self._halves[tokens, 0] == -2]).tolist():
            self.halves(t)
        return self._halves[tokens, side]

    def _borders_hold(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """fits() of many pairs, a step of all at a time."""
        n, merged = len(self.tokens), self.tables()[2]
        out = self._half(right, 0) != -1
        (todo,) = np.nonzero(out)
        left, right, before = left[todo], right[todo], np.full(len(todo), 1 << 31)
        while len(todo):
            rank = merged.get(left * n + right)
            bad = (rank >= 0) & (rank < before)
            out[todo[bad]] = False
            on = ~bad & (np.maximum(left, right) >= 256)
            todo, left, right, before = todo[on], left[on], right[on], before[on]
            first = left > right
            before = np.where(first, left, right + 1)
            left, right = np.where(first, self._half(left, 1), left), np.where(first, right, self._half(right, 0))
        return out

    def fit_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * len(self.tokens) + right
        slot = ((key.astype(np.uint64) * _MIX) >> np.uint64(64 - (CACHE_PAIRS.bit_length() - 1))).astype(np.int64)
        out = self._fit[slot]
        (new,) = np.nonzero(self._known[slot] != key)
        if len(new):
            some, back = np.unique(key[new], return_inverse=True)
            held = self._borders_hold(some // len(self.tokens), some % len(self.tokens))
            out[new] = held[back]
            # of pairs that share a slot the last one stays in both arrays alike
            at = dict(zip(slot[new].tolist(), back.tolist()))
            slots, kept = np.fromiter(at, np.int64, len(at)), np.fromiter(at.values(), np.int64, len(at))
            self._known[slots], self._fit[slots] = some[kept], held[kept]
        return out

    def encode_short(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pieces of 1 to SHORT bytes."""
        edges, of, _ = self.tables()
        order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
        sizes = np.array([len(pieces[k]) for k in order], np.int64)
        width = int(sizes[0])
        data = np.frombuffer(b"".join(pieces[k].ljust(width, b"\0") for k in order), np.uint8).reshape(-1, width).astype(np.int64)
        longer = np.searchsorted(-sizes, -np.arange(width + 1), side="left")  # rows with more bytes than that come first
        last = np.zeros((len(pieces), width), np.int64)
        for start in range(width):
            rows, end = np.arange(longer[start]), start
            node = np.zeros(len(rows), np.int64)
            while len(rows):
                node = edges.get(node << 8 | data[rows, end])
                end += 1
                alive = node >= 0
                rows, node = rows[alive], node[alive].astype(np.int64)
                token = of[node]
                (some,) = np.nonzero(token >= 0)
                at, token = rows[some], token[some]
                good = self.fit_all(last[at, start - 1], token) if start else self._half(token, 0) != -1
                last[at[good], end - 1] = token[good]
                if end == width:
                    break
                more = int(np.searchsorted(rows, longer[end]))
                rows, node = rows[:more], node[:more]
        left, out, n = sizes.copy(), [], 0
        rows = np.arange(len(pieces))
        ids, counts = np.zeros((len(pieces), width), "<u4"), np.zeros(len(pieces), np.int64)
        while len(rows):
            token = last[rows, left[rows] - 1]
            n += 1
            ids[rows, width - n] = token
            left[rows] -= self.sizes[token]
            counts[rows] += 1
            rows = rows[left[rows] > 0]
        flat, by = ids.tobytes(), [b""] * len(pieces)
        for row, (k, c) in enumerate(zip(order, counts.tolist())):
            by[k] = flat[4 * (width * (row + 1) - c) : 4 * width * (row + 1)]
        return by

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        short = []
        for k, data in enumerate(pieces):
            whole = self.ranks.get(data)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(data) > SHORT or len(pieces) < FEW:
                out[k] = np.array(self.encode(data), "<u4").tobytes()
            else:
                short.append(k)
        short.sort(key=lambda k: len(pieces[k]))
        for i in range(0, len(short), TOGETHER):
            some = short[i : i + TOGETHER]
            for k, ids in zip(some, self.encode_short([pieces[k] for k in some])):
                out[k] = ids
        return out

    def as_array(self) -> np.ndarray:
        if self._array is None:
            self._array = np.array(self.tokens, object)
        return self._array


class PrefixTable:
    """last[i]: the token that ends the encoding of the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.last_tokens(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put new bytes in place of data[start:stop]; returns how many entries were computed again."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        same = n = 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.last_tokens(self.data[:end], self.last)
            n += 1
            past = end > start + len(new) and self.last[-1] == old[end - 1 - shift]
            same = same + 1 if past else 0
            if same >= self.vocabulary.longest:  # all that later entries depend on is as it was
                self.last += old[end - shift :]
                break
        return n

    def ids(self) -> list[int]:
        return self.vocabulary.walk_back(self.data, self.last)


class Encoder:
    """Packed ids of texts; ids of units and of matches are kept in two generations.

    A space between two characters that aren't white space always begins a match, so texts are cut there. What
    stands between two such spaces, with the space before it, is a unit: mostly one match, sometimes more."""

    def __init__(self, vocabulary: Vocabulary, split, scale: float = 1.0):
        self.vocabulary, self.split, self.most = vocabulary, split, int(scale * CACHE_UNITS)
        #: whether letters, digits and other signs, each with an optional space before them, are matches of their own
        self.plain = r"| ?\p{L}+|" in split.pattern and r"| ?[^\s\p{L}\p{N}]+|" in split.pattern
        self.units: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: matches without a space before them
        self.pieces: dict[str, bytes] = {}

    def _matches(self, unit: str, before: str = " ") -> Iterable[str]:
        if self.plain:
            if unit[-1:] in (".", ",") and unit[:-1].isalpha():
                return before + unit[:-1], unit[-1]
            if "\n" in unit:  # between two characters that aren't white space it is a match, and the next one begins behind it
                head, _, tail = unit.partition("\n")
                if head and tail and not head[-1].isspace() and not tail[0].isspace():
                    return *self._matches(head, before), "\n", *self._matches(tail, "")
            if unit.isalpha():
                return (before + unit,)
        return self.split.findall(before + unit)

    def _learn(self, matches: set[str], words: Iterable[str] = ()) -> None:
        """Ids of matches, and of words with a space before them; matches that begin with one space are such words."""
        words = set(words)
        others = []
        for m in matches:
            if m[0] == " " and len(m) > 1 and not m[1].isspace():
                words.add(m[1:])
            elif m not in self.pieces:
                others.append(m)
        for m, ids in zip(others, self.vocabulary.encode_all([m.encode() for m in others])):
            self.pieces[m] = ids
        words.difference_update(self.units)
        new = []
        for w in words:
            known = self.old.get(w)
            if known is None:
                new.append(w)
            else:
                self.units[w] = known
        self.units.update(zip(new, self.vocabulary.encode_all([(" " + w).encode() for w in new])))

    def _ids(self, m: str) -> bytes:
        return self.units[m[1:]] if m[0] == " " and len(m) > 1 and not m[1].isspace() else self.pieces[m]

    def _forget(self) -> None:
        if len(self.units) > self.most:
            self.old, self.units = self.units, {}
        if len(self.pieces) > self.most:
            self.pieces.clear()

    def _long(self, text: str) -> bytes:
        """Of a stretch without clean spaces, some matches at a time."""
        found, out = (m[0] for m in self.split.finditer(text)), []
        while some := list(islice(found, 50_000)):
            self._learn(set(some))
            out.append(b"".join(map(self._ids, some)))
            self._forget()
        return b"".join(out)

    def encode(self, texts: list[tuple[str, bool]]) -> list[bytes]:
        """Of texts, each with whether a clean space stands before it; BLOCK_CHARS characters together or so."""
        heads, out, gaps, known = [], [], [], self.units.get
        for text, spaced in texts:
            parts = text.split(" ") if not IRREGULAR.search(text) else None
            if not parts or not parts[0] or not parts[-1]:
                parts = CLEAN_SPACE.split(text)
            if not spaced:
                first = parts.pop(0)
                heads.append(self._long(first) if len(first) > LONG else self._matches(first, ""))
            else:
                heads.append(b"")
            ids = list(map(known, parts))
            if None in ids:
                gaps.append((ids, [(k, parts[k]) for k, x in enumerate(ids) if x is None]))
            out.append(ids)
        new = {u for _, gap in gaps for _, u in gap}
        now = {u: self._long(" " + u) for u in new if len(u) > LONG}
        new.difference_update(now)
        several, words, matches = {}, [], set(chain.from_iterable(h for h in heads if not isinstance(h, bytes)))
        for u in new:
            if self.plain and u.isalpha():
                words.append(u)
            elif u in self.old:
                self.units[u] = self.old[u]
            else:
                own = self._matches(u)
                matches.update(own)
                if len(own) != 1 or len(own[0]) != len(u) + 1:
                    several[u] = own
        self._learn(matches, words)
        for u, own in several.items():
            self.units[u] = b"".join(map(self._ids, own))
        for ids, gap in gaps:
            for k, u in gap:
                ids[k] = now[u] if u in now else self.units[u]
        out = [b"".join([h if isinstance(h, bytes) else b"".join(map(self._ids, h)), *ids]) for h, ids in zip(heads, out)]
        self._forget()
        return out


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


@lru_cache(4)
def encoder(path: str, split: str, scale: float = 1.0) -> Encoder:
    return Encoder(vocabulary(path), pattern(split), scale)


@lru_cache(4)
def pattern(text: str):
    import regex

    return regex.compile(text)


#: White space that isn't one clean space.
IRREGULAR = re.compile(r"\s | \s")
CLEAN_SPACE = re.compile(r"(?<=\S) (?=\S)")


def blocks(texts: Iterable[str]) -> Iterator[list[tuple[int, str, bool]]]:
    """(number of the text, a part of it, whether a clean space stands before it), BLOCK_CHARS at a time."""
    block, size = [], 0
    for k, text in enumerate(texts):
        at, spaced = 0, False
        while at < len(text) or not at:
            stop = len(text)
            if stop - at > BLOCK_CHARS:
                cut = CLEAN_SPACE.search(text, at + BLOCK_CHARS)
                stop = cut.start() if cut else stop
            block.append((k, text[at:stop], spaced))
            size += stop - at + 20
            at, spaced = stop + 1, True
            if size >= BLOCK_CHARS:
                yield block
                block, size = [], 0
    if block:
        yield block


def encode_texts(texts: list[str], path: str, split: str, scale: float = 1.0) -> list[bytes]:
    of = encoder(path, split, scale)
    out: list[list[bytes]] = [[] for _ in texts]
    for block in blocks(texts):
        for (k, _, _), ids in zip(block, of.encode([(part, spaced) for _, part, spaced in block])):
            out[k].append(ids)
    return [b"".join(x) for x in out]


def encode_text(text: str, path: str, split: str, scale: float = 1.0) -> bytes:
    return encode_texts([text], path, split, scale)[0]


def decode_ids(packed: bytes, path: str) -> bytes:
    return b"".join(vocabulary(path).as_array()[np.frombuffer(packed, "<u4")].tolist())


def _forget() -> None:
    encoder.cache_clear()
    vocabulary.cache_clear()


def _with_binary(df: DataFrame, source: str, names: Sequence[str], f: Callable[[list[bytes]], Sequence[list[bytes]]]) -> DataFrame:
    """The columns of df and some of bytes that f makes of the bytes in source, all in one pass."""
    rest = [c for c in df.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("bpe", _forget)
        for b in batches:
            made = [pa.array(x, pa.binary()) for x in f([x or b"" for x in b.column(len(rest)).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], *made], names=[*rest, *names])

    schema = df.select(*[F.col(f"`{c}`") for c in rest]).schema
    for name in names:
        schema = schema.add(name, "binary")
    data = F.col(f"`{source}`").cast("binary").alias("\x00source")
    return df.select(*[F.col(f"`{c}`") for c in rest], data).mapInArrow(run, schema)


def _texts(some: list[bytes]) -> list[str]:
    return [x.decode("utf-8", "replace") for x in some]


def encode(df: DataFrame, path: str, split: str, text_col: str = "text", ids_col: str = "ids", scale: float = 1.0) -> DataFrame:
    """scale: of the caches of a worker, where it shares its memory with more than this."""
    return _with_binary(df, text_col, [ids_col], lambda some: [encode_texts(_texts(some), path, split, scale)])


def decode(df: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    return _with_binary(df, ids_col, [bytes_col], lambda some: [[decode_ids(x, path) for x in some]])


def encode_and_decode(df: DataFrame, path: str, split: str, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded", scale: float = 1.0) -> DataFrame:
    """encode() and decode() of its ids in one pass, so a task needs one Python worker."""

    def both(some: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        ids = encode_texts(_texts(some), path, split, scale)
        return ids, [decode_ids(x, path) for x in ids]

    return _with_binary(df, text_col, [ids_col, bytes_col], both)


def token_digests(docs: DataFrame, path: str, split: str, scale: float = 1.0) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    bounded_batches(docs.sparkSession)
    out = encode_and_decode(docs.select("doc_id", text_bytes("text").alias("text")), path, split, scale=scale)
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
