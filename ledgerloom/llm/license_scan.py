"""License scans with a generalised suffix automaton of licence words.

The automaton holds every run of words of all templates. A file streams through it word by word, which gives its
matching statistics: at each word, the longest run of template words that ends there, and the state of that run.
Where such a match can't be extended and is long enough, it is a piece of the templates that hold it; pieces that
follow each other in file and template, with small gaps, are chained into spans, and a span that covers enough of a
template's words has its label. The base phrases are templates too: a phrase ends at a word if its state is the
word's state or one that its suffix links lead to, and the match is long enough.

Words are runs of 0-9, a-z (A-Z folded) and all bytes from 80. Memory is that of one batch of texts; long texts are
read a slice at a time. Defined cases: null and empty texts have no words, no labels and a score of 0; equal rows
each get a row; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import FOLD_ALNUM, bounded_batches, claim, table, text_bytes
from ledgerloom.llm.fm_index import words
from ledgerloom.llm.license_texts import TEMPLATES

#: Phrases and labels that always count.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Least words of a piece, most words between pieces of a span, and least share of a template that a span covers.
LEAST_WORDS, MOST_GAP, LEAST_COVER = 3, 6, 0.75


def split_words(text: str) -> list[bytes]:
    return text.encode().translate(FOLD_ALNUM).split()


class Automaton:
    def __init__(self, texts: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: (text, number of words before its end) of the places where a state's runs end
        self.ends: list[list[tuple[int, int]]] = [[]]
        for t, ids in enumerate(texts):
            state = 0
            for i, w in enumerate(ids):
                state = self._extend(state, w)
                self.ends[state].append((t, i + 1))
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s]:
                self.ends[self.link[s]] = sorted({*self.ends[self.link[s]], *self.ends[s]})

    def _new(self, length: int, link: int, of: dict[int, int]) -> int:
        self.next.append(of)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, w: int) -> int:
        """The state that p's runs lead to by w, on its own."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        c = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        new, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w)
        return new


class Scanner:
    def __init__(self, base=BASE, templates=TEMPLATES):
        self.ids: dict[bytes, int] = {}
        self.n_base = len(base)
        self.labels = [label for _, label in (*base, *templates)]
        texts = [[self.ids.setdefault(w, len(self.ids)) for w in split_words(t)] for t, _ in (*base, *templates)]
        self.sizes = [len(t) for t in texts]
        self.automaton = a = Automaton(texts)
        #: for each state the base phrases that end where its runs end, if they are as long as the phrase
        self.phrases: list[tuple[tuple[int, int], ...]] = []
        whole: dict[int, list[int]] = {}
        for k in range(self.n_base):
            state = 0
            for w in texts[k]:
                state = a.next[state][w]
            whole.setdefault(state, []).append(k)
        for s in range(len(a.next)):
            found, up = [], s
            while up > 0:
                found += [(k, self.sizes[k]) for k in whole.get(up, ())]
                up = a.link[up]
            self.phrases.append(tuple(found))

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Number of words, (phrase, start) of base places, and (template, start, stop, cover) of spans."""
        n, base, pieces = self.match(data)
        return n, base, self.chain(pieces)

    def match(self, data: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Number of words, base places, and pieces: (start, stop, template, start in the template) of each longest
        run of template words, LEAST_WORDS or more, at each place where a template has it."""
        n, base, pieces, state, length = 0, [], [], 0, 0
        a = self.automaton
        nxt, link, longest = a.next, a.link, a.length

        def piece(end: int) -> None:
            for t, stop in a.ends[state]:
                if t >= self.n_base:
                    pieces.append((end - length, end, t, stop - length))

        for some in words(data):
            ids = np.fromiter(map(self.ids.get, some, repeat(-1)), np.int32, len(some))
            (at,) = np.nonzero(ids >= 0)
            before = -2 if length == 0 else n - 1
            for i, w in zip((at + n).tolist(), ids[at].tolist()):
                if i != before + 1 and length:
                    if length >= LEAST_WORDS:
                        piece(before + 1)
                    state = length = 0
                before = i
                to = nxt[state].get(w)
                if to is None:
                    if length >= LEAST_WORDS:
                        piece(i)
                    while state and to is None:
                        state = link[state]
                        to = nxt[state].get(w)
                    length = longest[state]
                if to is not None:
                    state, length = to, length + 1
                    for k, size in self.phrases[state]:
                        if length >= size:
                            base.append((k, i + 1 - size))
            n += len(some)
            if length and before != n - 1:
                if length >= LEAST_WORDS:
                    piece(before + 1)
                state = length = 0
        if length >= LEAST_WORDS:
            piece(n)
        return n, base, pieces

    def chain(self, pieces: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Spans of pieces (start, stop, template, start in the template) that follow each other."""
        out, by = [], {}
        for p in sorted(set(pieces)):
            by.setdefault(p[2], []).append(p)
        for t, own in by.items():
            open_: list[list[int]] = []  # [start, stop, stop in the template, words]
            for a, b, _, at in own:
                fits = [c for c in open_ if c[1] <= a <= c[1] + MOST_GAP and c[2] <= at <= c[2] + MOST_GAP]
                out += [(t, c[0], c[1], c[3] / self.sizes[t]) for c in open_ if c[1] + MOST_GAP < a]
                open_ = [c for c in open_ if c[1] + MOST_GAP >= a]
                if fits:
                    c = max(fits, key=lambda c: c[3])
                    c[1], c[2], c[3] = b, at + b - a, c[3] + b - a
                else:
                    open_.append([a, b, at + b - a, b - a])
            out += [(t, c[0], c[1], c[3] / self.sizes[t]) for c in open_]
        return sorted(out)


@lru_cache(1)
def scanner() -> Scanner:
    return Scanner()


_PLACE = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
_COVER = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("cover", pa.float64())]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, spans) of every row: places of base phrases, and template spans with their cover."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("license_scan")
        s = scanner()
        for b in batches:
            got = [s.scan(t) for t in b.column(1).to_pylist()]
            base = [[{"label": s.labels[k], "start": i} for k, i in x] for _, x, _ in got]
            spans = [[{"label": s.labels[t], "start": i, "stop": j, "cover": c} for t, i, j, c in x] for _, _, x in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _, _ in got], pa.int64()), pa.array(base, _PLACE), pa.array(spans, _COVER)],
                names=["doc_id", "n_words", "base", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, base array<struct<label:string,start:long>>, spans array<struct<label:string,start:long,stop:long,cover:double>>"
    return docs.select("doc_id", text_bytes("text").alias("text")).mapInArrow(run, schema)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    full = F.filter("spans", lambda x: x["cover"] >= LEAST_COVER)
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    cover = F.coalesce(F.array_max("spans.cover"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat(F.col("base.label"), F.transform(full, lambda x: x["label"]))).alias("labels"),
        F.least(F.lit(1.0), F.greatest(cover, F.when(F.size("base") > 0, 0.5).otherwise(0.0))).alias("score"),
    )
