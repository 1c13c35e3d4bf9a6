"""Best matches: E7 by shared words, E3/E4 by fuzzy score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import col, normalize_name, normalize_text, text_key, tokens
from ledgerloom.operators.tokens import OVERLAP, RATIO, has_all, hot_words, peel

#: Bytes of master names that a task holds at a time.
MASTER_BYTES = 16 << 20
#: Names that are scored against a block in one task.
NAMES_PER_CELL = 20_000


def keep_first(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The row of the smallest order of each key, by an aggregation that is partly done before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    top = F.min_by(F.struct(*rest), F.col(order)).alias("_row")
    return df.groupBy(*keys).agg(top).select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def best_by_tokens(names: DataFrame, registry: DataFrame, ratio: float = RATIO, overlap: int = OVERLAP, stash: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(name, ratio, llave) of the distinct names that match a registry row (nombre, llave, od_order).

    Names ask for rows by their first two words and the rarest other word that a row has (peel()), so what is compared
    doesn't grow with names x rows that all begin alike. Rows that have no word of a name but the first two have a ratio
    that depends on their length alone, so of these only the first of each length is kept. Words that many rows have and
    no name asks for are left out before rows meet names. stash may write the tables that several steps read."""
    index = registry.withColumn("od", tokens("nombre")).select("llave", "od_order", "od", F.explode(F.array_distinct("od")).alias("word"))
    n = names.select("name").distinct().withColumn("src", tokens("name")).where(F.size("src") >= 2)
    n = stash(n)
    asked = stash(peel(n, index, (), ratio, overlap))
    index = stash(asked_words(asked, index))
    share = lambda both, size: both / F.greatest("total", size, F.lit(1))
    row = F.struct("ratio", (-F.col("od_order")).alias("o"), "llave")
    found = token_candidates(asked, index).withColumn("both", F.col("c") + F.size(F.filter("tail", lambda t: F.array_contains("od", t))))
    found = found.withColumn("ratio", share(F.col("both"), F.size("od"))).where((F.col("both") >= overlap) & (F.col("ratio") >= ratio))
    best = found.groupBy("q").agg(F.max(row).alias("b"))
    lengths = pair_candidates(asked, index).groupBy("two", F.size("od").alias("length")).agg(F.min_by("llave", "od_order").alias("llave"), F.min("od_order").alias("od_order"))
    alone = asked.where(F.size("tail") == 0).select("q", "two", "c", "total").distinct().join(lengths, "two")
    alone = alone.withColumn("ratio", share(F.col("c"), F.col("length"))).where(F.col("ratio") >= ratio).groupBy("q").agg(F.max(row).alias("b"))
    answers = asked.select("src", "q").join(best.union(alone), "q").groupBy("src").agg(F.max("b").alias("b"))
    return n.join(answers, "src").select("name", F.col("b.ratio").alias("ratio"), F.col("b.llave").alias("llave"))


def asked_words(asked: DataFrame, index: DataFrame) -> DataFrame:
    """index without the words that HOT rows or more have and that no question asks for: these rows would all meet in one task."""
    hot = hot_words(index.groupBy("word").agg(F.count("*").alias("n")))
    vain = hot.select("word").join(asked.select("word").distinct(), "word", "left_anti")
    return index.join(F.broadcast(vain), "word", "left_anti")


def token_candidates(asked: DataFrame, index: DataFrame) -> DataFrame:
    """The distinct questions of peel() with a tail, and the registry rows that have their words."""
    q = asked.where(F.size("tail") > 0).select("q", "two", "c", "total", "tail", "word").distinct()
    return q.join(index, "word").where(has_all(F.col("od"), F.col("two")) & F.array_contains("od", F.element_at("tail", 1)))


def pair_candidates(asked: DataFrame, index: DataFrame) -> DataFrame:
    """The distinct pairs of first words that decide alone, and the registry rows that have both."""
    pairs = asked.where(F.size("tail") == 0).select("two", "word").distinct()
    return pairs.join(index, "word").where(has_all(F.col("od"), F.col("two")))


def fill_keys(df: DataFrame, best: DataFrame, name: str = "Nombre personalizado", key: str = "Llave") -> DataFrame:
    """The best key where there is none yet."""
    b = best.select(F.col("name").alias("_name"), F.col("llave").alias("_llave"))
    empty = F.coalesce(F.trim(F.col(f"`{key}`")) == "", F.lit(True))
    return df.join(b, F.col(f"`{name}`") == F.col("_name"), "left").withColumn(key, F.when(empty, F.coalesce("_llave", F.col(f"`{key}`"))).otherwise(F.col(f"`{key}`"))).drop("_name", "_llave")


def unmatched_names(df: DataFrame, best: DataFrame, order: str, name: str = "Nombre personalizado", key: str = "Llave") -> DataFrame:
    """(name, first) of the distinct names, as keys (B3), that E7 leaves without a key, with the smallest order of each."""
    empty = F.coalesce(F.trim(F.col(f"`{key}`")) == "", F.lit(True))
    left = df.where(empty).join(best.select(F.col("name").alias("_name")), F.col(f"`{name}`") == F.col("_name"), "left_anti")
    return left.groupBy(text_key(F.col(f"`{name}`")).alias("name")).agg(F.min(order).alias("first"))


def fill_counts(before: DataFrame, after: DataFrame, key: str = "Llave") -> DataFrame:
    """keys that were filled, and rows without a key before and after."""
    empty = F.coalesce(F.trim(F.col(f"`{key}`")) == "", F.lit(True))
    both = before.select(F.lit(0).alias("t"), empty.alias("e")).union(after.select(F.lit(1), empty))
    n = lambda t: F.count_if((F.col("t") == t) & F.col("e"))
    return both.agg((n(0) - n(1)).alias("filled"), n(0).alias("empty_before"), n(1).alias("empty_after"))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    row = mask = (1 << len(a)) - 1
    for c in b:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & mask
    return len(a) - row.bit_count()


def token_set(a: str, b: str) -> float:
    """How alike two texts are as sets of words, from 0 to 1."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = x & y, x - y, y - x
    if both and (not left or not right):
        return 1.0
    i, p, q = (" ".join(sorted(s)) for s in (both, left, right))
    gap = 1 if i else 0
    len_a, len_b = len(i) + gap + len(p), len(i) + gap + len(q)
    best = 1 - (len(p) + len(q) - 2 * _common(p, q)) / (len_a + len_b)
    if i:
        best = max(best, 1 - (gap + len(p)) / (len(i) + len_a), 1 - (gap + len(q)) / (len(i) + len_b))
    return best


def token_set_ratio(a: str, b: str) -> int:
    """0 to 100, cut to an integer."""
    return int(100 * token_set(a, b))


class Choices:
    """Normalised choices in order, and what bounds their scores without comparing texts.

    Two texts share no more than their characters in common, counted in 64 classes, and the words in common say what
    the other two shares of a score are. Only choices whose bound reaches the best score so far are compared."""

    def __init__(self, norms: list[str], rounded: bool = False):
        import numpy as np

        self.np, self.norms, self.rounded = np, norms, rounded
        words = [sorted(set(n.split())) for n in norms]
        self.lengths = np.array([max(1, len(" ".join(w))) for w in words], np.float64)
        self.n_words = np.array([len(w) for w in words])
        holders: dict[str, list[int]] = {}
        for k, w in enumerate(words):
            for t in w:
                holders.setdefault(t, []).append(k)
        self.holders = {t: np.array(ks) for t, ks in holders.items()}
        self.counts = np.array([self._classes(" ".join(w)) for w in words], np.uint8).reshape(-1, 64)

    def _classes(self, text: str) -> list[int]:
        out = [0] * 64
        for c in text:
            out[ord(c) & 63] = min(255, out[ord(c) & 63] + 1)
        return out

    def _score(self, x: float) -> int:
        return round(100 * x) if self.rounded else int(100 * x)

    def bounds(self, norm: str):
        """For each choice a number that its score doesn't exceed."""
        np, words = self.np, set(norm.split())
        length = len(" ".join(sorted(words)))
        shared, n = np.zeros(len(self.norms)), np.zeros(len(self.norms), int)
        for t in words:
            ks = self.holders.get(t)
            if ks is not None:
                shared[ks] += len(t) + 1
                n[ks] += 1
        shared = np.maximum(shared - 1, 0)
        own = np.array(self._classes(" ".join(sorted(words))), np.uint8)
        bag = np.minimum(self.counts, own).sum(axis=1, dtype=np.int64) if length < 255 else np.full(len(self.norms), length)
        bag = np.where(self.lengths < 255, bag, np.minimum(length, self.lengths))  # counts end at 255
        most = np.maximum(2 * bag / (length + self.lengths), np.maximum(2 * shared / np.maximum(shared + length, 1), 2 * shared / np.maximum(shared + self.lengths, 1)))
        most[(n > 0) & ((n == len(words)) | (n == self.n_words))] = 1
        return np.floor(100 * most + (0.5 if self.rounded else 0) + 1e-9).astype(int)

    def best(self, norm: str) -> tuple[int, int] | None:
        """(score, place) of the best choice, the first on ties."""
        np = self.np
        if not self.norms:
            return None
        bounds = self.bounds(norm)
        k = int(bounds.argmax())
        top = (self._score(token_set(norm, self.norms[k])), -k)
        (rest,) = np.nonzero(bounds >= top[0])
        for k in rest[np.lexsort((rest, -bounds[rest]))].tolist():
            if (bounds[k], -k) <= top:
                if bounds[k] < top[0]:
                    break
                continue
            top = max(top, (self._score(token_set(norm, self.norms[k])), -k))
        return top[0], -top[1]


def best_fuzzy(
    names: DataFrame, master: DataFrame, normalize: Callable[[Column], Column] = normalize_name, block_bytes: int = MASTER_BYTES, names_per_cell: int = NAMES_PER_CELL, rounded: bool = False
) -> DataFrame:
    """(name, choice, score) of each distinct name that isn't blank: the best choice of master (choice,
    choice_order), the first on ties.

    Names and choices meet in cells of some names and a block of choices of a checked size; nothing of either passes
    through the driver, and the best of a name's cells is an aggregation."""
    q = names.select("name").distinct().withColumn("norm", normalize(col("name"))).where("norm <> ''")
    m = keep_first(master.withColumn("norm", normalize(col("choice"))).where("norm <> ''"), "norm", "choice_order")
    size = m.agg(F.sum(F.octet_length("norm") + F.octet_length("choice"))).first()[0] or 0
    blocks, n = max(1, -(-size // block_bytes)), q.count()
    cells = max(1, -(-n // names_per_cell), min(names.sparkSession.sparkContext.defaultParallelism, n // 64))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    part = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    left = q.withColumn("cell", part("norm", cells)).withColumn("block", every(blocks))
    right = m.select("norm", "choice", F.col("choice_order").cast("long").alias("choice_order"), part("norm", blocks).alias("block")).withColumn("cell", every(cells))

    def score(a, b):
        import pyarrow as pa

        b = b.sort_by("choice_order")
        choices, raw, order = Choices(b["norm"].to_pylist(), rounded), b["choice"], b["choice_order"]
        known: dict[str, tuple[int, int] | None] = {}
        rows = []
        for name, norm in zip(a["name"].to_pylist(), a["norm"].to_pylist()):
            if norm not in known:
                known[norm] = choices.best(norm)
            if known[norm]:
                s, k = known[norm]
                rows.append((name, s, order[k].as_py(), raw[k].as_py()))
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["name", "score", "choice_order", "choice"])

    found = left.groupBy("block", "cell").cogroup(right.groupBy("block", "cell")).applyInArrow(score, "name string, score int, choice_order long, choice string")
    best = F.max(F.struct("score", (-F.col("choice_order")).alias("o"), "choice")).alias("b")
    return found.groupBy("name").agg(best).select("name", F.col("b.choice").alias("choice"), F.col("b.score").alias("score"))


def match_names(names: DataFrame, master: DataFrame, threshold: int = 85) -> DataFrame:
    """(name, match, score): as best_fuzzy() by folded upper-case text, scores rounded. A choice must score above
    0 to be the best, and match is null below the threshold."""
    best = best_fuzzy(names, master, normalize_text, rounded=True).where("score > 0")
    return best.select("name", F.when(F.col("score") >= threshold, F.col("choice")).alias("match"), "score")


def enrich_names(df: DataFrame, best: DataFrame, name: str = "Proveedor", threshold: int = 85) -> DataFrame:
    """A name becomes its best choice from the threshold on."""
    b = best.where(F.col("score") >= threshold).select(F.col("name").alias("_name"), F.col("choice").alias("_choice"))
    return df.join(b, F.col(name) == F.col("_name"), "left").withColumn(name, F.coalesce("_choice", name)).drop("_name", "_choice")
