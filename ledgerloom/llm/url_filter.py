"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens (runs of a-z and 0-9 that are whole in every url that it can
fit). The index holds each rule once, under the one of its tokens that is rarest in the urls at hand. The tokens of
a url fetch the candidate rules, and only those run. Counts of tokens cover all urls, but only tokens of rules.

Defined cases: a null url, or one without `://`, has an empty host and path and fits no rule. Rules without a whole
token are candidates for every url. Of rules that fit, the highest rank, then the longest name, then the last name
decides, and of rules that are equal in all that, the last one. Urls repeat freely; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import claim, stash, table

TOKEN = re.compile(r"[a-z0-9]+")
#: Most bytes of rules that travel with the tasks; a larger set is applied in blocks of this size, one after another.
BLOCK_BYTES = 32 << 20


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    #: Rules of a higher rank decide before others, then longer ones.
    rank: int = 0


#: Rules run on `s://host/path`; a scheme can't reach beyond the url's own host, though paths may hold other urls.
SCHEME = "^[^:/?#]*://"


def place_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with its subdomains and for the paths that start with path."""
    whole = TOKEN.findall(host.lower()) + [m[0] for m in TOKEN.finditer(path) if m.end() < len(path)]
    return Rule(host + path, verdict, rf"{SCHEME}(?:[^/?#]*\.)?(?-i:{re.escape(host)}){re.escape(path)}", tuple(whole), 1)


def label_rule(word: str) -> Rule:
    """Blocks hosts with the word as a whole part of a label, such as word-deals.example."""
    return Rule(f"label:{word}", "block", rf"{SCHEME}(?:[^/?#]*[.-])?{word}(?=[.-])[^/?#]*", (word,))


def path_rule(word: str) -> Rule:
    return Rule(f"path:{word}", "block", rf"{SCHEME}[^/?#]*/(?:[^?#]*/)?{word}(?=[/?#]|\Z)", (word,))


#: The rules of the contract.
BASE_RULES = (
    place_rule("org", "/", "allow"),
    place_rule("example.org", "/es/", "block"),
    place_rule("example.org", "/en/1", "block"),
    place_rule("com", "/fr/", "allow"),
    place_rule("com", "/de/", "block"),
)
#: The method's own rules, for urls that no base rule fits.
OWN_RULES = (
    *(label_rule(w) for w in ("adult", "bets", "casino", "pills", "poker", "porn", "xxx")),
    *(path_rule(w) for w in ("adult", "casino", "porn")),
)
RULES = BASE_RULES + OWN_RULES


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    return lower_az(host), rest[:end]


_AZ = {c: c + 32 for c in range(65, 91)}


def lower_az(text: str) -> str:
    return text.translate(_AZ)


def token_counts(urls: DataFrame, url_col: str, rules: Iterable[Rule]) -> dict[str, int]:
    """How many urls have each token of the rules: one row a token reaches the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    found = F.array_intersect(F.regexp_extract_all(F.lower(F.col(url_col)), F.lit(r"([a-z0-9]+)"), 1), F.lit(wanted))
    rows = urls.select(F.explode(found).alias("token")).groupBy("token").count().collect()
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in rows}


class RuleIndex:
    def __init__(self, rules: Iterable[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = defaultdict(list)
        self.always: list[tuple[Rule, re.Pattern]] = []
        for r in rules:
            entry = (r, re.compile(r.pattern))
            if r.tokens:
                self.by_token[min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))].append(entry)
            else:
                self.always.append(entry)

    def best(self, url: str | None) -> tuple[str, str, Rule | None]:
        """Host, path, and the rule that decides."""
        host, path = split_url(url)
        if not host and not path:
            return host, path, None
        normal = f"s://{host}{path}"
        found = list(self.always)
        for t in set(TOKEN.findall(lower_az(normal))):
            found += self.by_token.get(t, ())
        fits = [r for r, pattern in found if pattern.search(normal)]
        return host, path, max(fits, key=lambda r: (r.rank, len(r.name), r.name), default=None)


def blocks_of(rules: Iterable[Rule], block_bytes: int) -> list[tuple[Rule, ...]]:
    out: list[list[Rule]] = [[]]
    size = 0
    for r in rules:
        own = len(r.pattern) + len(r.name) + sum(map(len, r.tokens))
        if out[-1] and size + own > block_bytes:
            out.append([])
            size = 0
        out[-1].append(r)
        size += own
    return [tuple(x) for x in out]


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url_col: str = "url", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, host, path, rule, verdict, base) of every row; verdict is allow where no rule fits. base: whether a rule
    of a rank above 0 decided, null where none did."""
    kind = pages.schema[id_col].dataType.simpleString()
    out = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.lit(None).cast("struct<rank:int,name:string,verdict:string>").alias("best"))
    blocks = blocks_of(rules, block_bytes)
    for k, block in enumerate(blocks):
        counts = token_counts(pages, url_col, block)

        def judge(batches: Iterator[pa.RecordBatch], block=block, counts=counts) -> Iterator[pa.RecordBatch]:
            claim("url_filter")
            index = RuleIndex(block, counts)
            for b in batches:
                hosts, paths, best = [], [], []
                for url, old in zip(b.column("url").to_pylist(), b.column("best").to_pylist()):
                    host, path, r = index.best(url)
                    order = None if old is None else (old["rank"], len(old["name"]), old["name"])
                    best.append({"rank": r.rank, "name": r.name, "verdict": r.verdict} if r and (order is None or (r.rank, len(r.name), r.name) >= order) else old)
                    hosts.append(host), paths.append(path)
                made = [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(best, _BEST)]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), *made], names=["id", "url", "host", "path", "best"])

        out = out.mapInArrow(judge, f"id {kind}, url string, host string, path string, best struct<rank:int,name:string,verdict:string>")
        if k < len(blocks) - 1:
            out = stash(out, "judged")
    decided = [F.col("best.name").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), (F.col("best.rank") > 0).alias("base")]
    return out.select(F.col("id").alias(id_col), "host", "path", *decided)


_BEST = pa.struct([("rank", pa.int32()), ("name", pa.string()), ("verdict", pa.string())])


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_urls(table(spark, sf_dir, "pages"), RULES)
    return out.select("page_id", "host", "path", F.when(F.col("base"), F.col("rule")).alias("rule"), "verdict")


def _sql() -> str:
    fits = lambda host, path: f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"
    base = [("example.org", "/en/1", "block"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("org", "/", "allow")]
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in base)
    said = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in base)
    return f"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
  FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {said} WHEN regexp_matches(host, '(^|[.-])(adult|bets|casino|pills|poker|porn|xxx)[.-]')
    OR regexp_matches(path, '^/([^?#]*/)?(adult|casino|porn)(/|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM parts
"""


OP1_SQL = _sql()
