"""URL filters: exact membership in key lists by Bloom filter cascades, without joins.

A url's keys are every suffix of its host (by labels) with every prefix of its path that has the length of a listed path. The first
level of a cascade is a Bloom filter of the listed keys. Over the complete key universe of the corpus the second level
encodes the first one's false positives, the third the listed keys that the second takes for such, and so on in turn until
a level makes no mistake. A key is listed if the first level that does not hold it is an even one, so for all keys of the
corpus the answer is exact, and asking it is arithmetic on a constant. The first level is sized from the counts of listed
and of all keys, so that its mistakes are about as many as the listed keys: the size of a cascade grows with the list,
and with the corpus only in the logarithm. Built-in functions only.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule. Of rules that fit, the
one of the longest key wins; of equally long keys the smaller one. An empty list lists nothing.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.shared import settle

#: Listed keys of one cascade at most; a longer list is dealt to several by the hash of its keys.
MOST_KEYS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(after, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def url_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """All keys of a url for listed paths of these lengths, longest first."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(int(n)) for n in sorted(set(lengths))]), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(cuts, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))
    ordered = F.array_sort(F.transform(F.array_distinct(keys), lambda k: F.struct((-F.length(k)).alias("size"), k.alias("key"))))
    return F.transform(ordered, lambda x: x["key"])


@dataclass(frozen=True)
class Level:
    """A Bloom filter as a constant: 32 bits a word."""

    words: tuple[int, ...]
    hashes: int
    salt: int

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.salt * 64 + i)), F.lit(32 * len(self.words))) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        held = F.lit(True)
        for p in self.positions(key):
            word = F.element_at(words, (F.shiftright(p, 5) + 1).cast("int"))
            held &= F.pmod(F.floor(word / F.pow(F.lit(2.0), p % 32)).cast("long"), F.lit(2)) == 1
        return held


def _level(keys: DataFrame, count: int, bits: float, salt: int) -> Level:
    """A filter of the ``count`` keys with about ``bits`` bits for each."""
    size = max(1, math.ceil(count * bits / 32))
    empty = Level((0,) * size, max(1, round(bits * math.log(2))), salt)
    places = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("p"))
    words = places.groupBy(F.shiftright("p", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 32 AS int))")).alias("bits"))
    held = {row.word: row.bits for row in words.collect()}  # as many as the filter has words, which its keys bound
    return Level(tuple(held.get(i, 0) for i in range(size)), empty.hashes, salt)


@dataclass(frozen=True)
class Cascade:
    """Exact membership of all keys of the universe that it was built over."""

    levels: tuple[Level, ...]
    #: Cascades of a list too long for one, each for the keys whose hash falls to it.
    parts: tuple[Cascade, ...] = ()

    def lists(self, key: Column) -> Column:
        if self.parts:
            part, listed = _part(key, len(self.parts)), F.lit(False)
            for number, cascade in enumerate(self.parts):
                listed = F.when(part == number, cascade.lists(key)).otherwise(listed)
            return listed
        answer = F.lit(len(self.levels) % 2 == 1)  # held by all levels
        for number in range(len(self.levels) - 1, -1, -1):
            answer = F.when(self.levels[number].holds(key), answer).otherwise(F.lit(number % 2 == 1))
        return answer


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


def _falls_to(number: int, parts: int):
    return lambda key: _part(key, parts) == number


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed``: distinct column ``key``; ``universe``: column ``keys``, an array for each row, with repeats."""
    n = listed.count()
    if n > MOST_KEYS:
        count = -(-2 * n // MOST_KEYS)  # half full on average, so that none is too long by chance
        return Cascade((), tuple(
            build_cascade(
                listed.where(_part(F.col("key"), count) == i), universe.select(F.filter("keys", _falls_to(i, count)).alias("keys"))
            ) for i in range(count)
        ))
    if not n:
        return Cascade(())
    everything = universe.select(F.sum(F.size("keys"))).first()[0] or 0
    levels = [_level(listed, n, 2 + 1.44 * math.log2(max(2.0, everything / n)), 0)]
    right, first = listed, levels[0]
    met = universe.select(F.explode(F.filter("keys", first.holds)).alias("key")).distinct()
    wrong = met.join(listed, "key", "left_anti")
    while True:
        wrong = settle(wrong)  # about as many keys as are listed
        count = wrong.count()
        if not count:
            return Cascade(tuple(levels))
        level = _level(wrong, count, 3.0, len(levels))
        levels.append(level)
        # those of the other side that this level takes for its own are for the next one
        right, wrong = wrong, right.where(level.holds(F.col("key")))


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains, where the path starts so."""

    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: Hosts that are blocked, with their subdomains, where no rule fits.
BLOCKED_HOSTS = ("ads-track.example.org", "casino-win.example.org", "cheap-pills.example.com", "free-bets.example.com", "spam-farm.example.org")


def _listed(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    values = sorted(set(keys))
    listed = df.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(values)), "array<string>")).alias("key"))
    return listed.distinct()


def judge_urls(pages: DataFrame, *, url: str = "url", rules: Sequence[Rule] = RULES, blocked_hosts: Sequence[str] = BLOCKED_HOSTS) -> DataFrame:
    """``pages`` as ``row``, with ``host``, ``path``, ``rule`` and ``verdict``."""
    host, path = host_and_path(F.col("row")[url])
    parts = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")).withColumn("host", host).withColumn("path", path)
    lengths = [len(r.path) for r in rules] or [0]
    keys = parts.withColumn("keys", url_keys(F.col("host"), F.col("path"), lengths)).withColumn("hosts", url_keys(F.col("host"), F.lit(""), [0]))
    universe = keys.select("keys")
    allow, block = (build_cascade(_listed(pages, [r.key for r in rules if r.verdict == v]), universe) for v in ("allow", "block"))
    hosts = build_cascade(_listed(pages, [h.translate(str.maketrans(_UPPER, _LOWER)) for h in blocked_hosts]), keys.select(F.col("hosts").alias("keys")))
    usable = F.filter("keys", lambda k: allow.lists(k) | block.lists(k))
    judged = keys.withColumn("rule", F.get(usable, F.lit(0)))
    own = F.when(F.exists("hosts", hosts.lists), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.when(F.col("rule").isNull(), own).when(block.lists(F.col("rule")), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("row", "host", "path", "rule", verdict.alias("verdict"))


def url_report(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url")).select("row.page_id", "host", "path", "rule", "verdict")


_SQL_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
_SQL_HOSTS = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
ORACLE = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, h, q) AS (VALUES {_SQL_RULES}),
b(h) AS (VALUES {_SQL_HOSTS}),
best AS (
  SELECT n, h || q AS rule, verdict FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(h || q) DESC, h || q) = 1),
bad AS (SELECT DISTINCT n FROM p JOIN b ON host = h OR ends_with(host, '.' || h))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad.n IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN best USING (n) LEFT JOIN bad USING (n)
"""
