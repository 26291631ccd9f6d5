"""Mixing sources to target weights: hierarchical budgets over a tree of domain, language and source.

A budget of tokens goes down the tree. Children share their parent's budget by weight; a child that cannot use its share
(its tokens times the epochs allowed) takes what it can, and the shortage goes to its siblings by weight. A parent never
gets more than its subtree can use, so a shortage only reaches an ancestor when the siblings are full. This is solved for
all parents of a level at once, by running sums over children in order of capacity per weight, in whole numbers.

A leaf repeats whole epochs and takes a prefix of the last one: its documents in order of a seeded hash of id and text (another
order in each epoch), as long as their tokens fit. The prefix is found in two steps, sums of hash ranges first and then the documents
of the one range in which the budget ends, so that a leaf with a third of all rows is never sorted as a whole; the larger the
largest leaf, the more ranges. Documents of equal id and text follow each other by their other columns; of rows that are equal
in everything, as many are taken as fit. So a leaf misses its budget by less than one document, whatever its ids are.

Defined cases: a null text has no tokens; a null level is a child of its own; a null id hashes like an empty one. Nodes without
a given weight weigh 1, a weight of 0 gives nothing. Budgets are rounded down.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.llm.shared import settle
from stallmetrics.llm.sharding import hash_bits

LEVELS = ("domain", "language", "origin")
#: Relative weights by level and name.
WEIGHTS = {"domain": {"domain0": 5, "domain1": 3, "domain2": 2}, "language": {"en": 6, "de": 2, "fr": 1, "es": 1}}
#: Share of all tokens that is the budget, in hundredths, and the epochs a leaf may run.
BUDGET_SHARE, EPOCHS = 70, 2
SEED = 17
#: Documents of one range of hashes, about: what one task sorts.
RANGE_ROWS = 65_536
HASH_BITS = 60


def tokens(text: Column) -> Column:
    """Tokens of a text, estimated as a quarter of its bytes, rounded up."""
    return F.floor((F.coalesce(F.octet_length(text), F.lit(0)) + 3) / 4).cast("long")


def tree_of(lang: Column, source: Column) -> dict[str, Column]:
    """The levels of a document: sources are dealt to three domains by their number."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    return {
        "domain": F.concat(F.lit("domain"), (number % 3).cast("string")), "language": F.coalesce(lang, F.lit("")),
        "origin": F.coalesce(source, F.lit("")),
    }


def _order(epoch: Column, seed: int) -> Column:
    return hash_bits(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("key").cast("string"), F.lit("")), "digest"))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    weight = F.lit(1)
    for name, w in weights.get(level, {}).items():
        weight = F.when(F.col(level) == name, F.lit(int(w))).otherwise(weight)
    return weight.cast("long")


def share_out(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """``children`` (columns ``weight``, ``able`` and the parent's ``budget``) with their own ``budget`` instead.

    In order of capacity per weight, a child is full if its capacity is at most its share of what fuller-to-be siblings
    leave; the rest share what remains by weight.
    """
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("able").cast("double") / F.col("weight")).otherwise(F.lit(float("inf")))
    rows = children.withColumn("ratio", ratio)
    ordered = siblings.orderBy("ratio", name)
    before = F.coalesce(F.sum("able").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("before", before).withColumn("after", after)
    full = F.expr("weight > 0 AND cast(able AS decimal(20,0)) * cast(after AS decimal(18,0)) <= cast(weight AS decimal(18,0)) * cast(budget - before AS decimal(20,0))")
    rows = rows.withColumn("full", full)
    used = F.sum(F.when(F.col("full"), F.col("able")).otherwise(0)).over(siblings)
    rest = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(siblings)
    rows = rows.withColumn("used", used).withColumn("rest", rest)
    own = F.expr("CASE WHEN full THEN able WHEN rest = 0 THEN 0L ELSE (cast(weight AS decimal(18,0)) * cast(budget - used AS decimal(20,0))) div rest END")
    return rows.withColumn("budget", own.cast("long")).drop("ratio", "before", "after", "full", "used", "rest")


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], budget_share: int, epochs: int) -> DataFrame:
    """Per leaf (the levels, ``tokens``): the tokens it is to give, ``budget``."""
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    nodes = leaves.withColumn("able", F.col("tokens") * epochs).withColumn("budget", F.lit(min(total * budget_share // 100, total * epochs)).cast("long"))
    for depth, level in enumerate(LEVELS):
        parent, path = LEVELS[:depth], LEVELS[: depth + 1]
        children = nodes.groupBy(*path).agg(F.sum("able").alias("able"), F.min("budget").alias("budget")).withColumn("weight", _weight(level, weights))
        shared = share_out(children, parent, level).select(*path, F.col("budget").alias("given"))
        nodes = nodes.join(shared, list(path)).drop("budget").withColumnRenamed("given", "budget")
    return nodes.drop("able")


def mixture(
    documents: DataFrame, tree: Mapping[str, Column], *, key: str = "doc_id", text: str = "text", weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    budget_share: int = BUDGET_SHARE, epochs: int = EPOCHS, seed: int = SEED,
) -> DataFrame:
    """A row for each document and epoch selected: ``row`` (the document), the levels, ``n_tokens`` and ``epoch``."""
    others = [F.col(f"`{c}`") for c in documents.columns if c.lower() != text.lower()]
    levels = list(LEVELS)
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(key).alias("key"), tokens(F.col(text)).alias("n_tokens"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.xxhash64(F.to_json(F.struct(*others))).alias("of_row"),
        *[tree[level].alias(level) for level in LEVELS],
    )
    narrow = rows.drop("row")
    leaves = settle(narrow.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")))
    most = leaves.agg(F.max("documents")).first()[0] or 0
    shift = HASH_BITS - min(40, (most // RANGE_ROWS).bit_length())
    # leaves of one tree: as many as combinations of the levels, not as documents
    budgets = settle(
        leaf_budgets(leaves.drop("documents"), weights, budget_share, epochs)
        .withColumn("whole", F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0L END"))
        .withColumn("left", F.expr("budget - whole * tokens"))
    )
    last = (
        narrow.join(budgets.where("left > 0").select(*levels, "whole", "left"), levels)
        .withColumn("hash", _order(F.col("whole"), seed)).withColumn("range", F.shiftright("hash", shift))
    )
    ranges = last.groupBy(*levels, "left", "range").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*levels).orderBy("range"))
    # the first range that no longer fits as a whole, and what is left for it; there is one, as the epoch is longer than the budget
    ends = settle(
        ranges.withColumn("upto", upto).where("upto > left").groupBy(*levels)
        .agg(F.min(F.struct("range", F.expr("left - (upto - n)").alias("room"))).alias("end")).select(*levels, "end.range", "end.room")
    )
    # in it, the first rows that no longer fit, equal ones as one, and how many of them do
    equal = last.join(ends, [*levels, "range"]).groupBy(*levels, "room", "hash", "of_row").agg(
        F.first("n_tokens").alias("each"), F.sum("n_tokens").alias("n"))
    run = F.sum("n").over(Window.partitionBy(*levels).orderBy("hash", "of_row"))
    cuts = equal.withColumn("run", run).where("run > room").groupBy(*levels).agg(
        F.min(F.struct("hash", "of_row", F.expr("CASE WHEN each > 0 THEN (room - (run - n)) div each ELSE 0L END").alias("fit"))).alias("cut"))
    cuts = settle(budgets.select(*levels, "whole").join(cuts, levels, "left"))
    placed = rows.join(cuts, levels).withColumn("hash", _order(F.col("whole"), seed))
    before = (F.col("hash") < F.col("cut.hash")) | ((F.col("hash") == F.col("cut.hash")) & (F.col("of_row") < F.col("cut.of_row")))
    chosen = F.concat(
        F.when(F.col("whole") > 0, F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).otherwise(F.array().cast("array<bigint>")),
        F.when(before, F.array("whole")).otherwise(F.array().cast("array<bigint>")),
    )
    kept = placed.select("row", *levels, "n_tokens", F.explode(chosen).alias("epoch"))
    at_cut = placed.where("cut.fit > 0 AND hash = cut.hash AND of_row = cut.of_row").groupBy(*levels, "whole", "cut.fit").agg(
        F.first("row").alias("row"), F.first("n_tokens").alias("n_tokens"))
    copies = at_cut.select("row", *levels, "n_tokens", F.col("whole").alias("epoch"), F.explode(F.sequence(F.lit(1).cast("long"), "fit")))
    return kept.unionByName(copies.drop("col"))


def mixing_report(documents: DataFrame) -> DataFrame:
    """A row for each document and epoch selected, with its leaf and tokens."""
    rows = mixture(documents.select("doc_id", "text", "lang", "source"), tree_of(F.col("lang"), F.col("source")))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "epoch", *LEVELS, "n_tokens")


def mix(documents: DataFrame, *, budget_share: int = 80) -> DataFrame:
    """``documents`` as mixed in a single epoch, with their own columns."""
    return mixture(documents, tree_of(F.col("lang"), F.col("source")), budget_share=budget_share, epochs=1).select("row.*")


def _sql_level(depth: int) -> str:
    path, parent = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
    level, below = LEVELS[depth], f"g{depth}"
    by = f"PARTITION BY {parent}" if parent else ""
    weight = "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS.get(level, {}).items()) + " ELSE 1 END" if level in WEIGHTS else "1"
    budget = "(SELECT b FROM root)" if not depth else f"(SELECT g.given FROM given{depth - 1} g WHERE " + " AND ".join(f"g.{x} = c.{x}" for x in LEVELS[:depth]) + ")"
    return f"""
{below} AS (SELECT *, {weight} AS w, {budget} AS b FROM (SELECT {path}, CAST(sum(t) * {EPOCHS} AS HUGEINT) AS c FROM leaves GROUP BY {path}) c),
o{depth} AS (SELECT *, c::DOUBLE / w AS r, coalesce(sum(c) OVER ({by} ORDER BY c::DOUBLE / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
  sum(w) OVER ({by} ORDER BY c::DOUBLE / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wa FROM {below}),
f{depth} AS (SELECT *, c * wa <= w * (b - cb) AS full_ FROM o{depth}),
u{depth} AS (SELECT *, sum(CASE WHEN full_ THEN c ELSE 0 END) OVER ({by}) AS cu, sum(CASE WHEN full_ THEN 0 ELSE w END) OVER ({by}) AS wr FROM f{depth}),
given{depth} AS (SELECT {path}, CAST(CASE WHEN full_ THEN c ELSE (w * (b - cu)) // wr END AS HUGEINT) AS given FROM u{depth}),"""


ORACLE = f"""
WITH d AS (
  SELECT doc_id, md5(coalesce(text, '')) AS digest, (coalesce(strlen(text), 0) + 3) // 4 AS n_tokens, coalesce(lang, '') AS language, coalesce(source, '') AS origin,
    'domain' || CAST(coalesce(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % 3 AS VARCHAR) AS domain FROM documents),
leaves AS (SELECT domain, language, origin, sum(n_tokens) AS t FROM d GROUP BY ALL),
root AS (SELECT least(sum(t) * {BUDGET_SHARE} // 100, sum(t) * {EPOCHS}) AS b FROM leaves),
{"".join(_sql_level(i) for i in range(3))}
l AS (SELECT leaves.*, CASE WHEN t > 0 THEN given // t ELSE 0 END AS whole, CASE WHEN t > 0 THEN given - given // t * t ELSE 0 END AS room
  FROM leaves JOIN given2 USING (domain, language, origin)),
h AS (SELECT d.*, whole, room, CAST('0x' || substr(md5('{SEED}-' || CAST(whole AS VARCHAR) || '-' || coalesce(CAST(doc_id AS VARCHAR), '') || '-' || digest), 1, 15) AS BIGINT) AS hash
  FROM d JOIN l USING (domain, language, origin)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY hash) AS run FROM h)
SELECT doc_id, epoch, domain, language, origin, n_tokens FROM (
  SELECT doc_id, CAST(unnest(range(0, CAST(whole AS BIGINT))) AS BIGINT) AS epoch, domain, language, origin, n_tokens FROM s
  UNION ALL SELECT doc_id, CAST(whole AS BIGINT), domain, language, origin, n_tokens FROM s WHERE room > 0 AND run <= room)
"""
