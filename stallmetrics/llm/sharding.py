"""Sharding by extendible hashing: a bucket is named by the first bits of its keys' hash and splits while it is too big.

Splitting a bucket only when it is oversized gives every key the least depth at which its bucket fits. The bytes of fine
cells of the hash space, a few dozen a shard, are added up once; the bytes of every bucket at every depth follow from them,
and the directory is the least depth that fits, per cell. Only cells that are still too big are looked at again, with more
bits, so work beyond the first pass is in proportion to them. Documents meet their cell by a join on its number, which is
spread evenly by the hash; nothing is gathered on the driver.

Defined cases: a null text has no bytes, a null key hashes like an empty one, and an empty table has no shard. A document
above the limit has a shard of its own. Rows of one key cannot be told apart by hash: where they alone exceed the limit
they are cut, by classes of size a power of two wide, into numbered parts of as many rows as surely fit; rows are counted in
pieces of ``PIECE`` and numbered within them, so that no key meets in one task. Of an input column named as an
added one, the added one remains.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.llm.shared import settle, without

#: Bytes of text in a shard at most: small shards, as streaming readers shuffle them.
LIMIT = 1 << 20
#: Bits of the hash, from the first 15 hexadecimal digits of an MD5 sum.
BITS = 60
#: Cells a shard, as a power of two, in the first pass; and the further bits that every later pass looks at.
FINER, MORE = 5, 8
#: Rows that are numbered together where rows of one key are cut.
PIECE = 1024
ADDED = ("n_bytes", "shard")


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's MD5 sum as a number; any engine can compute it."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _depths(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Of every cell of ``high`` bits, the least depth above ``low`` at which its bucket fits; null where none does."""
    depth = cells.select("cell", "n", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    prefix = F.expr(f"shiftright(cell, {high} - depth)")
    buckets = depth.groupBy("depth", prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fits = settle(buckets.where((F.col("bytes") <= limit) | (F.col("n") == 1)).select("depth", "prefix"))
    least = depth.withColumn("prefix", prefix).join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    return cells.select("cell").join(least, "cell", "left")


def _cut(crowded: DataFrame, limit: int) -> DataFrame:
    """(row, n_bytes, shard) of rows of keys that exceed the limit alone; ``crowded`` has (row, hash, n_bytes)."""
    number = F.monotonically_increasing_id()
    size = F.length(F.bin(F.greatest(F.lit(0), F.col("n_bytes") - 1)))
    rows = settle(crowded.withColumn("number", number).withColumn("size", size).withColumn("piece", F.expr(f"number div {PIECE}")))
    counts = settle(rows.groupBy("hash", "size", "piece").agg(F.count("*").alias("n"), F.max("n_bytes").alias("most")))
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.max("most"))))
    fits = settle(counts.groupBy("hash", "size").agg(fit.alias("fit")))
    of_size = Window.partitionBy("hash", "size").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(counts.select("hash", "size", "piece", F.coalesce(F.sum("n").over(of_size), F.lit(0)).alias("before")).join(fits, ["hash", "size"]))
    within = F.row_number().over(Window.partitionBy("hash", "size", "piece").orderBy("number"))
    places = settle(rows.select("number", "hash", "size", "piece", within.alias("within")).join(before, ["hash", "size", "piece"]))
    part = F.floor((F.col("before") + F.col("within") - 1) / F.col("fit")).cast("string")
    name = F.concat_ws(".", F.lpad(F.bin("hash"), BITS, "0"), F.col("size").cast("string"), part)
    return rows.select("number", "row", "n_bytes").join(places.select("number", name.alias("shard")), "number").select("row", "n_bytes", "shard")


def assign_shards(documents: DataFrame, *, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``documents`` with ``n_bytes`` of text and ``shard``: the bits of its bucket, with a part number where rows of one key are cut."""
    source = without(documents, *ADDED)
    columns = [F.col(f"`{c}`") for c in source.columns]
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    rows = source.select(F.struct(*columns).alias("row"), hash_bits(F.col(key)).alias("hash"), size.alias("n_bytes"))
    narrow = rows.select("hash", "n_bytes")
    total = narrow.agg(F.sum("n_bytes")).first()[0] or 0
    low, high, done, waiting = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER), None, narrow
    while True:
        cell = F.shiftright("hash", BITS - high)
        cells = settle(waiting.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")))
        depths = settle(_depths(cells, low, high, limit))
        rows = rows.withColumn("cell", F.shiftright("hash", BITS - high)).join(depths, "cell", "left")
        rows = rows.withColumn("depth", F.coalesce("done", "depth") if done else F.col("depth")).drop("done", "cell").withColumnRenamed("depth", "done")
        done = True
        full = depths.where("depth IS NULL").select("cell")
        if full.isEmpty() or high == BITS:
            break
        waiting = waiting.withColumn("cell", F.shiftright("hash", BITS - high)).join(full, "cell", "left_semi").drop("cell")
        low, high = high + 1, min(BITS, high + MORE)
    placed = rows.where("done IS NOT NULL").select("row", "n_bytes", F.expr("substring(lpad(bin(hash), 60, '0'), 1, done)").alias("shard"))
    if not full.isEmpty():
        placed = placed.unionByName(_cut(rows.where("done IS NULL").select("row", "hash", "n_bytes"), limit))
    return placed.select("row.*", "n_bytes", "shard")


def shard_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, its bytes and its shard."""
    return assign_shards(documents.select("doc_id", "text")).select("doc_id", "n_bytes", "shard")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows written by one task."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
p AS (SELECT doc_id, n_bytes, h, depth, h >> (60 - depth) AS prefix FROM d, range(0, 61) r(depth)),
b AS (SELECT depth, prefix FROM p GROUP BY depth, prefix HAVING sum(n_bytes) <= {LIMIT} OR count(*) = 1)
SELECT doc_id, any_value(n_bytes) AS n_bytes, substr(lpad(bin(any_value(h)), 60, '0'), 1, CAST(min(depth) AS INT)) AS shard
FROM p JOIN b USING (depth, prefix) GROUP BY doc_id
"""
