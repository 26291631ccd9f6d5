"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence.

A document's row of the incidence holds the hashes of its distinct shingles. Columns are ordered by how common they are
(in one text only; few; many) and then by hash, a fixed order over the whole corpus, so two rows that reach the
similarity meet in a column of their first ``n - ceil(0.75 n) + 1``: this first block of columns names the pairs to
multiply. Column counts come from all documents: tasks count their own shingles, column blocks add the counts up and
return two fixed-size bit tables (in several texts, in many texts). A set bit too many costs work, never a link.

Bounds by size come before every product: a row of which less than 75 % of the shingles occur elsewhere links with
nothing; rows of too different size do not meet; and the product of two rows runs over blocks of columns, stopping
when the overlap so far plus the smaller block sizes to come cannot reach 75 % of the union.

What is sent to be multiplied is sifted first: a row's shared columns dealt to ``CELLS`` cells by their hash, counted, bound its
overlap with another row by the sum of the smaller counts, so most pairs that cannot link never send their columns.

Copies are one row. Rows that share a column are first multiplied with the column's smallest row alone, its pivot, which
joins most of a large group of near copies in linear work. The rows around one pivot that are not yet in its component
are then multiplied, in tiles of bounded size, with each other and with the rest: a tile's overlap counts add up over blocks of
columns, and only links that join something leave the task. No pair of a column is left out, and no list of pairs is made.

Defined cases: null and empty texts and texts without words have no shingle and link with nothing. Repeated rows of one
id are one document. A null id is returned without component.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.shared import (
    LOWERED, Words, bit_set, bit_tables, components, drop_settled, packed_slots, parted, rows_of, settle, spanning, star_tiles, tidy,
)

WIDTH = 5
#: A link needs 100 * overlap >= SIMILARITY * union.
SIMILARITY = 75
#: Bits of the hash that address the two tables (2 ** BITS bits each: 16 MB, whatever the corpus).
BITS = 27
#: A shingle of more texts than this is common.
COMMON = 32
#: Shingles per block of columns that are counted in one task, about.
COLUMNS = 1_000_000
#: Column blocks of the product of two rows.
STEPS = 8
#: Rows and shingles of a tile, about, and the columns of one dense block of it.
TILE_ROWS, TILE_SHINGLES, TILE_COLUMNS = 2048, 1_000_000, 1024
#: Cells of a row's histogram, a byte each; a row with a fuller cell has none and is never sifted out.
CELLS = 256


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    hashes, at = Words(texts, LOWERED).shingles(width)
    return [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def column_tables(docs: DataFrame, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Bit tables over the hash's first ``BITS`` bits: shingle in several texts, shingle in more than ``COMMON``."""
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0

    def hashes(batches):
        for _, texts in rows_of(batches, "text"):
            yield np.concatenate([*shingle_sets(texts, width), np.zeros(0, np.uint64)])

    several, common = bit_tables(packed_slots(docs.select("text"), hashes, size / 6 / COLUMNS, BITS), (2, COMMON + 1), BITS)
    return several, common


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """The least overlap with which a row of ``n`` shingles can still link."""
    return -(-SIMILARITY * n // 100)


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """Per document: size, digest of its set, and, where it can link, its first columns and its shared shingles."""
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(column_tables(docs, width))

    def profile(batches):
        several, common = tables.value
        for batch, texts in rows_of(batches, "text"):
            sizes, digests, first, shared, cells = [], [], [], [], []
            for grams in shingle_sets(texts, width):
                n = len(grams)
                met = grams[bit_set(several, grams, BITS)]
                links = n > 0 and len(met) >= least_overlap(n)
                sizes.append(n)
                digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if links else None)
                shared.append(met.view(np.int64) if links else [])
                cells.append(histogram(met) if links else None)
                if links:
                    many = bit_set(common, met, BITS)
                    ordered = np.concatenate((met[~many], met[many]))
                    first.append(ordered[: n - least_overlap(n) + 1 - (n - len(met))].view(np.int64))
                else:
                    first.append([])
            grams = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(first, grams), pa.array(shared, grams), pa.array(cells, pa.binary())],
                ["id", "n", "digest", "first", "shared", "cells"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    out = settle(docs.mapInArrow(profile, f"id {kind}, n long, digest binary, first array<long>, shared array<long>, cells binary"))
    tables.destroy()
    tidy(spark)
    return out


def histogram(hashes: np.ndarray) -> bytes | None:
    """Counts of the hashes by cell, a byte each, or nothing where a byte is too small."""
    counts = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=CELLS)
    return None if counts.max() > 255 else counts.astype(np.uint8).tobytes()


def _needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least overlap of linked rows of so many shingles."""
    return -(-SIMILARITY * (n + m) // (100 + SIMILARITY))


def _sizes_fit(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * SIMILARITY


def overlap_reaches(x: np.ndarray, y: np.ndarray, n: int, m: int) -> bool:
    """Whether two rows' product reaches the similarity; ``x`` and ``y`` are sorted hashes, ``n`` and ``m`` whole sizes."""
    need = -(-SIMILARITY * (n + m) // (100 + SIMILARITY))
    edges = np.arange(1, STEPS, dtype=np.uint64) << np.uint64(61)
    cuts = [np.concatenate(([0], np.searchsorted(v, edges), [len(v)])) for v in (x, y)]
    rest = np.minimum(np.diff(cuts[0]), np.diff(cuts[1]))
    most, overlap = int(rest.sum()), 0
    for k in range(STEPS):
        if overlap + most < need:
            return False
        a, b = x[cuts[0][k] : cuts[0][k + 1]], y[cuts[1][k] : cuts[1][k + 1]]
        overlap += len(np.intersect1d(a, b, assume_unique=True))
        most -= int(rest[k])
    return overlap >= need


def _links(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of the pairs ``(a, b)`` of nodes whose product reaches the similarity."""
    kind = rows.schema["node"].dataType.simpleString()
    small = rows.select("node", "n", "cells")

    def sift(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
            x, y = (batch.column(c).to_pylist() for c in ("xa", "xb"))
            keep = np.array([p is None or q is None for p, q in zip(x, y, strict=True)], bool)
            at = np.flatnonzero(~keep)
            if len(at):
                one, other = (np.frombuffer(b"".join(side[i] for i in at), np.uint8).reshape(-1, CELLS) for side in (x, y))
                keep[at] = np.minimum(one, other).sum(axis=1, dtype=np.int64) >= _needed(n[at], m[at])
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = [small.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("cells").alias(f"x{k}")) for k in ("a", "b")]
    pairs = settle(pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(sift, f"a {kind}, b {kind}"))
    left = rows.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shared").alias("xa"))
    right = rows.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("xb"))

    def multiply(batches):
        for batch in batches:
            n, m = batch.column("na").to_pylist(), batch.column("nb").to_pylist()
            x, y = batch.column("xa"), batch.column("xb")
            keep = [
                overlap_reaches(x[i].values.to_numpy().view(np.uint64), y[i].values.to_numpy().view(np.uint64), n[i], m[i])
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = settle(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(multiply, f"a {kind}, b {kind}"))
    drop_settled(pairs)
    return links


def tile_links(x: list[np.ndarray], y: list[np.ndarray], n: np.ndarray, m: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two tiles that reach the similarity, of the pairs marked in ``apart``.

    Overlaps add up over blocks of the columns that both tiles have; rows without a pair left leave the product.
    """
    need = -(-SIMILARITY * (n[:, None] + m) // (100 + SIMILARITY))
    flat = [np.concatenate([*side, np.zeros(0, np.uint64)]) for side in (x, y)]
    columns = np.intersect1d(*flat)
    cells, rest = [], []
    for side, values in zip((x, y), flat, strict=True):
        row = np.repeat(np.arange(len(side)), [len(v) for v in side])
        at = np.minimum(np.searchsorted(columns, values), max(0, len(columns) - 1))
        both = columns[at] == values if len(columns) else np.zeros(len(values), bool)
        cells.append((row[both], at[both]))
        rest.append(np.bincount(row[both], minlength=len(side)))
    counts = np.zeros((len(x), len(y)), np.float32)
    alive = apart & (np.minimum(rest[0][:, None], rest[1]) >= need)
    for start in range(0, len(columns), TILE_COLUMNS):
        rows = [np.flatnonzero(alive.any(axis=1 - k)) for k in (0, 1)]
        if not len(rows[0]):
            break
        blocks = []
        for k, (row, at) in enumerate(cells):
            place = np.full(len(rest[k]), -1)
            place[rows[k]] = np.arange(len(rows[k]))
            inside = (at >= start) & (at < start + TILE_COLUMNS)
            rest[k] = rest[k] - np.bincount(row[inside], minlength=len(rest[k]))
            inside &= place[row] >= 0
            block = np.zeros((len(rows[k]), min(TILE_COLUMNS, len(columns) - start)), np.float32)
            block[place[row[inside]], at[inside] - start] = 1
            blocks.append(block)
        within = np.ix_(*rows)
        counts[within] += blocks[0] @ blocks[1].T
        alive[within] &= counts[within] + np.minimum(rest[0][rows[0]][:, None], rest[1][rows[1]]) >= need[within]
    return np.nonzero(alive & (counts >= need))


def _star_links(stars: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between rows around one pivot that lie in different components; ``stars`` has (pivot, node, root, own)."""
    sized = stars.join(rows.select("node", F.col("n").alias("size")), "node")
    kind = rows.schema["node"].dataType.simpleString()
    meeting = ["pivot", "outer", "other", "inside"]
    small = star_tiles(sized, TILE_ROWS, TILE_SHINGLES).join(rows.select("node", "n", "cells"), "node")

    def sift(pdf):
        sides = [np.flatnonzero(pdf["side"] == s) for s in (0, 1)]
        if not pdf["inside"].iloc[0] and pdf["outer"].iloc[0] == pdf["other"].iloc[0]:
            sides[1] = sides[0]
        n, root = pdf["n"].to_numpy(), pdf["root"].to_numpy()
        unbounded = np.array([c is None for c in pdf["cells"]], bool)
        cells = np.frombuffer(b"".join(bytes(CELLS) if c is None else c for c in pdf["cells"]), np.uint8).reshape(-1, CELLS)
        met = np.zeros(len(pdf), bool)
        for i in sides[0]:
            most = np.minimum(cells[i], cells[sides[1]]).sum(axis=1, dtype=np.int64)
            good = (unbounded[i] | unbounded[sides[1]] | (most >= _needed(n[i], n[sides[1]]))) & (root[sides[1]] != root[i])
            met[i] |= good.any()
            met[sides[1][good]] = True
        return pdf.loc[met, [*meeting, "side", "node", "root"]]

    sifted = settle(small.groupBy(*meeting).applyInPandas(sift, f"pivot {kind}, outer int, other int, inside boolean, side int, node {kind}, root {kind}"))
    # rows without a meeting left keep their columns to themselves
    few, _ = parted(rows, sifted, "node")
    tiles = sifted.join(few.select("node", "n", "shared"), "node")

    def multiply(pdf):
        import pandas as pd

        sides = [pdf[pdf["side"] == s] for s in (0, 1)]
        if not pdf["inside"].iloc[0] and (pdf["outer"].iloc[0] == pdf["other"].iloc[0]):
            sides[1] = sides[0]
        x, y = ([v.view(np.uint64) for v in s["shared"]] for s in sides)
        roots = [s["root"].to_numpy() for s in sides]
        i, j = tile_links(x, y, *(s["n"].to_numpy() for s in sides), roots[0][:, None] != roots[1])
        i, j = spanning(i, j + len(x), len(x) + len(y))
        nodes = np.concatenate([s["node"].to_numpy() for s in sides])
        return pd.DataFrame({"a": nodes[i], "b": nodes[j]})

    found = settle(tiles.groupBy(*meeting).applyInPandas(multiply, f"a {kind}, b {kind}").where("a <> b"))
    drop_settled(sifted)
    return found


def jaccard_components(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable over links."""
    docs = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    profiles = _profiles(docs, width)
    rows = settle(
        profiles.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest")
        .agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("first").alias("first"), F.first("shared").alias("shared"), F.first("cells").alias("cells"))
    )
    entries = rows.select("node", "n", F.explode("first").alias("gram"))
    pivots = settle(
        entries.groupBy("gram").agg(F.min(F.struct("node", "n")).alias("pivot"), F.count("*").alias("met")).where("met > 1")
        .select("gram", "pivot")
    )
    near_pivot = settle(
        entries.join(pivots, "gram").where((F.col("node") != F.col("pivot.node")) & _sizes_fit(F.col("n"), F.col("pivot.n")))
        .select(F.col("pivot.node").alias("a"), F.col("node").alias("b")).distinct()
    )
    links = _links(near_pivot, rows)
    drop_settled(near_pivot)
    roots = components(links)
    placed = entries.join(roots, "node", "left").select("gram", "node", "n", F.coalesce("root", "node").alias("root"))
    split = settle(
        placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("gram")
    )
    around = placed.join(split, "gram", "left_semi").join(pivots, "gram").select(F.col("pivot.node").alias("pivot"), "node", "root").distinct()
    pivot_root = roots.select(F.col("node").alias("pivot"), F.col("root").alias("of_pivot"))
    stars = settle(
        around.join(pivot_root, "pivot", "left").select("pivot", "node", "root", (F.col("root") == F.coalesce("of_pivot", "pivot")).alias("own"))
    )
    more = _star_links(stars, rows)
    drop_settled(pivots, split, stars)
    roots = components(links.unionByName(more))
    of_digest = settle(
        rows.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("component_id"))
    )
    return profiles.select("id", "n", "digest").join(of_digest, "digest", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` without rows of which a near copy stays, each row judged by its own text.

    Of every component of texts, told apart by 128-bit digests, the row of the smallest id stays, nulls last, then that of the
    smallest hash. Equal texts of one id are one document, whose rows stay or go together; of equal rows without id one stays.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns]
    others = [F.col(f"`{c}`") for c in documents.columns if c.lower() != "text"]
    rows = documents.select(
        F.struct(*columns).alias("row"), F.col("doc_id").alias("id"), F.md5("text").alias("of_text"), F.xxhash64(F.to_json(F.struct(*others))).alias("of_row")
    )
    texts = documents.select(F.md5("text").alias("doc_id"), "text")
    groups = settle(jaccard_components(texts).where("n_shingles > 0").select(F.col("doc_id").alias("of_text"), F.col("component_id").alias("group")).distinct())
    # rows of an id and a text are one
    of_row = F.when(F.col("id").isNull(), F.col("of_row"))
    judged = settle(rows.select("id", "of_text", of_row.alias("of_row")).groupBy("id", "of_text", "of_row").count().join(groups, "of_text"))
    first = judged.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "of_text", "of_row")).alias("first"))
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("of_text") == F.col("first.of_text")) & of_row.eqNullSafe(F.col("first.of_row"))
    decided = judged.join(settle(first), "group").select("id", "of_text", "of_row", "count", same.alias("stays"))
    # one of several equal rows without id comes back below
    gone = settle(decided.where(~F.col("stays") | (F.col("id").isNull() & (F.col("count") > 1))))
    keyed = rows.withColumn("of_row", of_row)

    def met(x, y):
        return x["of_text"].eqNullSafe(y["of_text"]) & x["id"].eqNullSafe(y["id"]) & x["of_row"].eqNullSafe(y["of_row"])

    # only rows that may go are shuffled with their texts
    asked, clear = parted(keyed, gone, "of_text", "id", "of_row")
    kept = asked.join(gone, met(asked, gone), "left_anti").select("row.*")
    twice = gone.where("stays").select("of_text", "of_row")
    once = asked.where("id IS NULL").join(twice, ["of_text", "of_row"], "left_semi").groupBy("of_text", "of_row").agg(F.first("row").alias("row"))
    return clear.select("row.*").unionByName(kept).unionByName(once.select("row.*"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.a, x.b FROM (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS c FROM s JOIN s t USING (g) WHERE s.doc_id <> t.doc_id GROUP BY ALL) x
  JOIN n p ON p.doc_id = x.a JOIN n q ON q.doc_id = x.b WHERE 100 * x.c >= 75 * (p.n + q.n - x.c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) m USING (doc_id)
"""
