"""Embedding near-dedup: PCA-ordered tiled comparison of all vectors of a label.

Unit vectors are rotated onto the principal axes of the whole table (a sum of products that Spark adds up), so that
leading coordinates carry most of a cosine. Two tiles are compared a few dimensions at a time: the products so far plus
the product of the norms of the remaining dimensions bound the cosine, pairs below the threshold drop out, and a pair of
tiles stops when none is left. Survivors close to the threshold are decided in double precision on the stored vectors.

Tiles are cut along the first axis: vectors that reach the threshold differ there by at most ``sqrt(2 - 2t)``, the width
of a slab, so a slab meets itself and its neighbour only. A slab of many vectors is cut into tiles of about ``TILE`` rows
by hash, whatever its label. Equal vectors are one row with a weight. Tiles return counts of links and a spanning set of
them, at most a few per vector, never all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or
id, link with nothing. Vectors of different length never link. Rows that repeat an id are further vectors of that id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallmetrics.llm.shared import components, numbered, settle, spanning

THRESHOLD = 0.93
#: Vectors of a tile, about.
TILE = 2048
#: Dimensions after which bounds are taken: these, and then as many more as there were.
FIRST_DIMENSIONS = 8
#: Below this share of remaining pairs a pair of tiles goes on pair by pair.
SPARSE = 0.02
#: Rows of a slab are spread over so many keys where they meet their slab's tile count.
SALTS = 16


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors as rows in double precision, filled up with zeros to ``size``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == size).all():
        return flat.reshape(-1, size)
    out = np.zeros((len(lengths), size))
    for i, (end, n) in enumerate(zip(np.cumsum(lengths), lengths, strict=True)):
        out[i, :n] = flat[end - n : end]
    return out


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # else squares of huge or tiny components over- or underflow
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Orthogonal axes (columns) of the unit vectors' second moments, the strongest first."""

    def moments(batches):
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_matrix(batch.column(0), size))
                total += unit.T @ unit
        yield pa.RecordBatch.from_pydict({"cell": np.arange(size * size), "value": total.ravel()})

    cells = vectors.mapInArrow(moments, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros(size * size)
    for row in cells.collect():  # dimensions squared, whatever the number of vectors
        total[row.cell] = row.value
    return np.ascontiguousarray(np.linalg.eigh(total.reshape(size, size))[1][:, ::-1])


def _rotated(reps: DataFrame, axes: np.ndarray, width: float) -> DataFrame:
    """Slab number along the first axis and the coordinates of every vector, single precision."""
    spark = reps.sparkSession
    handle, size = spark.sparkContext.broadcast(axes), len(axes)

    def rotate(batches):
        for batch in batches:
            turned = _unit(_matrix(batch.column(batch.schema.get_field_index("vector")), size)) @ handle.value
            slab = np.floor(turned[:, 0] / width).astype(np.int32)
            coordinates = [x.tobytes() for x in turned.astype(np.float32)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(slab), pa.array(coordinates, pa.binary())], [*batch.schema.names, "slab", "coordinates"]
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema)
    return reps.mapInArrow(rotate, f"{fields}, slab int, coordinates binary")


def linked_pairs(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` (coordinates along the axes, single precision) with a cosine of the threshold or more."""
    size = a.shape[1]
    slack = np.float32(4e-7 * size + 1e-6)  # more than rounding of single precision can move a cosine
    rest_a, rest_b = (np.sqrt(np.maximum(0, np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])) for x in (a, b))
    done, step = 0, min(FIRST_DIMENSIONS, size)
    dots, i = np.zeros((len(a), len(b)), np.float32), None
    while done < size:
        upto = min(size, done + step)
        if i is None:
            dots += a[:, done:upto] @ b[:, done:upto].T
            bound = dots if upto == size else dots + np.outer(rest_a[:, upto], rest_b[:, upto])
            alive = bound >= threshold - slack
            if own:
                alive &= np.arange(len(a))[:, None] < np.arange(len(b))
            if upto == size or alive.mean() < SPARSE:
                i, j = np.nonzero(alive)
                value = dots[i, j]
        else:
            for s in range(0, len(i), 200_000):
                part = slice(s, s + 200_000)
                value[part] += np.einsum("nd,nd->n", a[i[part], done:upto], b[j[part], done:upto])
            bound = value if upto == size else value + rest_a[i, upto] * rest_b[j, upto]
            alive = bound >= threshold - slack
            i, j, value = i[alive], j[alive], value[alive]
        if i is not None and not len(i):
            break
        step, done = upto, upto
    near = np.flatnonzero(np.abs(value - threshold) <= slack)
    keep = value >= threshold
    for s in range(0, len(near), 100_000):
        part = near[s : s + 100_000]
        x, y = raw_a[i[part]], raw_b[j[part]]
        dot, norm = (x * y).sum(axis=1), np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
        keep[part] = dot / norm >= threshold
    return i[keep], j[keep]


def _compared(tiles: DataFrame, size: int, threshold: float, raw: str) -> DataFrame:
    """Per pair of tiles, rows ``(node, links, other)``: link counts, and links ``node``-``other`` that span them."""
    node = tiles.schema["node"].dataType

    def compare(pdf):
        import pandas as pd

        sides = [pdf[pdf["side"] == s] for s in (0, 1)]
        own = not len(sides[1]) and bool(pdf["own"].iloc[0])
        if own:
            sides[1] = sides[0]
        out = {"node": [], "links": [], "other": []}
        if len(sides[0]) and len(sides[1]):
            turned = [np.frombuffer(b"".join(s["coordinates"]), np.float32).reshape(len(s), size) for s in sides]
            # the scale of a vector does not change its cosine, but could over- or underflow its square
            plain = [np.frombuffer(b"".join(s["raw"]), raw).reshape(len(s), size).astype(np.float64) for s in sides]
            plain = [x / np.abs(x).max(axis=1, keepdims=True) for x in plain] if raw == "<f8" else plain
            i, j = linked_pairs(*turned, *plain, threshold, own)
            ids, weight = [s["node"].to_numpy() for s in sides], [s["weight"].to_numpy() for s in sides]
            counts = [np.bincount(i, weight[1][j], len(ids[0])), np.bincount(j, weight[0][i], len(ids[1]))]
            if own:
                counts = [counts[0] + counts[1], np.zeros(len(ids[1]))]
            u, v = spanning(i, j if own else j + len(ids[0]), len(ids[0]) + (0 if own else len(ids[1])))
            both = ids[0] if own else np.concatenate(ids)
            for n, c in zip(ids, counts, strict=True):
                out["node"] += list(n[c > 0])
                out["links"] += [int(x) for x in c[c > 0]]
                out["other"] += [None] * int((c > 0).sum())
            out["node"] += list(both[u])
            out["links"] += [0] * len(u)
            out["other"] += list(both[v])
        return pd.DataFrame(out).astype({"links": "int64", "other": "Int64", "node": "int64"})

    assert isinstance(node, T.LongType)
    return tiles.groupBy("part", "slab", "tile", "other_slab", "other_tile").applyInPandas(compare, "node long, links long, other long")


def similar_vectors(
    vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, tile: int = TILE,
) -> DataFrame:
    """Per vector: ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable) and ``kept`` (it is its own)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    usable = rows.where(_usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    reps = settle(usable.groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").alias("weight")))
    size = reps.select(F.max(F.size("vector"))).first()[0] or 1
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) * (1 + 1e-6) + 1e-6
    element = reps.schema["vector"].dataType.elementType
    raw = "<f4" if isinstance(element, T.FloatType) else "<f8"

    def pack(batches):
        for batch in batches:
            matrix = _matrix(batch.column(batch.schema.get_field_index("vector")), size).astype(raw)
            packed = pa.array([x.tobytes() for x in matrix], pa.binary())
            names = [n for n in batch.schema.names if n != "vector"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), packed], [*names, "raw"])

    turned = _rotated(reps.select("node", "label", "weight", "vector"), principal_axes(reps.select("vector"), size), width)
    turned = turned.withColumn("part", F.struct("label", F.size("vector").alias("size"))).drop("label")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turned.drop("vector").schema)
    turned = settle(turned.mapInArrow(pack, f"{shape}, raw binary"))

    counts = turned.groupBy("part", "slab").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    around = settle(
        counts.select("part", "slab", "tiles").join(counts.select("part", (F.col("slab") - 1).alias("slab"), F.col("tiles").alias("above")), ["part", "slab"], "left")
        .join(counts.select("part", (F.col("slab") + 1).alias("slab"), F.col("tiles").alias("below")), ["part", "slab"], "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = turned.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(around, ["part", "slab", "salt"])
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles")).cast("int")

    def meeting(slab, tile_no, other_slab, other_tile, side):
        return F.struct(
            slab.alias("slab"), tile_no.alias("tile"), other_slab.alias("other_slab"), other_tile.alias("other_tile"),
            F.lit(side).alias("side"), ((slab == other_slab) & (tile_no == other_tile)).alias("own"),
        )

    slab, own = F.col("slab"), F.col("mine")
    meetings = F.concat(
        F.transform(numbered(F.col("tiles")), lambda t: F.when(t >= own, meeting(slab, own, slab, t, 0)).otherwise(meeting(slab, t, slab, own, 1))),
        F.transform(numbered(F.coalesce("above", F.lit(0))), lambda t: meeting(slab, own, slab + 1, t, 0)),
        F.transform(numbered(F.coalesce("below", F.lit(0))), lambda t: meeting(slab - 1, t, slab, own, 1)),
    )
    tiles = salted.withColumn("mine", mine).select("part", "node", "weight", "coordinates", "raw", F.explode(meetings).alias("m")).select(
        "part", "node", "weight", "coordinates", "raw", "m.*"
    )
    found = settle(_compared(tiles, size, threshold, raw))
    roots = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_rep = settle(
        reps.join(linked, "node", "left").join(roots, "node", "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("component"))
    )
    placed = usable.join(of_rep, ["label", "vector"]).select("id", "n_links", "component")
    # rows that cannot link keep themselves
    alone = rows.where(~(_usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")
    )
    return placed.unionByName(alone).select(
        F.col("id").alias(vec_id), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept")
    )


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""
