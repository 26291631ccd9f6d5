"""What several operators share: settled tables, row chunks, word hashing, components of a link table."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallmetrics.session import remove_folder, shared_dir

#: Bytes of text that one numpy step works on; a longer text is a step of its own.
CHUNK_BYTES = 500_000

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: Byte tables: A-Z lower-cased; the second also blanks every ASCII byte that is no digit and no letter.
LOWERED = bytes.maketrans(_UPPER, _LOWER)
ALNUM_LOWERED = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the folder all executors reach; a local session without one gets a temporary one."""
    folder = shared_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="settled-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: lost executors cost no recomputation beyond it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_settled(*tables: DataFrame) -> None:
    """Remove settled tables that nothing will read again."""
    for table in tables:
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        if len(folders) == 1:
            remove_folder(table.sparkSession, folders.pop())


def tidy(spark: SparkSession) -> None:
    """Have the driver collect its garbage now, of which a row of many small queries leaves much.

    Spark removes the shuffle files and broadcasts of earlier queries only when what named them on the driver has been collected.
    """
    gc.collect()
    spark._jvm.System.gc()


def packed_numbers(numbers: np.ndarray, level: int = 1) -> bytes:
    """32-bit numbers, their lowest bytes first and their highest last, compressed."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), level)


def unpacked_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


def packed_steps(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as steps from one to the next, which take fewer bytes."""
    return packed_numbers(np.diff(ascending, prepend=np.uint32(0)))


def unpacked_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_numbers(data), dtype=np.uint32)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add, whatever their letter case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def by_position(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with its columns named by position, which clash with no added one, and the name that ``text`` then has."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names[[c.lower() for c in df.columns].index("text")]


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, a null as empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(sizes: list[int], most: int = CHUNK_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text and ``rows`` rows each, at least one row; ``sizes`` are the texts' bytes."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (size + n > most or i - start >= rows):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 65_536)
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            if size > 4 * CHUNK_BYTES:  # of one very long text: not kept
                if name == "up":
                    up = table
                else:
                    return up, table
            _powers[name] = table
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes with every bit spread over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Words:
    """The words of some texts, as byte ranges of one buffer in which a blank divides words and a newline texts."""

    def __init__(self, texts: list[bytes], table: bytes):
        parts = [b" ".join(t.translate(table).split()) for t in texts]
        self.buffer = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        self.counts = np.array([p.count(b" ") + 1 if p else 0 for p in parts], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        gap = (self.buffer == 32) | (self.buffer == 10)  # neither occurs inside a word
        before = np.concatenate(([True], gap[:-1]))
        self.starts = np.flatnonzero(before & ~gap)
        self.ends = np.flatnonzero(gap & ~before)

    def prefix(self) -> tuple[np.ndarray, np.ndarray]:
        """Running polynomial hash of the buffer, and the powers that shift a range of it to its start."""
        up, down = power_tables(len(self.buffer) + 1)
        run = np.zeros(len(self.buffer) + 1, np.uint64)
        np.cumsum((self.buffer + np.uint64(1)) * up[: len(self.buffer)], out=run[1:])
        return run, down

    def ranges(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words ``first`` to ``last`` (inclusive word numbers) with the blanks between them."""
        run, down = self.prefix()
        start = self.starts[first]
        return mixed((run[self.ends[last]] - run[start]) * down[start])

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words, and where each text's runs begin; a shorter text is one run."""
        runs = np.where(self.counts >= width, self.counts - width + 1, np.minimum(self.counts, 1))
        at = np.concatenate(([0], np.cumsum(runs)))
        if not at[-1]:
            return np.zeros(0, np.uint64), at
        first = np.arange(at[-1]) - np.repeat(at[:-1], runs) + np.repeat(self.first[:-1], runs)
        last = np.minimum(first + width - 1, np.repeat(self.first[1:] - 1, runs))
        return self.ranges(first, last), at


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; root is the smallest node it reaches.

    Large-star and small-star steps in turn. Each step is settled, and both sides of its join are plain tables, so that
    a node with very many links is split between tasks.
    """
    stars = settle(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    while not _are_stars(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = settle(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        drop_settled(stars, least)
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        stars = settle(
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        drop_settled(large, least)
    tidy(links.sparkSession)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _are_stars(stars: DataFrame) -> bool:
    """Whether every node is either a centre or linked with one centre only."""
    ends = stars.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        stars.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")).distinct()
    )
    wrong = ends.groupBy("u").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).where("out + least(into, 1) > 1")
    return wrong.isEmpty()


def least_reached(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node that every node reaches over links."""
    label, changed = np.arange(nodes), True
    while changed:
        least = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]
        changed = bool((label != before).any())
    return label


def spanning(u: np.ndarray, v: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes: these themselves if they are few, else one from each node to its smallest."""
    if len(u) <= 4 * nodes:
        return u, v
    label = least_reached(u, v, nodes)
    node = np.flatnonzero(label != np.arange(nodes))
    return node, label[node]


def numbered(count: Column) -> Column:
    """The numbers 0 to ``count - 1``."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def top_bits(tasks: float, bits: int) -> int:
    """First bits of a hash that cut the hash space into about ``tasks`` blocks."""
    return max(0, min(bits - 5, int(np.ceil(np.log2(max(1.0, tasks))))))


def packed_slots(df: DataFrame, hashes: Callable, tasks: float, bits: int) -> DataFrame:
    """The 64-bit hashes that ``hashes`` yields, an array for each chunk, counted there and packed by block of the hash space.

    Blocks are cut by the first bits of a hash, about ``tasks`` of them; a row holds the next 32 bits of a chunk's hashes,
    those met once and others with their counts.
    """
    top = top_bits(tasks, bits)
    blocks = 1 << top

    def pack(batches):
        for found in hashes(batches):
            if not len(found):
                continue
            found = np.sort(found)
            new = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
            many = np.diff(np.append(new, len(found))).astype(np.uint32)
            found = found[new]
            short = ((found << np.uint64(top)) >> np.uint64(32)).astype(np.uint32)
            starts = np.searchsorted(found, np.arange(blocks, dtype=np.uint64) << np.uint64(64 - top)) if top else np.zeros(1, int)
            cuts = np.append(starts, len(found))
            rows = {"block": [], "once": [], "more": [], "counts": []}
            for b in np.flatnonzero(np.diff(cuts)):
                part, once = short[cuts[b] : cuts[b + 1]], many[cuts[b] : cuts[b + 1]] == 1
                rows["block"].append(int(b))
                rows["once"].append(packed_steps(part[once]))
                rows["more"].append(packed_steps(part[~once]))
                rows["counts"].append(packed_numbers(many[cuts[b] : cuts[b + 1]][~once]))
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "block" else pa.binary()) for k, v in rows.items()})

    return df.mapInArrow(pack, "block int, once binary, more binary, counts binary").withColumn("top", F.lit(top))


#: Multipliers of the places that a hash has in its block of a table; the first place is its beginning.
_WAYS = (1, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _place(short: np.ndarray, way: int, width: int) -> np.ndarray:
    """A place of ``width`` bits in its block, for hashes of 32 bits."""
    if way:
        short = short * np.uint32(_WAYS[way])
        short ^= short >> np.uint32(15)
        short *= np.uint32(0x2C1B3C6D)
    return short >> np.uint32(32 - width)


def bit_tables(packed: DataFrame, least: tuple[int, ...], bits: int, ways: int = 1) -> list[np.ndarray]:
    """For each count in ``least`` a table of ``2 ** bits`` bits: a hash that starts so occurs as often, or more.

    With several ``ways`` a hash has as many bits in its block, and is looked up by ``bits_set``.
    """

    def add_up(pdf):
        import pandas as pd

        top = int(pdf["top"].iloc[0])
        once, more = ([unpacked_steps(x) for x in pdf[column]] for column in ("once", "more"))
        key = np.concatenate(once + more)
        count = np.concatenate([np.ones(len(x), np.uint32) for x in once] + [unpacked_numbers(x) for x in pdf["counts"]])
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        total, key = np.add.reduceat(count.astype(np.int64), new), key[new]
        found = []
        for n in least:
            held = np.zeros(1 << (bits - top), bool)
            for way in range(ways):
                held[_place(key[total >= n], way, bits - top)] = True
            found.append(np.packbits(held).tobytes())
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "tables": [found]})

    tables = [np.zeros((1 << bits) // 8, np.uint8) for _ in least]
    parts = settle(packed.groupBy("block").applyInPandas(add_up, "block int, tables array<binary>"))
    for row in parts.toLocalIterator():  # the tables, cut by block; the driver holds a few blocks besides them
        for table, part in zip(tables, row.tables, strict=True):
            part = np.frombuffer(part, np.uint8)
            table[row.block * len(part) : (row.block + 1) * len(part)] = part
    drop_settled(parts)
    return tables


def bit_set(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def bits_set(table: np.ndarray, hashes: np.ndarray, bits: int, top: int, ways: int) -> np.ndarray:
    """Numbers of the hashes that have all their bits in a table of several ways, made in ``2 ** top`` blocks."""
    at = np.flatnonzero(bit_set(table, hashes, bits))
    for way in range(1, ways):
        found = hashes[at]
        slot = _place(((found << np.uint64(top)) >> np.uint64(32)).astype(np.uint32), way, bits - top).astype(np.int64)
        if top:
            slot |= (found >> np.uint64(64 - top)).astype(np.int64) << (bits - top)
        at = at[(table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1]
    return at


#: Bits of the table by which rows are parted, and least number of blocks in which it is made.
PARTED_BITS, PARTED_BLOCKS = 27, 16
#: Keys of such a table that one task adds up, about.
PARTED_KEYS = 1_000_000


def parted(rows: DataFrame, wanted: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Rows of which ``wanted``, a settled table, may have the keys, and rows of which it has them not, null being a key as others are.

    A bit table of fixed size tells them apart where they are read, so that a join need not shuffle the second ones.
    """
    bits, key = PARTED_BITS, F.xxhash64(*keys)

    def hashes(batches):
        for batch in batches:
            yield batch.column(0).to_numpy().view(np.uint64)

    blocks = max(PARTED_BLOCKS, wanted.count() / PARTED_KEYS)
    table = rows.sparkSession.sparkContext.broadcast(bit_tables(packed_slots(wanted.select(key), hashes, blocks, bits), (1,), bits)[0])

    def held(hashed: pa.Array) -> pa.Array:
        return pa.array(bit_set(table.value, hashed.to_numpy().view(np.uint64), bits))

    inside = F.arrow_udf(held, "boolean")(key)
    marked = rows.select("*", inside.alias("_inside"))
    return marked.where("_inside").drop("_inside"), marked.where("NOT _inside").drop("_inside")


def star_tiles(stars: DataFrame, most_rows: int, most_units: int) -> DataFrame:
    """Members of stars dealt to meetings of two tiles: all pairs of a star's members that lie in different components.

    ``stars`` has ``pivot``, ``node``, ``root`` (the node's component), ``own`` (it is the pivot's) and ``size`` (its units of
    work). Members of the pivot's component never meet each other. Groups ``(pivot, outer, other, inside)`` hold the two
    tiles as sides 0 and 1, or a tile that meets itself as side 0 alone.
    """
    of_star = stars.groupBy("pivot").agg(*[
        F.ceil(F.greatest(F.count_if(own) / most_rows, F.sum(F.when(own, F.col("size")).otherwise(0)) / most_units)).cast("int").alias(name)
        for name, own in (("inner", F.col("own")), ("outer", ~F.col("own")))
    ])
    tiled = settle(stars.join(settle(of_star.where("outer > 0")), "pivot"))
    number = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.when(F.col("own"), F.col("inner")).otherwise(F.col("outer")))).cast("int")

    def meeting(a, b, inside, side):
        return F.struct(a.alias("outer"), b.alias("other"), F.lit(inside).alias("inside"), F.lit(side).alias("side"))

    mine = F.col("mine")
    meetings = F.when(
        F.col("own"), F.transform(numbered(F.col("outer")), lambda t: meeting(t, mine, True, 1))
    ).otherwise(F.concat(
        F.transform(numbered(F.col("inner")), lambda t: meeting(mine, t, True, 0)),
        F.transform(numbered(F.col("outer")), lambda t: F.when(t >= mine, meeting(mine, t, False, 0)).otherwise(meeting(t, mine, False, 1))),
    ))
    return tiled.withColumn("mine", number).withColumn("meeting", F.explode(meetings)).select("pivot", "node", "root", "meeting.*")


def rows_of(batches: Iterable[pa.RecordBatch], text: str, rows: int = 1 << 30, most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Every batch cut into chunks of rows, with the bytes of its text column; one chunk's texts are copied at a time."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        sizes = pc.binary_length(column).fill_null(0).to_pylist()
        for a, b in chunks(sizes, most, rows):
            yield batch.slice(a, b - a), texts_of(column.slice(a, b - a))
        del batch, column
        pa.default_memory_pool().release_unused()
