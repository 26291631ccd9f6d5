"""Benchmark decontamination: Wu-Manber search of all item windows in all texts.

The windows of a block of benchmark items (at most ``BLOCK_BYTES`` of text) are looked for at once. Block shift tables
skip positions at which no window can end, suffix-hash buckets name the windows that may begin there, and comparing their
bytes confirms an occurrence. The jumps of many stretches of text are taken in step, as numpy arrays. Documents are
scanned in place: nothing is shuffled, and a hot source or passage costs no more than other text.

Defined cases: null and empty texts and texts without words have no words and no hit. An item of fewer words than a
window is one window; an item without words never occurs. Items of one id count once; words hit by an item whose id is
null count, the item itself isn't listed. Repeated documents are judged one by one. Of an input column named as an added
one, the added one remains.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.shared import ALNUM_LOWERED, by_position, drop_settled, rows_of, settle, without

#: Bytes of benchmark text in a block, and the blocks that are broadcast, and that a task holds, at once.
BLOCK_BYTES, AT_ONCE = 4_000_000, 8
#: Windows are searched in groups by their length in bytes, so that a short one does not shorten all jumps.
LENGTH_GROUPS = (1, 6, 14, 28)
#: Starting positions that one stretch of text covers.
STRETCH = 512
ADDED = ("n_words", "hit_spans", "items")


class Windows:
    """All windows of some items as slices of one buffer, and the items in which each distinct window occurs."""

    def __init__(self, texts: list[bytes], width: int):
        parts = [b" ".join(t.translate(ALNUM_LOWERED).split()) for t in texts]
        found: dict[bytes, tuple[int, set[int]]] = {}
        for item, part in enumerate(parts):
            words = part.split()
            for i in range(max(1, len(words) - width + 1) if words else 0):
                cut = words[i : i + width]
                found.setdefault(b" " + b" ".join(cut) + b" ", (len(cut), set()))[1].add(item)
        self.buffer = np.frombuffer(b"".join(found) + b"\0" * 8, np.uint8)
        self.length = np.array([len(w) for w in found], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self.words = np.array([n for n, _ in found.values()], np.int64)
        self.item = np.array([i for _, s in found.values() for i in sorted(s)], np.int64)
        self.item_at = np.concatenate(([0], np.cumsum([len(s) for _, s in found.values()]))).astype(np.int64)


def _eights(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number; the buffer ends in eight spare bytes."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer.tobytes(), strides=(1,))


def _mask(n: np.ndarray | int) -> np.ndarray:
    n = np.minimum(np.asarray(n, np.uint64), np.uint64(8))
    return np.where(n >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (n * np.uint64(8) % np.uint64(64))) - np.uint64(1))


class Group:
    """Shift table and suffix buckets over the first ``m`` bytes of windows that are at least ``m`` long."""

    def __init__(self, windows: Windows, members: np.ndarray):
        eights = _eights(windows.buffer)
        self.m = int(windows.length[members].min())
        self.block = min(8, max(1, self.m // 3))
        self.mask = _mask(self.block)
        offsets = self.m - self.block + 1
        self.bits = int(np.clip(np.ceil(np.log2(4 * offsets * len(members) + 1)), 10, 22))
        self.shift = np.full(1 << self.bits, min(offsets, 60_000), np.uint16)
        for k in range(offsets):  # the later a block stands, the shorter the jump; later ones overwrite
            self.shift[self.hash(eights[windows.start[members] + k])] = min(offsets - 1 - k, 60_000)
        key = self.hash(eights[windows.start[members] + offsets - 1])
        order = np.argsort(key, kind="stable")
        self.window = members[order]
        self.key, at = np.unique(key[order], return_index=True)
        self.at = np.append(at, len(members))

    def hash(self, eight: np.ndarray) -> np.ndarray:
        mixed = (eight & self.mask) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, eights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and windows that agree in the hash of the suffix block."""
        offset = self.m - self.block
        low = np.arange(0, max(0, size - self.m + 1), STRETCH)
        high, at, seen, keys = np.minimum(low + STRETCH, size - self.m + 1), low, [], []
        while len(at):
            key = self.hash(eights[at + offset])
            jump = self.shift[key].astype(np.int64)
            stop = jump == 0
            seen.append(at[stop])
            keys.append(key[stop])
            at = at + np.maximum(jump, 1)
            inside = at < high
            at, high = at[inside], high[inside]
        at, key = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seen, keys))
        bucket = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        same = self.key[bucket] == key
        at, bucket = at[same], bucket[same]
        many = self.at[bucket + 1] - self.at[bucket]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.window[np.repeat(self.at[bucket], many) + step]


class Block:
    """One block of items, ready to search."""

    def __init__(self, ids: list[str | None], texts: list[bytes], width: int):
        self.ids, self.windows = ids, Windows(texts, width)
        self.groups, self.eights = [], _eights(self.windows.buffer)
        for low, high in zip(LENGTH_GROUPS, (*LENGTH_GROUPS[1:], 1 << 60), strict=True):
            members = np.flatnonzero((self.windows.length >= low) & (self.windows.length < high))
            if len(members):
                self.groups.append(Group(self.windows, members))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "eights"}

    def __setstate__(self, state):
        self.__dict__ |= state | {"eights": _eights(state["windows"].buffer)}

    def occurrences(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and windows of all occurrences in a buffer that ends in eight spare bytes."""
        eights, w, size = _eights(buffer), self.windows, len(buffer) - 8
        found = [group.candidates(eights, size) for group in self.groups]
        at, window = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
        fits = at + w.length[window] <= size
        at, window, k = at[fits], window[fits], 0
        done = []
        while len(at):  # eight bytes of every candidate at once
            same = ((eights[np.minimum(at + k, size)] ^ self.eights[np.minimum(w.start[window] + k, len(self.eights) - 1)]) & _mask(w.length[window] - k)) == 0
            at, window, k = at[same], window[same], k + 8
            whole = w.length[window] <= k
            done.append((at[whole], window[whole]))
            at, window = at[~whole], window[~whole]
        return tuple(np.concatenate([d[i] for d in done] or [np.zeros(0, np.int64)]) for i in (0, 1))


def search(texts: list[bytes], blocks: list[Block]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
    """Of every text: its number of words, the ranges of words hit (start, end), the ids of the items that occur."""
    parts = [b" ".join(t.translate(ALNUM_LOWERED).split()) for t in texts]
    buffer = np.frombuffer(b" " + b" \n ".join(parts) + b" " + b"\0" * 8, np.uint8)
    counts = np.array([p.count(b" ") + 1 if p else 0 for p in parts], np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))
    starts = np.flatnonzero((buffer[:-1] == 32) & (buffer[1:] > 32))
    change, pairs = np.zeros(first[-1] + 1, np.int64), set()
    for block in blocks:
        at, window = block.occurrences(buffer)
        word = np.searchsorted(starts, at)
        np.add.at(change, word, 1)
        np.add.at(change, word + block.windows.words[window], -1)
        doc = np.searchsorted(first, word, "right") - 1
        pair = np.unique(doc * max(1, len(block.windows.length)) + window)
        for d, w in zip(*np.divmod(pair, max(1, len(block.windows.length))), strict=True):
            at_items = block.windows.item[block.windows.item_at[w] : block.windows.item_at[w + 1]]
            pairs.update((int(d), block.ids[i]) for i in at_items if block.ids[i] is not None)
    hit = np.cumsum(change[:-1]) > 0
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    if hit.any():
        edge = np.flatnonzero(hit & (np.concatenate(([True], ~hit[:-1])) | np.isin(np.arange(len(hit)), first)))
        ends = np.flatnonzero(hit & (np.concatenate((~hit[1:], [True])) | np.isin(np.arange(1, len(hit) + 1), first))) + 1
        for a, b, d in zip(edge, ends, np.searchsorted(first, edge, "right") - 1, strict=True):
            spans[d].append((int(a - first[d]), int(b - first[d])))
    items: list[list[str]] = [[] for _ in texts]
    for d, i in sorted(pairs):
        items[d].append(i)
    return counts, spans, items


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """``(number, block)``: the benchmark in blocks of at most about ``BLOCK_BYTES``, built in tasks, ready to be searched.

    A single longer item is a block of its own.
    """
    rows = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).where("text is not null")
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0

    def build(batches):
        ids, held, many = [], [], 0

        def block():
            return pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(Block(ids, held, width))], pa.binary())], ["block"])

        for batch, texts in rows_of(batches, "text"):
            for key, found in zip(batch.column(0).to_pylist(), texts, strict=True):
                if held and many + len(found) > BLOCK_BYTES:
                    yield block()
                    ids, held, many = [], [], 0
                ids.append(key)
                held.append(found)
                many += len(found)
        if held:
            yield block()

    blocks = rows.repartition(max(1, -(-size // BLOCK_BYTES))).mapInArrow(build, "block binary")
    return settle(blocks.select(F.monotonically_increasing_id().alias("number"), "block"))


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words without overlaps, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, *, width: int = 10, text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``documents`` with ``n_words``, ``hit_spans`` (ranges of word numbers, end exclusive) and ``items`` (ids as text).

    A task holds ``AT_ONCE`` blocks. A benchmark of more blocks is searched in rounds, each over the settled rows of the one before.
    """
    spark = documents.sparkSession
    blocks = benchmark_blocks(benchmark, item_id, item_text, width)
    numbers = sorted(row.number for row in blocks.select("number").collect())  # a number for each block
    out = without(documents, *ADDED)
    columns = out.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    schema = f"{fields}, n_words long, hit_spans array<struct<start:int,end:int>>, items array<string>"
    rounds = [numbers[i : i + AT_ONCE] for i in range(0, len(numbers), AT_ONCE)] or [[]]
    for turn, which in enumerate(rounds):
        held = blocks.where(F.col("number").isin(which)).orderBy("number").collect() if which else []  # at most AT_ONCE blocks
        sent = spark.sparkContext.broadcast([bytes(row.block) for row in held])
        scanned = out.mapInArrow(_scan(sent, columns, text, turn > 0), schema)
        if turn + 1 < len(rounds):
            before, out = out, settle(scanned)
            sent.destroy()
            if turn:
                drop_settled(before)
    return scanned


def _scan(sent, columns: list[str], text: str, again: bool):
    """The search of the blocks that were ``sent``, added to what earlier rounds have found."""
    names = [*columns, *ADDED]

    def scan(batches):
        blocks = [pickle.loads(b) for b in sent.value]
        for batch, texts in rows_of(batches, text):
            counts, spans, items = search(texts, blocks)
            if again:
                old = [[(s["start"], s["end"]) for s in x] for x in batch.column(names.index("hit_spans")).to_pylist()]
                spans = [merged_spans(a + b) for a, b in zip(old, spans, strict=True)]
                items = [sorted({*a, *b}) for a, b in zip(batch.column(names.index("items")).to_pylist(), items, strict=True)]
            spans = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], SPANS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(counts, pa.int64()), spans, pa.array(items, pa.list_(pa.string()))], names
            )

    return scan


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def leak_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, words hit, items that occur (count and digest of their ids), and whether any word is hit."""
    found = find_leaks(documents.select("doc_id", "text"), benchmark.select("item_id", "text"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"),
    )


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those in which a benchmark window occurs."""
    rows, text = by_position(documents)
    return find_leaks(rows, benchmark, text=text).where(F.size("hit_spans") == 0).select(*rows.columns).toDF(*documents.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, win)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
