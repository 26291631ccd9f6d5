"""Spelling variant grouping: k-d trees over letter-count vectors find the words one edit away, letter order decides.

A word's vector counts its letters (``DIMS`` of them; accented letters share a few), so one replaced letter moves two counts by one
and one inserted letter moves one count: words one edit apart lie within L1 distance two if they are equally long and one
if one is longer. For every pair of lengths (equal, or one more) a k-d tree over the words of the longer length is searched with
the words of the other: a branch is left out when the distance to its box is too large. What is found is compared letter by letter.

The upper part of the trees divides the work: a length whose words are more than ``LEAF`` is split by letter counts, level by
level, from histograms added up over all words. A task gets the words of one leaf and those that can reach its box, builds the
lower part and searches it; it returns, for each word, how many near words it saw and the best of them, not the pairs.

The vocabulary is counted by task before it is shuffled. A chain of forms ends after at most log5 of the largest count, since
each form is five times as frequent; it is followed by doubling steps on settled tables.

Defined cases: a null or empty text has no words; a null id is written as an empty one before the colon; repeated rows count again.
Of all columns only ``doc_id`` and ``text`` are read. Words of equal letters (anagrams) cannot be split and share a leaf.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.shared import LOWERED, rows_of, settle

#: Words have at least so many code points and occurrences.
SHORTEST, LEAST = 6, 5
#: A run whose checksum this divides loses a letter.
SLIP = 199
#: A form is at least so many times as frequent as the word.
FACTOR = 5
#: Letters a to z, and the accented ones dealt to a few more.
ACCENTED = 6
DIMS = 26 + ACCENTED
#: Words of a leaf of the upper tree, and of a leaf of the lower one.
LEAF, SMALL = 16_384, 32
#: Distinct words that a task counts before it passes them on, and cells of one numpy step.
HELD, CELLS = 300_000, 1 << 22


# --- the vocabulary --------------------------------------------------------------------------------------------------


def slipped(run: str, prefix: int) -> str:
    """``run``, or without one letter where its checksum says so; ``prefix`` is the checksum of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``(word, n)``: the words of all texts, slips included, that are long and frequent enough."""

    def count(batches):
        runs, held = re.compile("[a-z\xc0-\xff]{%d,}" % shortest), Counter()

        def rows():
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for batch, texts in rows_of(batches, "text"):
            for key, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                prefix = zlib.crc32(key.encode() + b":")
                for run, n in Counter(runs.findall(text.translate(LOWERED).decode())).items():
                    word = slipped(run, prefix)
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) >= HELD:
                    yield from rows()
                    held.clear()
        yield from rows()

    read = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text")
    counts = read.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


# --- letter counts and their trees -----------------------------------------------------------------------------------


def _dims() -> np.ndarray:
    table = np.array([26 + c % ACCENTED for c in range(256)])
    table[97:123] = np.arange(26)
    return table


_DIM = _dims()


def letter_counts(words: list[bytes]) -> np.ndarray:
    """Counts of every word's letters, a row for each word; ``words`` are Latin-1, a byte for each letter."""
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cell = row * DIMS + _DIM[np.frombuffer(b"".join(words), np.uint8)]
    return np.bincount(cell, minlength=len(words) * DIMS).reshape(-1, DIMS).astype(np.int32)


class Splits:
    """The upper tree of one length: inner nodes split at ``count <= cut``; numbers of leaves never change once given."""

    def __init__(self):
        self.dim, self.cut, self.child = [-1], [0], [(0, 0)]

    def split(self, node: int, dim: int, cut: int) -> None:
        self.child[node] = (len(self.dim), len(self.dim) + 1)
        self.dim[node], self.cut[node] = dim, cut
        self.dim += [-1, -1]
        self.cut += [0, 0]
        self.child += [(0, 0), (0, 0)]

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        leaf = np.zeros(len(vectors), np.int64)
        for node, (dim, cut, child) in enumerate(zip(self.dim, self.cut, self.child, strict=True)):  # parents come first
            if dim >= 0:
                here = np.flatnonzero(leaf == node)
                leaf[here] = np.where(vectors[here, dim] <= cut, *child)
        return leaf

    def reached(self, vectors: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, and the vectors that reach their box with so many letters more and fewer."""
        low, high = np.zeros(DIMS, np.int32), np.full(DIMS, np.iinfo(np.int32).max)
        open_nodes = [(0, low, high, np.arange(len(vectors)))]
        while open_nodes:
            node, low, high, near = open_nodes.pop()
            near = near[within(vectors[near], low, high, more, fewer)]
            if not len(near):
                continue
            if self.dim[node] < 0:
                yield node, near
                continue
            left, right = high.copy(), low.copy()
            left[self.dim[node]], right[self.dim[node]] = self.cut[node], self.cut[node] + 1
            open_nodes += [(self.child[node][0], low, left, near), (self.child[node][1], right, high, near)]


def within(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, more: int, fewer: int) -> np.ndarray:
    """Whether a box can hold a vector with at most so many letters more and fewer than each of these."""
    return (np.maximum(low - vectors, 0).sum(axis=1) <= more) & (np.maximum(vectors - high, 0).sum(axis=1) <= fewer)


def upper_trees(words: DataFrame, leaf: int = LEAF) -> dict[int, Splits]:
    """A tree for every length of ``words``, split until a leaf has at most ``leaf`` words or words of equal counts only."""
    trees: dict[int, Splits] = {}
    sizes = words.groupBy(F.char_length("word").alias("length")).count().collect()  # a row for each length of a word
    trees.update({r.length: Splits() for r in sizes})
    large = {(r.length, 0) for r in sizes if r["count"] > leaf}
    while large:
        lengths, ask = {k for k, _ in large}, large

        def tally(batches, trees={k: trees[k] for k in lengths}, ask=ask):
            for batch in batches:
                for length, letters, _ in _by_length(batch, trees):
                    vectors, home = letters, trees[length].home(letters)
                    for node in np.unique(home):
                        if (length, int(node)) in ask:
                            mine = vectors[home == node]
                            for dim in range(DIMS):
                                value, n = np.unique(mine[:, dim], return_counts=True)
                                same = [np.full(len(value), x) for x in (length, node, dim)]
                                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (*same, value, n)], ["length", "node", "dim", "value", "n"])

        spread = words.select("word").mapInArrow(tally, "length long, node long, dim long, value long, n long")
        spread = spread.groupBy("length", "node", "dim", "value").agg(F.sum("n").alias("n"))
        of_node: dict[tuple[int, int], dict[int, dict[int, int]]] = {}
        for r in spread.collect():  # for each large node and letter, the few counts that occur
            of_node.setdefault((r.length, r.node), {}).setdefault(r.dim, {})[r.value] = r.n
        large = set()
        for (length, node), dims in sorted(of_node.items()):
            best = None
            for dim, values in sorted(dims.items()):
                order = sorted(values)
                below = np.cumsum([values[v] for v in order])
                for cut, n in zip(order[:-1], below[:-1], strict=True):
                    uneven = abs(2 * int(n) - int(below[-1]))
                    if best is None or uneven < best[0]:
                        best = uneven, dim, cut, int(n), int(below[-1])
            if best is None:
                continue  # all have the same letters
            _, dim, cut, n, total = best
            tree = trees[length]
            tree.split(node, dim, cut)
            large |= {(length, child) for child, many in zip(tree.child[node], (n, total - n), strict=True) if many > leaf}
    return trees


def _by_length(batch: pa.RecordBatch, lengths) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The batch's words of each length that ``lengths`` has: length, letter counts and row numbers."""
    words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
    size = np.array([len(w) for w in words], np.int64)
    for length in np.unique(size):
        if int(length) in lengths:
            rows = np.flatnonzero(size == length)
            for some in np.array_split(rows, max(1, len(rows) * max(int(length), DIMS) // CELLS)):
                yield int(length), letter_counts([words[i] for i in some]), some


def placed(words: DataFrame, trees: dict[int, Splits]) -> DataFrame:
    """Every word in its own leaf, and once more in each leaf that it searches: those of its length and of one letter more."""

    def place(batches):
        for batch in batches:
            for length, vectors, rows in _by_length(batch, trees):
                parts = [(length, trees[length].home(vectors), np.arange(len(rows)), False)]
                for other, fewer in ((length, 1), (length + 1, 0)):
                    if other in trees:
                        parts += [(other, np.full(len(near), node), near, True) for node, near in trees[other].reached(vectors, 1, fewer)]
                for other, leaf, near, asks in parts:
                    at = pa.array(rows[near])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(near), other), pa.int64()), pa.array(leaf, pa.int64()), pa.array([asks] * len(near), pa.bool_()),
                         batch.column(0).take(at), batch.column(1).take(at)],
                        ["length", "leaf", "asks", "word", "n"],
                    )

    return words.select("word", "n").mapInArrow(place, "length long, leaf long, asks boolean, word string, n long")


# --- the search in one leaf ------------------------------------------------------------------------------------------


def candidates(points: np.ndarray, asking: np.ndarray, fewer: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of points, and of asking vectors, at L1 distance ``1 + fewer`` at most, by a search of the points' k-d tree."""
    nodes = [(np.arange(len(points)), np.arange(len(asking)))]
    while nodes:
        mine, near = nodes.pop()
        box = points[mine]
        low, high = box.min(axis=0), box.max(axis=0)
        near = near[within(asking[near], low, high, 1, fewer)]
        if not len(near):
            continue
        spread = high - low
        if len(mine) > SMALL and spread.any():
            dim = int(np.argmax(box.var(axis=0) * (spread > 0)))
            value = np.sort(box[:, dim])
            cut = min(value[len(value) // 2], high[dim] - 1)
            left = box[:, dim] <= cut
            nodes += [(mine[left], near), (mine[~left], near)]
            continue
        step = max(1, CELLS // (len(mine) * DIMS))
        for i in range(0, len(near), step):
            some = near[i : i + step]
            far = np.abs(box[None] - asking[some][:, None]).sum(axis=2, dtype=np.int64)
            a, p = np.nonzero(far <= 1 + fewer)
            yield mine[p], some[a]


def _letters(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of ``x`` and ``y`` differ in one letter, or, where ``y`` is a letter longer, by one inserted letter."""
    length = x.shape[1]
    same = x == y[:, :length]
    if y.shape[1] == length:
        return (~same).sum(axis=1) == 1
    shifted = x == y[:, 1:]
    start = np.where(same.all(axis=1), length, np.argmin(same, axis=1))  # equal letters from the start
    end = np.where(shifted.all(axis=1), length, np.argmin(shifted[:, ::-1], axis=1))  # and from the end
    return start + end >= length


def _search(key, pdf):
    """For each word of a leaf: near words seen here, and of the most frequent one its count and itself."""
    import pandas as pd

    length = int(key[0])
    points, asking = pdf[~pdf["asks"]], pdf[pdf["asks"]]
    seen = []  # (word, its near word, that one's n)
    words, counts = points["word"].to_numpy(), points["n"].to_numpy()
    if len(points):
        encoded = [w.encode("latin-1") for w in words]
        vectors = letter_counts(encoded)
        for shorter in (0, 1):
            ask = asking[asking["word"].str.len() == length - shorter]
            if not len(ask):
                continue
            other, many = ask["word"].to_numpy(), ask["n"].to_numpy()
            theirs = [w.encode("latin-1") for w in other]
            for p, a in candidates(vectors, letter_counts(theirs), 1 - shorter):
                step = max(1, CELLS // length)
                for i in range(0, len(p), step):
                    u, v = p[i : i + step], a[i : i + step]
                    good = one_edit(_letters([theirs[j] for j in v], length - shorter), _letters([encoded[j] for j in u], length))
                    u, v = u[good], v[good]
                    seen.append((other[v], words[u], counts[u]))
                    if shorter:  # words of one length ask each other, a longer word never asks
                        seen.append((words[u], other[v], many[v]))
    if not seen:
        return pd.DataFrame({"word": [], "n_near": [], "best": [], "best_n": []})
    found = pd.DataFrame({k: np.concatenate([s[i] for s in seen]) for i, k in enumerate(("word", "best", "best_n"))})
    found = found.sort_values(["word", "best_n", "best"], ascending=[True, False, True])
    groups = found.groupby("word", sort=False)
    best = groups.first().reset_index()
    best["n_near"] = groups.size().to_numpy()
    return best[["word", "n_near", "best", "best_n"]]


# --- words, forms and roots ------------------------------------------------------------------------------------------


def near_words(words: DataFrame, leaf: int = LEAF) -> DataFrame:
    """``(word, n_near, best, best_n)`` for the words of ``(word, n)`` that have near ones; of equal counts the smallest word is best."""
    spread = placed(words, upper_trees(words, leaf)).groupBy("length", "leaf")
    found = spread.applyInPandas(_search, "word string, n_near long, best string, best_n long")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    ).select("word", "n_near", "top.best", (-F.col("top.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the words of ``(word, form)``; every step doubles how far a chain is followed."""
    chains = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if chains.join(onward, "root", "left_semi").isEmpty():
            return chains
        chains = settle(chains.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def spelling_variants(docs: DataFrame, leaf: int = LEAF) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary of ``docs``."""
    words = settle(word_counts(docs))
    near = settle(near_words(words, leaf))
    is_form = F.col("best_n") >= FACTOR * F.col("n")
    report = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    report = settle(report)
    ends = roots(report.where("form is not null").select("word", "form"))
    return report.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS key, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
counted AS (SELECT key, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
  SELECT *, list_transform(range(1, length(h), 2), lambda i: CAST(
    instr('123456789ABCDEF', h[i]) * 16 + instr('123456789ABCDEF', h[i + 1]) AS BIGINT)) AS b
  FROM (SELECT *, hex(encode(key || ':' || run)) AS h FROM counted)),
summed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], b), lambda c, x: list_reduce(
    list_concat([xor(c, x)], range(8)), lambda s, k: xor(s >> 1, 3988292384 * (s & 1))))) AS crc FROM bytes),
slips AS (
  SELECT CASE WHEN crc % 199 = 0 THEN run[: crc % length(run)] || run[crc % length(run) + 2 :] ELSE run END AS word, n FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slips WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON b.word = a.rest),
near AS (SELECT word, count(*) AS n_near FROM pairs GROUP BY word),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN near USING (word) LEFT JOIN best USING (word)),
chain AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS last FROM forms UNION ALL SELECT c.word, f.form FROM c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL)
  SELECT c.word, c.last AS root FROM c JOIN forms f ON f.word = c.last WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN chain USING (word)
"""
