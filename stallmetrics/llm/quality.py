"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text is a bag of terms: runs of three character classes (which see letter case, digits, punctuation and layout), hashed
words, and repeats of a word. Terms are weighted by the square root of their share and by the inverse document frequency
counted over all documents. A truncated SVD of a bounded sample of labelled texts (``SAMPLE`` rows, half of each label)
gives the latent axes. The sample's vectors, at most ``SAMPLE`` by ``AXES`` numbers, are broadcast; every document is
compared with all of them in blocks of exact cosine products, and its nearest ``NEIGHBOURS`` vote by similarity.
Votes are weighted so that the sample's labels count as often as among all learnt rows.

Defined cases: a null text is an empty one; a text without terms, or without any similar neighbour, scores the share of
label 1 among the rows learnt from (0.5 without such rows). Labels other than 0 and 1 and null ids teach nothing; of
conflicting labels of an id the lower one counts, of its texts the smallest. Of an input column named as an added one, the added one remains.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.shared import ALNUM_LOWERED, Words, by_position, rows_of, settle, without

#: Labelled rows that are learnt from at most; the rest only counts for the share of the labels.
SAMPLE = 2048
AXES = 48
NEIGHBOURS = 9
WORDS = 2048
#: The two terms for a repeated word stand against thousands of others; they count so many times more.
REPEAT_WEIGHT = 5.0
SEED = 11
#: Documents whose dense term counts are held at once.
ROWS = 128
ADDED = ("score", "predicted")

# Character classes; a byte that no entry names is lower case, another letter or a control character.
_NAMED = ["\n\r\x0b\x0c", " \t", ".", ",;:", "!", "?", "|", "*", "#$%&@", "\"'`()[]{}<>", "-_/\\", "0123456789"]


def _class_table() -> bytes:
    table = [14 if b < 32 or b == 127 else 15 if b >= 128 else 12 if chr(b).islower() else 13 if chr(b).isupper() else 14 for b in range(256)]
    for number, members in enumerate(_NAMED):
        for c in members:
            table[ord(c)] = number
    return bytes(table)


CLASSES = _class_table()
RUNS = 16**3
TERMS = RUNS + WORDS + 2


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of all terms, a row for each text."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer(b"".join(texts).translate(CLASSES), np.uint8).astype(np.int64)
    row = np.repeat(np.arange(n), sizes)
    cells = []
    if len(codes) > 2:
        inside = row[2:] == row[:-2]
        cells.append((row[2:] * TERMS + codes[:-2] * 256 + codes[1:-1] * 16 + codes[2:])[inside])
    words = Words(texts, ALNUM_LOWERED)
    total = int(words.first[-1])
    if total:
        number = np.arange(total)
        hashes, of = words.ranges(number, number), np.repeat(np.arange(n), words.counts)
        cells.append(of * TERMS + RUNS + (hashes % np.uint64(WORDS)).astype(np.int64))
        for back in (1, 2):
            if total > back:
                again = (hashes[back:] == hashes[:-back]) & (of[back:] == of[:-back])
                cells.append(of[back:][again] * TERMS + RUNS + WORDS + back - 1)
    return np.bincount(np.concatenate(cells), minlength=n * TERMS).reshape(n, TERMS) if cells else np.zeros((n, TERMS), np.int64)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    shares = np.sqrt(counts.astype(np.float32) / np.maximum(1, counts.sum(axis=1, keepdims=True)).astype(np.float32))
    shares *= idf
    return _unit(shares)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def inverse_frequencies(documents: DataFrame) -> np.ndarray:
    """Inverse document frequency of every term, counted over all documents."""

    def count(batches):
        seen, rows = np.zeros(TERMS, np.int64), 0
        for _, texts in rows_of(batches, "text", ROWS):
            seen += (term_counts(texts) > 0).sum(axis=0)
            rows += len(texts)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array([*found, -1], pa.int32()), "n": pa.array([*seen[found], rows], pa.int64())}
        )

    seen, rows = np.zeros(TERMS, np.int64), 0
    for row in documents.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if row.term < 0:
            rows = row.n
        else:
            seen[row.term] = row.n
    weights = np.log((1 + rows) / (1 + seen)) + 1
    weights[-2:] *= REPEAT_WEIGHT
    return weights.astype(np.float32)


@dataclass
class Model:
    """Term weights, latent axes, and the labelled vectors that vote."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    share: float

    def score(self, texts: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(texts), self.share)
        latent = _unit(_weighted(term_counts(texts), self.idf) @ self.axes)
        cosine = latent @ self.vectors.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) * self.weights[near]
        total = votes.sum(axis=1)
        return np.where(total > 0, np.minimum(1, (votes * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)), self.share)


def _axes(matrix: np.ndarray, axes: int) -> np.ndarray:
    """Right singular vectors of the largest singular values, by subspace iteration."""
    k = min(axes, *matrix.shape)
    guess = np.random.default_rng(SEED).standard_normal((matrix.shape[1], min(matrix.shape[1], k + 16))).astype(np.float32)
    for _ in range(4):
        guess, _ = np.linalg.qr(matrix.T @ (matrix @ guess))
    _, _, right = np.linalg.svd(matrix @ guess, full_matrices=False)
    return np.ascontiguousarray((guess @ right.T)[:, :k])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, *, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from the labels of rows that aren't held out; documents give the texts and the term frequencies."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        "label IN (0, 1) AND doc_id IS NOT NULL"
    ).where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    of_label = {row.label: row.n for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id", F.lit(SEED)), F.col("doc_id")]
    half = [known.where(F.col("label") == x).orderBy(*order).limit(sample // 2) for x in (0, 1)]
    chosen = settle(half[0].unionByName(half[1]))  # at most ``sample`` rows, so it may be broadcast
    # of texts of one id the smallest teaches
    taught = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.min("label").alias("label")).select("doc_id", "text", "label")

    def sparse(batches):
        for batch, texts in rows_of(batches, "text", ROWS):
            counts = term_counts(texts)
            terms = [np.flatnonzero(row) for row in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array([t.astype(np.int32).tobytes() for t in terms], pa.binary()),
                    pa.array([row[t].astype(np.int32).tobytes() for row, t in zip(counts, terms, strict=True)], pa.binary()),
                ],
                ["doc_id", "label", "terms", "counts"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = taught.mapInArrow(sparse, f"doc_id {kind}, label int, terms binary, counts binary")
    rows = rows.orderBy("doc_id").collect()  # at most ``sample`` rows of at most ``TERMS`` counts
    idf = inverse_frequencies(documents)
    given = np.array([row.label for row in rows], np.float64)
    all_rows = sum(of_label.values())
    share = of_label.get(1, 0) / all_rows if all_rows else 0.5
    if not len(rows):
        return Model(idf, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), given, given, share)
    matrix = np.zeros((len(rows), TERMS), np.float32)
    for start in range(0, len(rows), ROWS):  # dense counts of a few rows at once
        counts = np.zeros((len(rows[start : start + ROWS]), TERMS), np.int64)
        for i, row in enumerate(rows[start : start + ROWS]):
            counts[i, np.frombuffer(row.terms, np.int32)] = np.frombuffer(row.counts, np.int32)
        matrix[start : start + ROWS] = _weighted(counts, idf)
    axes = _axes(matrix, AXES)
    weights = np.where(given == 1, share / max(1, (given == 1).sum()), (1 - share) / max(1, (given == 0).sum()))
    return Model(idf, axes, _unit(matrix @ axes), given, weights, share)


def score(documents: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more)."""
    handle = documents.sparkSession.sparkContext.broadcast(model)
    source = without(documents, *ADDED)

    def rate(batches):
        for batch, texts in rows_of(batches, text, ROWS):
            scores = handle.value.score(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))], [*batch.schema.names, *ADDED]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(rate, f"{fields}, score double, predicted int")


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def drop_poor(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without those that the classifier rejects."""
    rows, text = by_position(documents)
    return score(rows, fit(documents, labels), text=text).where("predicted = 1").select(*rows.columns).toDF(*documents.columns)
