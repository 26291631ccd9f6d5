"""Phrase collocation mining: an FM-index per shard over word ids, extended in both directions, counts added up over shards.

Texts are cut into pieces and words; a task turns the words of its texts into shards of bounded size, one language each: a
vocabulary, and the bidirectional index of the words, pieces divided by the id 0 (rows in order of their first words, as deep as
the longest phrase). The shards are written once. From a shard's frequent phrases of one length, each is extended by every word that
stands left or right of it: a phrase that is both a right extension and a left extension of a frequent one is counted: it has the
same interval of the forward index whichever way it was reached. Since no part of a phrase is rarer than the phrase, nothing
frequent is lost.

Which phrases are frequent is decided by sums over all shards, length by length. A shard first gives the hashes of its phrases
with their counts, four bytes each, which are added up by block of the hash space into a table of bits: a phrase whose hash starts
so is frequent. The tables grow with the corpus up to ``MOST_BITS`` (128 MB, the bound of what is sent to every task); a bit too
many costs work, never a phrase, and none is missing. At the end every shard gives the phrases that pass the tables by name, packed by
block of a hash of the phrase, and their sums by name are exact. No shard is ever shuffled, and no list of phrases is held by the driver.

Defined cases: a null text is empty; a null language is ``und``; repeated rows count again. Texts without words yield nothing. A
word is whatever stands between blanks, digits and control characters included. Only ``text`` and ``lang`` are read, so
other columns cannot clash. Without any phrase of ``min_count`` occurrences the result is empty.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.llm.shared import bit_set, mixed, packed_numbers, packed_steps, rows_of, settle, unpacked_numbers, unpacked_steps

#: Words of a shard, about: a shard ends with the text that reaches it. The larger, the fewer times a phrase is counted by several
#: shards; a task holds about 60 bytes for each word of one.
SHARD_WORDS = 2 << 20
#: A phrase is kept from this many occurrences in its language, and is at most so many words long.
MIN_COUNT, LONGEST = 30, 4
#: A phrase goes when a longer one has at least so many hundredths of its occurrences.
DOMINATED = 80
#: Phrases reported for a language.
TOP = 2000
#: Scores are whole numbers: this times ``a / (l + r)``, rounded down.
SCALE = 2_000_000

#: Bits of a table of frequent hashes: one for so many words of the corpus, at most 2 ** MOST_BITS.
WORDS_A_BIT, MOST_BITS = 4, 30
#: Words of the corpus for each block of the hash space that one task adds up, about.
BLOCK_WORDS = 4_000_000

#: Phrases that a task adds up before it passes them on.
HELD = 400_000
#: Words of the shards that a task adds up before it passes their phrases on, at most: a count takes 32 bits.
MOST_WORDS = 1 << 31

#: A byte of no UTF-8 text stands for every mark that ends a piece.
END = 255
_BYTES = bytearray(range(256))
for _c in range(65, 91):
    _BYTES[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _BYTES[_c] = END
BYTES = bytes(_BYTES)
_MARK, _APART = bytes([END]), b" " + bytes([END]) + b" "


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, and a mark wherever a piece ends."""
    return text.translate(BYTES).replace(_MARK, _APART).split()


def word_before(text: np.ndarray, depth: int) -> np.ndarray:
    """The word before every row of the index of ``text``: its Burrows-Wheeler transform, rows sorted by ``depth`` words."""
    rank, width = text.astype(np.int32), 1
    order = np.argsort(rank) if depth == 1 else None
    while width < depth:
        key = rank.astype(np.int64)
        key *= int(rank.max()) + 1
        key += np.roll(rank, -width)
        order, width = np.argsort(key), width * 2
        if width < depth:
            new = np.diff(key[order], prepend=-1) != 0
            rank[order] = np.cumsum(new, dtype=np.int32)
        del key
    return np.roll(text, 1)[order]


class _Half:
    """One direction of the index: the word before every row, and where a word's rows go when it is put in front."""

    def __init__(self, before: np.ndarray):
        self.rows, self.before = len(before), before
        self.keys = before * np.int64(self.rows + 1)
        self.keys += np.arange(self.rows)
        self.keys.sort()

    def step(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The row that ``word`` before the row's words has: rows of smaller words, and of this word before smaller rows."""
        return np.searchsorted(self.keys, word.astype(np.int64) * (self.rows + 1) + row)

    def intervals(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin with the words of ``columns``, the last column searched first."""
        low = np.zeros(len(columns[0]), np.int64)
        high = np.full(len(columns[0]), self.rows)
        for word in reversed(columns):
            low, high = self.step(word, low), self.step(word, high)
        return low, high

    def extensions(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval number, word and count of all words before the intervals' rows, by interval and word."""
        size = high - low
        of = np.repeat(np.arange(len(low)), size)
        row = np.arange(len(of)) + np.repeat(low - np.cumsum(size) + size, size)
        base = int(self.before.max()) + 1
        key = np.sort(of * base + self.before[row])
        new = np.flatnonzero(np.concatenate(([len(key) > 0], key[1:] != key[:-1])))
        return key[new] // base, key[new] % base, np.diff(np.append(new, len(key)))


class PhraseIndex:
    """Bidirectional FM-index of word ids, 0 between pieces, from its two transforms."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.forward, self.backward = _Half(forward), _Half(backward)

    @staticmethod
    def of(ids: np.ndarray, depth: int) -> PhraseIndex:
        """The index of ``ids`` for phrases of at most ``depth`` words."""
        return PhraseIndex(word_before(ids, depth), word_before(ids[::-1], depth))

    def longer(self, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases one word longer than the rows of ``kept`` of which both parts are rows of it: the parts' numbers, and counts."""
        columns = list(kept.T)
        low, high = self.forward.intervals(columns)
        # to the right: the next words come sorted, so the extensions' intervals divide the phrase's own in this order
        of, word, count = self.backward.extensions(*self.backward.intervals(columns[::-1]))
        before = np.cumsum(count) - count
        first = np.searchsorted(of, np.arange(len(kept)))
        right = low[of] + before - np.append(before, 0)[first][of]
        inside = np.flatnonzero(word > 0)
        of, count, right = of[inside], count[inside], right[inside]
        # to the left: one step of the forward index
        left_of, left_word, _ = self.forward.extensions(low, high)
        inside = np.flatnonzero(left_word > 0)
        left_of, left = left_of[inside], self.forward.step(left_word[inside], low[left_of[inside]])
        _, a, b = np.intersect1d(right, left, assume_unique=True, return_indices=True)
        return of[a], left_of[b], count[a]


def shards(docs: DataFrame, most: int = SHARD_WORDS, longest: int = LONGEST) -> DataFrame:
    """``lang``, ``n`` (words), ``words`` (vocabulary, the mark of pieces first), ``many`` (its counts) and the two transforms of a shard."""

    def build(batches):
        held, size = {}, 0

        def rows():
            while held:
                lang, (vocabulary, parts) = held.popitem()
                ids = np.concatenate(parts)
                many = np.bincount(ids)
                many[0] = 0
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang]), "n": pa.array([int(many.sum())], pa.int64()),
                    **{name: pa.array([value], pa.binary()) for name, value in {
                        "words": zlib.compress(b"\n".join(vocabulary), 1), "many": packed_numbers(many),
                        "forward": packed_numbers(word_before(ids, longest)), "backward": packed_numbers(word_before(ids[::-1], longest)),
                    }.items()},
                })

        for batch, texts in rows_of(batches, "text"):
            for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                found = tokens(text)
                if lang not in held:
                    vocabulary = defaultdict()
                    vocabulary.default_factory = vocabulary.__len__  # a new word's id is the number of those before it
                    vocabulary[_MARK] = 0
                    held[lang] = vocabulary, []
                vocabulary, parts = held[lang]
                found.append(_MARK)
                parts.append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
                size += len(found)
                if size >= most:
                    yield from rows()
                    size = 0
        yield from rows()

    read = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")
    return read.mapInArrow(build, "lang string, n long, words binary, many binary, forward binary, backward binary")


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """64-bit hashes of a language's words."""
    key = hashlib.blake2b(lang.encode(), digest_size=32).digest()
    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8, key=key).digest() for w in words), np.uint64)


class _Shard:
    """A shard as a task reads it: its words and their hashes, and its phrases length by length."""

    def __init__(self, row: dict):
        self.lang, self.row = row["lang"], row
        self.words = zlib.decompress(row["words"]).split(b"\n")
        self.hashes = word_hashes(self.lang, self.words)

    def phrases(self, longest: int, tables: list[np.ndarray], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, hashes and counts of the phrases of 1, 2, … words of which all parts, and themselves where there is a table, pass."""
        many = unpacked_numbers(self.row["many"])
        grams = np.flatnonzero(many)[:, None]
        found, count = self.hashes[grams[:, 0]], many[grams[:, 0]]
        index = None
        for width in range(1, longest + 1):
            if width <= len(tables):
                good = bit_set(tables[width - 1], found, bits)
                grams, found, count = grams[good], found[good], count[good]
            yield grams, found, count
            if width == longest or not len(grams):
                return
            index = index or PhraseIndex(*(unpacked_numbers(self.row[x]).view(np.int32) for x in ("forward", "backward")))
            first, last, count = index.longer(grams)
            grams = np.column_stack((grams[first], grams[last, -1]))
            found = mixed(found[first] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[grams[:, -1]])


def _shards_of(batches) -> Iterator[_Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Shard(batch.slice(i, 1).to_pylist()[0])


_BLOCKS = "block int, once binary, more binary, counts binary"


def _blocks(found: np.ndarray, many: np.ndarray, top: int) -> pa.RecordBatch:
    """Distinct hashes and their counts by block (the hash's first ``top`` bits): of each the next 32 bits, those met once apart."""
    order = np.argsort(found)
    found, many = found[order], many[order].astype(np.uint32)
    short = ((found << np.uint64(top)) >> np.uint64(32)).astype(np.uint32)
    edges = np.arange(1, 1 << top, dtype=np.uint64) << np.uint64(64 - top) if top else np.zeros(0, np.uint64)
    cuts = np.concatenate(([0], np.searchsorted(found, edges), [len(found)]))
    used, once = np.flatnonzero(np.diff(cuts)), many == 1
    parts = [(short[a:b], once[a:b], many[a:b]) for a, b in zip(cuts[used], cuts[used + 1], strict=True)]
    columns = [packed_steps(h[o]) for h, o, _ in parts], [packed_steps(h[~o]) for h, o, _ in parts], [packed_numbers(n[~o]) for _, o, n in parts]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], ["block", "once", "more", "counts"])


def _table(packed: DataFrame, least: int, bits: int, top: int) -> np.ndarray:
    """A bit for every beginning of ``bits`` bits of a hash: one hash that starts so was counted ``least`` times, over all tasks."""

    def add_up(pdf):
        import pandas as pd

        once, more = (np.concatenate([unpacked_steps(x) for x in pdf[c]]) for c in ("once", "more"))
        key = np.concatenate((once, more))
        count = np.concatenate((np.ones(len(once), np.int64), *[unpacked_numbers(x) for x in pdf["counts"]]))
        order = np.argsort(key)
        key, count = key[order], count[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        held = np.zeros(1 << (bits - top), bool)
        held[(key[new] >> np.uint32(32 - (bits - top)))[np.add.reduceat(count, new) >= least]] = True
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "part": [np.packbits(held).tobytes()]})

    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in packed.groupBy("block").applyInPandas(add_up, "block int, part binary").collect():  # the table, cut by block
        part = np.frombuffer(row.part, np.uint8)
        table[row.block * len(part) : (row.block + 1) * len(part)] = part
    return table


def _frequent_hashes(held: DataFrame, width: int, tables: list[np.ndarray], bits: int, top: int, min_count: int) -> np.ndarray:
    """The table of frequent hashes of phrases of ``width`` words, given those of shorter ones."""
    sent = held.sparkSession.sparkContext.broadcast(tables)

    def count(batches):
        for shard in _shards_of(batches):
            *_, (grams, found, many) = shard.phrases(width, sent.value, bits)
            if len(grams) and grams.shape[1] == width:
                yield _blocks(found, many, top)

    table = _table(held.mapInArrow(count, _BLOCKS), min_count, bits, top)
    sent.destroy()
    return table


def _words_of(phrases: DataFrame, bits: int, top: int) -> np.ndarray:
    """The table of the hashes of all words of ``phrases``."""

    def words(batches):
        for batch in batches:
            of_lang = defaultdict(set)
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                of_lang[lang].update(phrase.split(b" "))
            found = np.unique(np.concatenate([np.zeros(0, np.uint64), *[word_hashes(lang, sorted(w)) for lang, w in of_lang.items()]]))
            if len(found):
                yield _blocks(found, np.ones(len(found), np.uint32), top)

    return _table(phrases.select("lang", "phrase").mapInArrow(words, _BLOCKS), 1, bits, top)


def _packed_names(counts: dict[bytes, int], top: int) -> tuple[list[int], list[bytes], list[bytes]]:
    """Blocks of phrases (the first ``top`` bits of a hash), of each the phrases in order and their counts, packed."""
    of_block: dict[int, list[bytes]] = defaultdict(list)
    for phrase in sorted(counts):
        of_block[zlib.crc32(phrase) >> (32 - top)].append(phrase)
    names = [zlib.compress(b"\n".join(phrases)) for phrases in of_block.values()]
    return list(of_block), names, [packed_numbers(np.array([counts[p] for p in phrases])) for phrases in of_block.values()]


def _summed(held: DataFrame, widths: range, tables: list[np.ndarray], bits: int, top: int, min_count: int) -> DataFrame:
    """``lang, phrase, width, f`` of the phrases of so many words that pass the tables and have ``min_count`` occurrences.

    A task adds up its own shards before it passes names on, packed by block of the phrases' hashes; blocks add them up by name.
    """
    sent = held.sparkSession.sparkContext.broadcast(tables)

    def name(batches):
        sums: dict[str, Counter] = defaultdict(Counter)
        size = 0

        def rows():
            for lang, counts in sums.items():
                blocks, names, many = _packed_names(counts, top)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(blocks), pa.string()), pa.array(blocks, pa.int32()), pa.array(names, pa.binary()), pa.array(many, pa.binary())],
                    ["lang", "block", "names", "counts"])
            sums.clear()

        for shard in _shards_of(batches):
            if size + shard.row["n"] > MOST_WORDS:
                yield from rows()
                size = 0
            size += shard.row["n"]
            words = pa.array(shard.words, pa.binary())
            for grams, _, many in shard.phrases(widths[-1], sent.value, bits):
                if len(grams) and grams.shape[1] in widths:
                    columns = [words.take(pa.array(c)) for c in grams.T]
                    phrase = columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, b" ")
                    sums[shard.lang].update(dict(zip(phrase.to_pylist(), many.tolist(), strict=True)))
            if sum(map(len, sums.values())) >= HELD:
                yield from rows()
                size = 0
        yield from rows()

    def add_up(key, packed):
        names, counts = (packed.column(c).to_pylist() for c in ("names", "counts"))
        phrase = pa.array([p for x in names for p in zlib.decompress(x).split(b"\n")], pa.binary())
        many = pa.array(np.concatenate([unpacked_numbers(x) for x in counts]), pa.int64())
        found = pa.table({"phrase": phrase, "f": many}).group_by("phrase").aggregate([("f", "sum")])
        found = found.filter(pc.greater_equal(found["f_sum"], min_count))
        lang = pa.array([key[0].as_py()] * len(found), pa.string())
        return pa.table({"lang": lang, "phrase": found["phrase"].cast(pa.string()), "f": found["f_sum"]})

    named = held.mapInArrow(name, "lang string, block int, names binary, counts binary")
    found = named.groupBy("lang", "block").applyInArrow(add_up, "lang string, phrase string, f long")
    found = settle(found.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("width"), "f"))
    sent.destroy()
    return found


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, width, f)`` of phrases of 2 to ``longest`` words met ``min_count`` times and of their words, and ``(lang, n)``, all words."""
    held = settle(shards(docs, shard_words, longest))
    total = held.agg(F.sum("n")).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(total / WORDS_A_BIT + 1)), 16, MOST_BITS))
    top = int(np.clip(np.ceil(np.log2(total / BLOCK_WORDS + 1)), 0, bits - 5))
    tables: list[np.ndarray] = []
    for width in range(1, longest):
        tables.append(_frequent_hashes(held, width, tables, bits, top, min_count))

    longer = _summed(held, range(2, longest + 1), tables, bits, top, min_count)
    words = _summed(held, range(1, 2), [_words_of(longer, bits, top)], bits, top, min_count)
    return longer.unionByName(words), held.groupBy("lang").agg(F.sum("n").alias("n"))


def _words(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, dominated: int = DOMINATED,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """Phrases of 2 to ``longest`` words with ``a``, the cut's ``l`` and ``r``, the language's ``n`` and ``score``, without dominated ones."""
    counts, totals = phrase_counts(docs, min_count, longest, shard_words)
    found = counts.where("width > 1").select("lang", "phrase", "width", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    # every cut: its first part and its rest are frequent as well, so both joins find their counts
    cuts = found.select("lang", "phrase", "a", "words", "width", F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _words(1, F.col("k")).alias("first"), _words(F.col("k") + 1, F.col("width") - F.col("k")).alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    a, parts = F.col("a").cast("decimal(19,0)"), F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)")
    scored = cuts.select("lang", "phrase", "a", "k", "l", "r", (F.lit(SCALE).cast("decimal(7,0)") * a).alias("top"), parts.alias("parts"))
    scored = scored.select("lang", "phrase", "a", F.struct(F.expr("top div parts").alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    # parts of longer phrases, with the most occurrences that a longer one has
    inner = found.where("width > 2").select(
        "lang", "a", "words", F.explode(F.sequence(F.lit(2), F.col("width") - 1)).alias("m"), "width"
    ).select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.col("width") - F.col("m") + 1)).alias("i"))
    inner = inner.groupBy("lang", _words(F.col("i"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        f"longer is null or cast(longer as decimal(19,0)) * 100 < cast(a as decimal(19,0)) * {dominated}")
    return kept.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def phrase_report(docs: DataFrame, top: int = TOP, **options: int) -> DataFrame:
    """The best ``top`` phrases of each language, ranked by score, occurrences and the phrase itself."""
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = collocations(docs, **options).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k AS width, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, width, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE width > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, CAST(floor((2000000::HUGEINT * c.a) // (x.a + y.a)) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, width)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : c.width], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, width - m + 2)) AS i FROM (SELECT *, unnest(range(2, width)) AS m FROM c WHERE width > 2))
  GROUP BY ALL),
left_over AS (
  SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
