"""Phrases, spelling variants and personal data against brute force on small awkward tables."""

import hashlib
import random
import re
import zlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import LONG, documents, edit_distance

from stallmetrics.llm import html_extract, phrases, pii, variants

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11 phrases ----------------------------------------------------------------------------------------------------


def brute_phrases(rows, least, longest=4, dominated=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * a >= dominated * found[p[i : i + m]]
        }
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def some_texts(rng):
    words = ["New", "york", "the", "of", "and", "city", "Größe", "x|y", "日本", "\x01a"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randrange(40)))
        rows.append((i if i % 9 else None, text, rng.choice(["en", "de", None, "und"])))
    return rows + [(1, None, "en"), (2, "", None), (3, " \n.,", "de"), (4, "the city of " * 300, "en"), (4, "the city of " * 300, "en")]


@pytest.mark.parametrize("size", [50, 1 << 22])
def test_phrases_against_counting(spark, size):
    rows = some_texts(random.Random(5))
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as shard", "'x' as phrase", "2 as n").repartition(5)
    got = sorted(tuple(r) for r in phrases.phrase_report(docs, min_count=4, shard_words=size).collect())
    want = brute_phrases(rows, 4)
    assert got == want and len(want) > 100 and {r[0] for r in want} == {"en", "de", "und"}


def test_names_of_phrases_are_packed_by_block(spark, monkeypatch):
    counts = {f"the {i} of".encode(): i + 1 for i in range(5000)}
    blocks, names, many = phrases._packed_names(counts, 3)
    assert sorted(blocks) == list(range(8)) and sum(map(len, names)) < 5 * len(counts)
    unpacked = [(p, n) for x, y in zip(names, many, strict=True) for p, n in zip(zlib.decompress(x).split(b"\n"), phrases.unpacked_numbers(y).tolist(), strict=True)]
    assert dict(unpacked) == counts and len(unpacked) == len(counts)
    assert phrases._packed_names(counts, 0)[0] == [0]
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 50)
    monkeypatch.setattr(phrases, "HELD", 20)
    rows = some_texts(random.Random(7))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted(tuple(r) for r in phrases.phrase_report(docs, min_count=4, shard_words=100).collect()) == brute_phrases(rows, 4)


def test_only_the_best_phrases_are_ranked(spark):
    rows = some_texts(random.Random(6))
    got = sorted(tuple(r) for r in phrases.phrase_report(spark.createDataFrame(rows, SCHEMA), top=5, min_count=3, dominated=50).collect())
    assert got == brute_phrases(rows, 3, dominated=50, top=5)


def test_texts_without_phrases(spark):
    assert phrases.phrase_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.phrase_report(documents(spark)).count() == 0
    assert phrases.phrase_report(documents(spark), min_count=2).where("phrase = 'short one'").first().a == 3


def test_index_extends_both_ways():
    rng = np.random.default_rng(3)
    ids = np.append(rng.integers(0, 6, 3000), 0)
    text = ids.tolist()
    count = Counter(tuple(text[i : i + k]) for k in (2, 3) for i in range(len(text) - k + 1))
    kept = sorted(p for p in count if len(p) == 2 and 0 not in p and count[p] >= 70)
    first, last, counts = phrases.PhraseIndex.of(ids, 3).longer(np.array(kept))
    got = {kept[a] + kept[b][1:]: int(n) for a, b, n in zip(first, last, counts, strict=True)}
    assert got == {p: n for p, n in count.items() if len(p) == 3 and p[:2] in kept and p[1:] in kept}
    assert all(kept[a][1:] == kept[b][:-1] for a, b in zip(first, last, strict=True))


# --- 12 spelling variants ------------------------------------------------------------------------------------------


def brute_words(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute_variants(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and edit_distance(v, w) == 1] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


@pytest.mark.parametrize("leaf", [4, variants.LEAF])
def test_variants_against_all_pairs(spark, leaf):
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcdeé\xff\xd7") for _ in range(rng.randrange(6, 10))) for _ in range(25)] + ["aaaaaaa", "listen", "silent", "tinsel"]
    vocabulary = Counter({s: 400 for s in stems})
    for s in stems:
        for _ in range(8):
            at = rng.randrange(len(s))
            word = rng.choice([s[:at] + s[at + 1 :], s[:at] + rng.choice("abé") + s[at:], s[:at] + rng.choice("abé") + s[at + 1 :]])
            vocabulary[word] += rng.choice([5, 12, 60])
    vocabulary.update({"edcbaab": 400, "edcbaabe": 60, "edcbaabee": 8})
    tokens = list(vocabulary.elements())
    rng.shuffle(tokens)
    rows = [(i if i % 7 else None, "1".join(t.upper() if i % 5 == 0 and t.isascii() else t for t in tokens[i * 40 : i * 40 + 40])) for i in range(len(tokens) // 40)]
    rows += [(-1, None), (-2, ""), (-3, "12 . \n"), (-4, "y" * 30_000 + " " + "y" * 30_001)] + [(-5, "x" * 300 + " " + "x" * 301)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' as word", "1 as n", "'b' as form").repartition(6)
    got = variants.spelling_variants(docs, leaf=leaf).collect()
    words = brute_words(rows)
    assert {tuple(r) for r in got} == brute_variants(words) and len(got) == len(words) > 150
    assert any(r.form and r.root != r.form for r in got) and any(zlib.crc32(f"{k}:{t}".encode()) % 199 == 0 for k, _ in rows[:-9] for t in stems)


def test_no_words(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert variants.spelling_variants(documents(spark)).count() == 0


def test_one_edit_is_one_edit():
    words = ["kitten", "mitten", "kiten", "kittens", "skitten", "kitetn", "kitten"]
    for a in words:
        for b in words:
            if 0 <= len(b) - len(a) <= 1:
                got = variants.one_edit(np.array([list(a.encode())], np.uint8), np.array([list(b.encode())], np.uint8))[0]
                assert bool(got) == (edit_distance(a, b) == 1), (a, b)


def test_chains_are_followed_to_their_end(spark):
    links = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(13)] + [("v", "w05")]
    got = {r.word: r.root for r in variants.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {w: "w13" for w, _ in links}


# --- 13 personal data ----------------------------------------------------------------------------------------------

BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    out = []
    for kind, pattern in BASE_PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isdigit()]
            doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def awkward_texts(rng):
    parts = [
        "a.b@c.de", "@", "x@y", "a@b.c@d.e", "ü@mail.example.com", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "007.0.0.1", "4111 1111 1111 1111",
        "4111-1111-1111-1112", "4111111111111111", "12", "+1 (017) 555-7713", "+12 3", "+49 ", "(555) 123-4567", "555-123-4567", "joe at mail dot com",
        "joe [at] mail [dot] org", "call", "card", "token = \"", " ", " ", "\n", ",", "é日", "2024-01-01", "fe80:0:0:0:1:2:3:4", "%", "+", "..", "--",
    ]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(30))) for _ in range(400)]


def test_base_spans_against_patterns(spark):
    texts = awkward_texts(random.Random(2)) + ["", None, "9" * 3000, "1" * 500 + ".1.2.3", "a" * 20_000 + "@", "a.-" * 9000, "+" + "1 " * 9000, LONG]
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(5, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as kind", "'z' as base").repartition(4)
    got = pii.pii_report(docs).collect()
    want = Counter()
    for key, text in rows:
        base = brute_base(text)
        want[(key, *[sum(s.startswith(k) for s in base) for k in pii.KINDS], hashlib.sha256(",".join(base).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    order = {k: i for i, k in enumerate(pii.KINDS)}
    for r in got:
        spans = [(order[k], int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert spans == sorted(spans) and len(spans) >= r.n_email + r.n_ip + r.n_card + r.n_phone
        assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_method_adds_spoken_addresses_and_leaves_failed_checks(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        good = next(digits + c for c in "0123456789" if pii.luhn(digits + c))
        bad = digits + str((int(good[-1]) + 1 + rng.randrange(8)) % 10)
        rows.append((i, f"my card {good} stands here") if i % 2 else (i, f"serial {bad} stands here"))
    rows += [(1000 + i, f"mail me at user{i}@mail{i}.example.com please") for i in range(60)]
    rows += [(2000, "mail me: jane.roe at example dot com please"), (2001, "call (555) 123-4567 today"), (2002, "phone +1 (826) 555-4081 190.137.223.20")]
    rows += [(3000 + i, f"call +1 (555) 123-45{i:02d} now") for i in range(60)] + [(4000, "version 1.2.300.4 of 2024-01-01 and 12 of 345 pages")]
    got = {r.doc_id: r.spans for r in pii.pii_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(("card:" in got[i]) == bool(i % 2) for i in range(300))
    assert got[2000] == "email:9:36" and got[2001] == "phone:5:19" and "phone:" in got[2002] and "ip:" in got[2002]
    assert got[4000] == ""


def test_no_personal_data(spark):
    assert pii.pii_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert {r.spans for r in pii.pii_report(spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")).collect()} == {""}


def test_reliabilities_find_the_better_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.full((4000, len(pii.LABELERS)), pii.NOTHING)
    for j, right in enumerate((0.95, 0.97, 0.9, 0.6, 0.8, 0.7)):
        said = np.where(rng.random(4000) < right, truth, ~truth)
        votes[:, j] = np.where(rng.random(4000) < 0.8, said, pii.NOTHING)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    likely, rates, share = pii.reliabilities(patterns, counts)
    of = {tuple(p): q for p, q in zip(patterns.tolist(), likely, strict=True)}
    assert np.mean([(of[tuple(v)] >= 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)]) > 0.95
    assert rates[0, 1, pii.YES] > rates[3, 1, pii.YES] and 0.3 < share < 0.5


# --- 3 pages, with names of no list --------------------------------------------------------------------------------

PAGES = "/root/testdata/sf0.001/pages.parquet"


@pytest.fixture(scope="module")
def taught(spark):
    """A model of the sample's pages, and pages it has not seen."""
    rows = [r.html for r in spark.read.parquet(PAGES).orderBy("page_id").collect()]
    parsed = [p for p in map(html_extract.blocks_of, rows) if p]
    learn = [list(zip([b.path for b in p], html_extract.block_vectors(p, {}), strict=True)) for p in parsed[: len(parsed) // 2]]
    return html_extract.train(learn), parsed[len(parsed) // 2 :]


def _marks(model, pages, change=None, chance=None):
    out = []
    for blocks in pages:
        vectors = html_extract.block_vectors(blocks, {})
        if chance is not None:
            vectors[:, : html_extract.PATH_SIZE] = [html_extract.path_vector(p) for p in html_extract.renamed([b.path for b in blocks], chance)]
        if change is not None:
            vectors[:, change] = 0
        out.append(model.probabilities(*html_extract._padded([vectors]))[: len(blocks), 0] >= 0.5)
    return np.concatenate(out)


def test_pages_of_unknown_names(taught):
    model, pages = taught
    truth = np.concatenate([html_extract.labels_by_rule([b.path for b in p]) for p in pages]).astype(bool)
    assert (_marks(model, pages) == truth).mean() > 0.99
    nameless = _marks(model, pages, chance=np.random.default_rng(3))
    assert (nameless == truth).mean() > 0.95
    words = slice(html_extract.PATH_SIZE, html_extract.PATH_SIZE + html_extract.WORD_SIZE)
    assert (_marks(model, pages, words, np.random.default_rng(3)) != nameless).any()
    assert (_marks(model, pages, slice(html_extract.PATH_SIZE, -1), np.random.default_rng(3)) != nameless).mean() > 0.02


def test_made_up_pages_keep_main_and_other_blocks_apart():
    page = [(("html", "article", "p"), np.full(html_extract.INPUT, 1, np.float32)), (("html", "nav", "li"), np.full(html_extract.INPUT, 2, np.float32))]
    for made in html_extract.made_up_pages([page], 60):
        for label, (_, vector) in zip(html_extract.labels_by_rule([p for p, _ in made]), made, strict=True):
            assert vector[0] == (1 if label else 2)


def test_extraction_report_of_awkward_pages(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(PAGES).orderBy("page_id").limit(60).collect()]
    long = "<article>" + "".join(f"<p>Paragraph {i} of a very long article about nothing much.</p>" for i in range(4000)) + "</article><footer>End</footer>"
    rows += [(None, None, None), (None, "u", ""), (None, "u", rows[0][2]), (7, "u", rows[0][2]), (7, "u", rows[0][2]), (9000, "long", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as main_text", "'x' as text", "2 as vectors").repartition(5)
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_extract.extraction_report(pages).collect())
    want = Counter()
    for key, url, page in rows:
        blocks = html_extract.blocks_of(page or "")
        text = " ".join(b.text for b, label in zip(blocks, html_extract.labels_by_rule([b.path for b in blocks]), strict=True) if label)
        want[(key, url, text, len(text))] += 1
    assert got == want
    again = html_extract.extraction_report(pages.repartition(3))
    assert Counter((r.page_id, r.url, r.text, r.n_chars) for r in again.collect()) == got
    assert html_extract.extraction_report(pages.limit(0)).count() == 0
