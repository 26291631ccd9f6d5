"""Operators against brute force on small awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import BASE, LONG, NEAR, documents, edit_distance, edited, root_of
from pyspark.sql import functions as F

from stallmetrics.llm import chat, decontaminate, embedding_dedup, html_extract, line_dedup, mixing, ngram_join, quality, sharding, url_filter
from stallmetrics.llm.shared import components, parted, settle


# --- 1 decontamination ---------------------------------------------------------------------------------------------


def test_leaks_of_awkward_texts(spark):
    bench = spark.createDataFrame([(1, BASE), (2, "Short ONE"), (2, "tail"), (3, None), (4, "!!"), (None, "control"), (5, "テキスト")], "item_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in decontaminate.leak_report(documents(spark), bench).collect()}
    digest = lambda *ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert (got[1, 60].n_hit, got[1, 60].items_sha256) == (60, digest("1"))
    assert got[2, 60].n_hit == 59 and got[4, 0].n_hit == got[5, 0].n_hit == got[6, 0].n_words == 0
    assert (got[8, 30_001].n_hit, got[8, 30_001].items_sha256) == (1, digest("2")) and not got[7, 30_000].contaminated
    assert got[9, 2].n_hit == got[10, 2].n_hit == 2 and got[12, 3].items_sha256 == digest("5")
    assert (got[11, 2].contaminated, got[11, 2].n_items) == (True, 0)  # the item has no id to list
    kept = decontaminate.drop_leaks(documents(spark), bench)
    assert kept.columns == documents(spark).columns and {r.doc_id for r in kept.collect()} == {4, 5, 6, 7, None}


def test_merged_spans():
    assert decontaminate.merged_spans([(5, 7), (0, 2), (2, 3), (6, 9), (11, 12)]) == [(0, 3), (5, 9), (11, 12)]


def test_filters_keep_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b c", 0.1, 5, "x"), (2, "leaked words here", 0.2, 6, None)], "doc_id long, text string, score double, n_words int, c0 string")
    bench = spark.createDataFrame([(1, "Leaked WORDS here")], "item_id long, text string")
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.dtypes == docs.dtypes and [tuple(r) for r in kept.collect()] == [(1, "a b c", 0.1, 5, "x")]
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    good = quality.drop_poor(docs, labels)
    assert good.dtypes == docs.dtypes and sorted(map(tuple, good.collect())) == sorted(map(tuple, docs.collect()))


def test_leaks_without_any_window(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not decontaminate.leak_report(documents(spark), empty).where("contaminated").count()
    assert decontaminate.leak_report(documents(spark).limit(0), empty).count() == 0


def test_blocks_agree_with_one(spark, monkeypatch):
    bench = spark.createDataFrame([(i, " ".join(f"token{j}" for j in range(i, i + 12))) for i in range(20)], "item_id long, text string")
    whole = decontaminate.leak_report(documents(spark), bench).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    assert sorted(map(str, whole)) == sorted(map(str, decontaminate.leak_report(documents(spark), bench).collect()))


def test_rounds_of_blocks_agree_with_one(spark, monkeypatch):
    bench = spark.createDataFrame([(i, " ".join(f"token{j}" for j in range(i, i + 12))) for i in range(50)] + [(60, "Short ONE"), (61, LONG)], "item_id long, text string")
    docs = documents(spark).withColumn("hit_spans", F.lit("x")).withColumn("block", F.lit(1))
    whole = decontaminate.find_leaks(docs, bench)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 90)
    monkeypatch.setattr(decontaminate, "AT_ONCE", 20)
    assert decontaminate.benchmark_blocks(bench, "item_id", "text", 10).count() > 40
    rounds = decontaminate.find_leaks(docs, bench)
    assert rounds.dtypes == whole.dtypes and sorted(map(str, whole.collect())) == sorted(map(str, rounds.collect()))
    assert whole.where("size(items) > 30").count()


# --- 2 embeddings --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("tile", [7, 2048])
def test_vectors_against_all_pairs(spark, tile):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + rng.standard_normal(16) * (0.12 if i % 3 else 0.3)).astype(np.float32).tolist(), i % 2) for i in range(150)]
    rows += [(200, rows[0][1], 0), (201, [2 * x for x in rows[0][1]], 0), (202, None, 0), (203, [0.0] * 16, 1), (204, [float("nan")] + [1.0] * 15, 1)]
    rows += [(205, rows[0][1], None), (206, rows[0][1][:8], 0), (207, [], 1), (208, [float("inf")] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("part", F.lit(1)).withColumn("slab", F.lit(2))
    got = {r.vec_id: r for r in embedding_dedup.similar_vectors(df, tile=tile).collect()}
    fine = [(i, np.array(v, float), k) for i, v, k in rows if v and k is not None and np.isfinite(v).all() and np.any(v)]
    links = [
        (i, j) for n, (i, v, k) in enumerate(fine) for j, w, m in fine[:n]
        if k == m and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.93
    ]
    root = root_of([r[0] for r in rows], links)
    assert len(links) > 50 and len(got) == len(rows)
    for i in root:
        assert (got[i].component_id, got[i].n_links, got[i].kept) == (root[i], sum(i in x for x in links), root[i] == i)


def test_no_vectors(spark):
    assert embedding_dedup.similar_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(i, 100) for i in range(120, 125)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == root_of({x for p in links for x in p}, links)


# --- 3 pages -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labeller():
    rng = np.random.default_rng(0)
    path = [("html", "body", *p) for p in [("nav", "ul", "li"), ("article", "h1"), ("article", "p"), ("article", "p"), ("article", "p"), ("footer",)]]
    return html_extract.train([[(p, rng.standard_normal(html_extract.INPUT).astype(np.float32) * 0.1) for p in path] for _ in range(60)])


def test_main_text_only(labeller):
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>"
        "<article><h2>Head &amp; more</h2><p>One <b>b</b>old\n  text<p>Two &lt;3 &eacute; a < b</p><!-- no --><form><p>Search it</p></form>"
        "<section class=comments><p>First!</p></section></article><aside><p>Also read</p></aside><footer>&copy; us</footer></body></html>"
    )
    found = html_extract.main_texts([html_extract.blocks_of(x) for x in (page, "", "<p>", "plain", "<script>never closed", "<!-- nor this")], labeller, {})
    assert found[0] == "Head & more One bold text Two <3 é a < b"
    assert found[1] == found[2] == found[4] == found[5] == ""


def test_pages_without_head_end_and_text_in_formulas(labeller):
    pages = [
        "<html><head><title>T</title><meta charset=x><body><header>Site</header><article><p>Whole text here</p></article></body>",
        "<article><p>Area <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><video src=v><p>Watch it elsewhere</p></video></article>",
        "<article><style>a</styles>b</style><p>Styled words here</p></article>",
    ]
    assert html_extract.main_texts([html_extract.blocks_of(x) for x in pages], labeller, {}) == ["Whole text here", "Area x=2 holds Watch it elsewhere", "Styled words here"]


def test_long_pages_teach_to_their_end(monkeypatch):
    lessons = []
    monkeypatch.setattr(html_extract, "_padded", lambda rows, f=html_extract._padded: lessons.extend(len(r) for r in rows) or f(rows))
    monkeypatch.setattr(html_extract, "EPOCHS", 1)
    monkeypatch.setattr(html_extract, "MADE_UP", 0)
    page = [(("html", "body", "article", "p"), np.zeros(html_extract.INPUT, np.float32))] * 900
    html_extract.train([page])
    assert sum(lessons) == 2 * 900 and max(lessons) == html_extract.LESSON  # vectors and targets
    at = html_extract.lesson_blocks(50_000)
    assert len(at) == html_extract.PAGE_BLOCKS and at[0] == 0 and at[-1] == 49_999 and len(html_extract.lesson_blocks(2_000)) == 2_000


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    model = html_extract.Labeller.fresh()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, lengths = rng.standard_normal((6, 3, html_extract.INPUT)), np.array([6, 2, 4])
    y, inside = rng.integers(0, 2, (6, 3)).astype(float), np.arange(6)[:, None] < lengths

    def loss():
        p = model.probabilities(x, lengths)
        return -np.where(inside, y * np.log(p) + (1 - y) * np.log(1 - p), 0).sum() / inside.sum()

    exact = model.gradients(x, lengths, y)
    for k in ("wf", "ub", "cf", "o"):
        at = tuple(rng.integers(0, s) for s in model.weights[k].shape)
        kept = model.weights[k][at]
        model.weights[k][at] = kept + 1e-2
        up = loss()
        model.weights[k][at] = kept - 1e-2
        assert abs((up - loss()) / 2e-2 - exact[k][at]) < 2e-3
        model.weights[k][at] = kept


def test_extract_keeps_columns(spark, labeller):
    pages = spark.createDataFrame([(1, "u", None, "x"), (None, None, "<article><p>Some words here</p></article>", "y")], "page_id long, url string, html string, main_text string")
    got = html_extract.extract(pages, labeller)
    assert got.columns == ["page_id", "url", "html", "main_text"] and sorted(r.main_text for r in got.collect()) == ["", "Some words here"]


# --- 4 n-grams -----------------------------------------------------------------------------------------------------


def test_near_copies_against_all_pairs(spark):
    rng = random.Random(4)
    rows, words = [], [f"w{i}" for i in range(400)]
    for g in range(6):
        base = [rng.choice(words) for _ in range(rng.choice((3, 8, 40, 90)))]
        for _ in range(14):
            text = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 12) + 1)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    got = {r.doc_id: r for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.component_id for i, r in got.items()} == root_of(sets, links)
    assert all(got[i].n_shingles == len(s) for i, s in sets.items())


def test_tiles_against_sets():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.choice(3000, rng.integers(1, 40) * 40).astype(np.uint64)) for _ in range(30)]
    rows += [np.unique(np.concatenate((r[: len(r) * 9 // 10], rng.choice(3000, 5).astype(np.uint64)))) for r in rows]
    n = np.array([len(r) for r in rows])
    apart = np.triu(np.ones((60, 60), bool), 1)
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if 100 * len(set(rows[i]) & set(rows[j])) >= 75 * len(set(rows[i]) | set(rows[j]))}
    i, j = ngram_join.tile_links(rows, rows, n, n, apart)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and want
    assert {(a, b) for a in range(60) for b in range(a + 1, 60) if ngram_join.overlap_reaches(rows[a], rows[b], n[a], n[b])} == want


def test_awkward_documents_link(spark):
    got = {r.doc_id: r for r in ngram_join.jaccard_components(documents(spark)).collect()}
    assert [got[i].component_id for i in (1, 2, 3, 7, 8, 9, 10)] == [1, 1, 1, 7, 7, 9, 9]
    assert got[4].n_shingles == got[5].n_shingles == got[6].n_shingles == 0 and got[6].component_id == 6
    assert got[None].component_id is None
    kept = ngram_join.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 9, 9, 11, 12]
    assert ngram_join.jaccard_components(documents(spark).limit(0)).count() == 0


def test_one_of_each_judges_rows(spark):
    other = " ".join(f"word{i}" for i in range(40))
    rows = [(None, BASE, "a"), (None, NEAR, "b"), (None, other, "c"), (None, other, "c"), (None, other, "d"), (None, "", "e"), (None, "", "e"), (None, None, "f")]
    rows += [(1, "x y z", "g"), (2, BASE, "h"), (2, "quite another text", "i"), (3, NEAR, "j"), (3, "third text of all", "k")]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    found = sorted((r.doc_id or 0, r.text or "", r.source) for r in kept.collect())
    assert [x for x in found if x[1] not in ("", other)] == [(1, "x y z", "g"), (2, "quite another text", "i"), (2, BASE, "h"), (3, "third text of all", "k")]
    assert [x[1] for x in found].count(other) == 1 and [x[2] for x in found if not x[1]] == ["e", "e", "f"]


def test_only_rows_that_may_go_are_shuffled_with_their_texts(spark, monkeypatch):
    rows = [(i if i % 7 else None, " ".join(f"w{i}x{k}" for k in range(9)), "s") for i in range(600)]
    docs = spark.createDataFrame([*rows, (1000, rows[1][1], "s"), (None, rows[9][1], "s"), (None, rows[7][1], "s")], "doc_id long, text string, source string")
    sides = []
    monkeypatch.setattr(ngram_join, "parted", lambda *a: sides.append(parted(*a)) or sides[-1])
    kept = sorted(map(str, ngram_join.one_of_each(docs).collect()))
    assert kept == sorted(map(str, spark.createDataFrame(rows, docs.schema).collect()))
    assert [side.count() for side in sides[-1]] == [4, 599]


def test_rows_are_parted_by_keys(spark):
    rows = spark.createDataFrame([(i if i % 3 else None, str(i % 5)) for i in range(300)], "a long, b string")
    wanted = settle(rows.where("a > 250 OR a IS NULL AND b = '2'").distinct())
    may, no = parted(rows, wanted, "a", "b")
    assert may.columns == no.columns == rows.columns and sorted(map(str, may.unionByName(no).collect())) == sorted(map(str, rows.collect()))
    assert {(r.a, r.b) for r in wanted.collect()} == {(r.a, r.b) for r in may.collect()}
    assert [x.count() for x in parted(rows, settle(wanted.limit(0)), "a", "b")] == [0, 300]


# --- 5 chat --------------------------------------------------------------------------------------------------------


def test_log_folds_to_final_messages(spark):
    log = [
        (1, 0, 0, "user", "message", "hi"), (1, 1, 1, "assistant", "delta", "He"), (1, 2, 1, "assistant", "delta", "llo"),
        (1, 3, 1, "assistant", "regenerate", "Good "), (1, 4, 1, "assistant", "delta", "day"), (1, 5, 2, "user", "message", "lost"),
        (1, 6, 0, "user", "edit", "hey"), (1, 7, 1, "assistant", "delta", "Yes"), (2, 0, 0, None, None, None), (2, 1, 1, "assistant", "delta", None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, turn long, role string, kind string, text string")
    got = sorted(tuple(r) for r in chat.fold_events(events).collect())
    assert got == [(1, 0, "user", "hey"), (1, 1, "assistant", "Yes"), (2, 0, "", ""), (2, 1, "assistant", "")]


def test_templates_come_back(spark):
    texts = ["<|end|>", "<\\|end|>", "</s>[INST] ok [/INST]", "[\\\\INST]", "a<b [c] \\", "<|begin|>user<|sep|>", "", "日本\n<|x_y|>", "<<s>"]
    rows = [(i, t, ("user", "assistant", "<|sep|>")[t % 3], x) for i in range(2) for t, x in enumerate(texts)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.render(messages)).collect():
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in rows if x[0] == r.conv_id]
        assert r.loss_text == "".join(x[3] for x in rows if x[0] == r.conv_id and x[2] == "assistant")
        assert r.formatted.count("<|end|>") == len(texts) and "</s>" not in r.formatted


# --- 6 shards ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [100, 5_000, 10_000_000])
def test_shards_fit_and_split_only_where_needed(spark, limit):
    docs = documents(spark)
    rows = sharding.assign_shards(docs, limit=limit).select("doc_id", "n_bytes", "shard").collect()
    assert len(rows) == docs.count()
    sizes, members = {}, {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.n_bytes
        members.setdefault(r.shard, []).append(r)
    assert all(s <= limit or len(members[k]) == 1 for k, s in sizes.items())
    for k in sizes:  # one bit less would not have done
        parent = k.split(".")[0][:-1]
        together = [r for r in rows if r.shard.startswith(parent)]
        assert not k or sum(r.n_bytes for r in together) > limit and len(together) > 1
    assert sharding.assign_shards(docs.limit(0)).count() == 0


def test_rows_of_one_key_are_cut(spark):
    rows = spark.range(50).selectExpr("7L AS doc_id", "repeat('x', 100) AS text")
    got = sharding.assign_shards(rows, limit=1_000).groupBy("shard").agg(F.sum("n_bytes").alias("n")).collect()
    assert len(got) == 5 and {r.n for r in got} == {1_000}


def test_crowded_keys_are_cut_by_size(spark):
    rows = spark.range(3_000).selectExpr("CAST(NULL AS long) AS doc_id", "repeat('x', if(id = 7, 5000, 100)) AS text").repartition(3)
    found = sharding.assign_shards(rows, limit=1_000)
    got = {r.shard: (r.n, r.b) for r in found.groupBy("shard").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b")).collect()}
    assert sum(n for n, _ in got.values()) == 3_000 and len(got) == 301 and sorted(got.values())[0] == (1, 5_000)
    assert sorted(n for n, _ in got.values())[1:] == [9, *[10] * 299]


# --- 7 lines -------------------------------------------------------------------------------------------------------


def test_edit_band_and_segments():
    rng = random.Random(7)
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(4, 20)))
        b = edited(a, rng.randrange(5), rng)
        near = edit_distance(a, b) <= 2
        one, two = line_dedup.Codes([a]), line_dedup.Codes([b])
        assert near == bool(line_dedup.within_edits(one, two, np.array([0]), np.array([0]))[0])
        short, long = (one, two) if len(a) <= len(b) else (two, one)
        met = set(short.index_keys()[0].tolist()) & {*long.probe_keys()[0].tolist(), *long.index_keys()[0].tolist()}
        assert met or not near


def test_near_lines_against_all_pairs(spark):
    rng = random.Random(8)
    bases = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(30, 60))) for _ in range(12)]
    rows = [(i, "\n".join([edited(rng.choice(bases), rng.randrange(0, 4), rng) for _ in range(4)] + ["short", ""])) for i in range(25)]
    rows += [(100, None), (101, ""), (102, rows[0][1]), (None, rows[0][1])]
    judged = [(i, k, x.strip()) for i, t in rows if i is not None for k, x in enumerate((t or "").split("\n")) if len(x.strip()) >= line_dedup.SHORTEST]
    lines = sorted({x for _, _, x in judged})
    links = [(a, b) for a in lines for b in lines if a < b and edit_distance(a, b) <= 2]
    root, stays = root_of(lines, links), {}
    for i, k, x in judged:
        stays[root[x]] = min(stays.get(root[x], (i, k)), (i, k))
    gone = {(i, k) for i, k, x in judged if stays[root[x]] != (i, k)}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("x")).withColumn("line", F.lit(1))
    for r in line_dedup.drop_repeated_lines(df).collect():
        t = dict(rows)[r.doc_id]
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (r.doc_id, k) not in gone)
        assert r.kept_text == kept and r.n_dropped == sum(i == r.doc_id for i, _ in gone)
    assert links and line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_lines_near_by_their_length(spark):
    words = [f"{w}{i}" for i, w in enumerate(("river", "stone", "green", "under", "light") * 24)]
    line = lambda n, *changed: " ".join("other" if k in changed else w for k, w in enumerate(words[:n]))
    rows = [(1, line(22)), (2, line(22, 11)), (3, line(22, 3, 11, 17)), (4, line(90)), (5, line(90, 7, 30, 71)), (6, "x" + line(90, 44))]
    assert 162 <= len(line(22)) < 182 and 600 < len(line(90)) and 2 < edit_distance(line(22), line(22, 11)) <= 8 < edit_distance(line(22), line(22, 3, 11, 17))
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1}


def test_long_near_lines_against_all_pairs():
    rng = random.Random(10)
    line = ["".join(rng.choice("abcd ef") for _ in range(n)) for n in (12, 20, 23, 24, 63, 64, 71, 72, 100, 166, 300) for _ in range(8)]
    near = lambda a, b: edit_distance(a, b) <= next(k for low, k in ((300, 14), (162, 8), (100, 4), (72, 3), (64, 3), (24, 2), (12, 1), (0, 0)) if min(len(a), len(b)) >= low)
    pairs = [(a, edited(a, rng.randrange(0, 18), rng)) for a in line]
    pairs = [(a, b) for a, b in pairs if a != b and not any(min(len(a), len(b)) < n <= len(a) for n in (12, 24, 64, 72, 100, 166, 300))]
    x, y, n = line_dedup.Codes([a for a, _ in pairs]), line_dedup.Codes([b for _, b in pairs]), np.arange(len(pairs))
    want = [near(a, b) for a, b in pairs]
    assert 10 < sum(want) < len(want) - 10 and line_dedup.near_lines(x, y, n, n).tolist() == want
    keys = [{(int(key), int(line)) for found in c for k, of in found for key, line in zip(k, of, strict=True)} for c in ((x.indexes(), x.probes()), (y.indexes(), y.probes()))]
    for k, found in enumerate(want):
        assert not found or {key for key, of in keys[0] if of == k} & {key for key, of in keys[1] if of == k}


def test_probes_that_meet_nothing_have_no_pairs():
    """Of a batch none of whose probes is indexed, nothing comes out; before, its empty mask was of floats."""
    none = line_dedup._pairs(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert none.num_rows == 0 and none.schema.names == ["key", "line"]
    some = line_dedup._pairs(np.array([7, 7, 3], np.uint64), np.array([1, 1, 2]))
    assert some.to_pydict() == {"key": [3, 7], "line": [2, 1]}


def test_lines_looked_at_in_several_passes(spark, monkeypatch):
    """Bands whose keys would fill one table get several, with the same result."""
    rng = random.Random(11)
    bases = ["".join(rng.choice("abcdef ") for _ in range(n)) for n in (13, 23, 24, 40, 63, 64, 71, 72, 90, 161, 162, 240, 400)]
    rows = [(i, "\n".join(edited(rng.choice(bases), rng.randrange(0, 4), rng) for _ in range(4))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(line_dedup.drop_repeated_lines(df).collect())
    monkeypatch.setattr(line_dedup, "TABLE_KEYS", 100)
    passes = line_dedup._passes(df.select("text"))
    assert len(passes) > 3 and all(a[0].stop <= b[0].start for a, b in zip(passes, passes[1:], strict=False))
    assert sorted(line_dedup.drop_repeated_lines(df).collect()) == whole and sum(r.n_dropped for r in whole) > 0


def test_joining_lines_join_all_that_near_lines_join(monkeypatch):
    """What is joined already is compared no more, and nothing near stays apart."""
    rng = random.Random(12)
    base = "".join(rng.choice("abcd ef") for _ in range(120))
    lines = [edited(base, rng.randrange(0, 9), rng) for _ in range(24)] + ["".join(rng.choice("abcd ef") for _ in range(120)) for _ in range(4)]
    codes, (i, j) = line_dedup.Codes(lines), np.triu_indices(len(lines), 1)
    compared, near_lines = [], line_dedup.near_lines
    monkeypatch.setattr(line_dedup, "FEWEST", 20)
    monkeypatch.setattr(line_dedup, "near_lines", lambda x, y, i, j: compared.append(len(i)) or near_lines(x, y, i, j))
    keep = near_lines(codes, codes, i, j)
    want = root_of(range(len(lines)), zip(i[keep].tolist(), j[keep].tolist(), strict=True))
    u, v = line_dedup.joining_lines(codes, i, j, np.arange(len(lines)))
    assert root_of(range(len(lines)), zip(u.tolist(), v.tolist(), strict=True)) == want and sum(compared) < len(i) // 2


def test_keys_of_a_full_table_are_told_apart(spark):
    """At 20 bits for a key hardly any other one passes, and none of its own is missing; of two bits a key, one in a hundred passed."""
    from stallmetrics.llm.shared import bit_tables, bits_set, packed_slots

    bits, ways, keys = 20, line_dedup.WAYS, np.random.default_rng(5).integers(0, 1 << 64, 150_000, np.uint64)
    mine, others = keys[:52_000], keys[52_000:]
    packed = packed_slots(spark.range(1, numPartitions=1), lambda batches: (x for x in [mine] if list(batches)), 16, bits)
    table = bit_tables(packed, (1,), bits, ways)[0]
    assert len(bits_set(table, mine, bits, 4, ways)) == len(mine) and len(bits_set(table, others, bits, 4, ways)) < len(others) / 500


def test_bit_tables_reach_the_driver_block_by_block(spark, monkeypatch):
    """Not all blocks of all tables at once, besides the tables made of them."""
    from stallmetrics.llm.shared import bit_set, bit_tables, packed_slots

    keys = np.random.default_rng(6).integers(0, 1 << 64, 1000, np.uint64)
    packed = packed_slots(spark.range(1, numPartitions=1), lambda batches: (x for x in [np.repeat(keys, 2)] if list(batches)), 8, 16)
    frame = type(packed)
    monkeypatch.setattr(frame, "collect", lambda self: pytest.fail("collected as a whole"))
    twice, often = bit_tables(packed, (2, 3), 16)
    assert bit_set(twice, keys, 16).all() and not often.any()


def test_short_lines_go_when_repeated(spark):
    rows = [(1, "Share\nMenu\nA line of its own, longer than the others"), (2, " Share \nx\nMenu"), (3, "x\nShark\n\n"), (4, "Share this page\n\n"), (5, "Share that page")]
    got = {r.doc_id: r.kept_text for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "x", 3: "Shark\n\n", 4: rows[3][1], 5: rows[4][1]}


# --- 8 quality -----------------------------------------------------------------------------------------------------


def test_votes_are_exact_neighbours_and_hold_out(spark):
    rng = random.Random(9)
    good = [" ".join(rng.choice(("the", "river", "ran", "down", "hill", "green")) for _ in range(30)) + "." for _ in range(90)]
    bad = [" ".join(rng.choice(("BUY", "NOW", "FREE")) + "!!" for _ in range(30)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, ""), (None, "the hill")], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("old")).withColumn("label", F.lit(5))
    labels = spark.createDataFrame([(i, int(i < 90), 0) for i in range(150)] + [(None, 1, 0), (901, None, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_report(docs, labels).collect()}
    assert all(got[i].predicted == (i < 90) and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(150))
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].score == got[901].score and len(got) == 153
    assert quality.drop_poor(docs, labels).columns == docs.columns
    none = quality.quality_report(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and quality.quality_report(docs.limit(0), labels).count() == 0


def test_votes_are_those_of_the_nearest(spark):
    """Scores equal a plain loop over all labelled vectors."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = quality.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: r.score for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    checked = 0
    for row in rows[:80]:
        vector = quality._unit(quality._weighted(quality.term_counts([row.text.encode()]), model.idf) @ model.axes)[0]
        near = sorted(((sum(float(x) * float(y) for x, y in zip(v, vector, strict=True)), i) for i, v in enumerate(model.vectors)), reverse=True)
        k = quality.NEIGHBOURS
        if near[k - 1][0] - near[k][0] < 1e-5:
            continue  # a tie: either may vote
        votes = [(max(0.0, c) * model.weights[i], model.labels[i]) for c, i in near[:k]]
        total = sum(w for w, _ in votes)
        want = sum(w for w, label in votes if label == 1) / total if total else model.share
        assert abs(got[row.doc_id] - want) < 1e-4, (row.doc_id, got[row.doc_id], want)
        checked += 1
    assert checked > 40


def test_of_texts_of_one_id_the_smallest_teaches(spark):
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in (("good words here " * 9, "zz $$$ ### " * 9) if i % 2 else ("%%% !!! ### " * 9, "zzz"))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    models = [quality.fit(d, labels) for d in (docs, docs.orderBy(F.desc("text")).repartition(5))]
    assert np.array_equal(models[0].vectors, models[1].vectors)


# --- 9 mixing ------------------------------------------------------------------------------------------------------


def test_budgets_fill_siblings_first(spark):
    leaves = [("domain0", "en", "a", 100), ("domain0", "en", "b", 9000), ("domain0", "de", "c", 9000), ("domain1", "en", "d", 10), ("domain2", "en", "e", 5000)]
    got = mixing.leaf_budgets(spark.createDataFrame(leaves, "domain string, language string, origin string, tokens long"), mixing.WEIGHTS, 30, 1).collect()
    given = {r.origin: r.budget for r in got}
    assert 6930 < sum(given.values()) <= 6933 and all(r.budget <= r.tokens for r in got)
    assert given["d"] == 10 and given["a"] == 100  # full ones
    assert abs((given["a"] + given["b"]) / given["c"] - 3) < 0.02  # the sibling took what a lacked


@pytest.mark.parametrize("ids", ["null", "one", "equal rows"])
@pytest.mark.parametrize("share", [10, 30, 50, 80, 130])
def test_a_third_of_equal_ids_still_meets_the_budget(spark, ids, share):
    number, third = F.col("id"), F.col("id") % 3 == 0
    docs = spark.range(0, 3000, 1, 7).select(
        F.when(third, F.lit(None if ids == "null" else 5).cast("long")).otherwise(number + 10).alias("doc_id"),
        F.concat(F.rpad(F.lit("word"), 92, "x"), F.when(third & F.lit(ids == "equal rows"), "-------").otherwise(F.lpad(number.cast("string"), 7, "0"))).alias("text"),
        F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.when(F.lit(ids == "equal rows"), 1).otherwise(number).alias("n_chars"),
    )
    rows = mixing.mixture(docs, mixing.tree_of(F.col("lang"), F.col("source")), budget_share=share, epochs=2).collect()
    given, budget = sum(r.n_tokens for r in rows), 3000 * 25 * share // 100
    assert budget - 25 < given <= budget
    assert max(r.epoch for r in rows) == (1 if share > 100 else 0)


def test_mixture_of_awkward_documents(spark):
    docs = documents(spark)
    rows = mixing.mixture(docs, mixing.tree_of(F.col("lang"), F.col("source")), budget_share=150, epochs=2).collect()
    total = sum((len((r.text or "").encode()) + 3) // 4 for r in docs.collect())
    assert 0 < sum(r.n_tokens for r in rows) <= total * 3 // 2 and {r.epoch for r in rows} <= {0, 1}
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs.limit(0)).count() == 0


# --- 10 urls -------------------------------------------------------------------------------------------------------


def test_long_lists_are_dealt_to_several_cascades(spark, monkeypatch):
    listed = spark.range(0, 300, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(300).select(F.array(F.concat(F.lit("k"), "id"), F.concat(F.lit("x"), "id")).alias("keys"))
    monkeypatch.setattr(url_filter, "MOST_KEYS", 60)
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.parts) == 4 and not cascade.levels
    found = universe.select(F.explode("keys").alias("key")).where(cascade.lists(F.col("key")))
    assert sorted(r.key for r in found.collect()) == sorted(f"k{i}" for i in range(0, 300, 3))


def test_urls_by_rule(spark):
    urls = {
        "http://a.com": (None, "allow"), "http://A.COM/x": ("com/", "allow"), "https://example.com/en/1?q": ("example.com/en/", "block"),
        "https://m.www.example.com/en/": ("www.example.com/en/", "allow"), "http://badexample.com/en/": ("com/", "allow"), "x://q.net/es/": ("net/es/", "block"),
        "x://q.net/esx": (None, "allow"), "http://net/fr/": ("net/fr/", "block"), "no scheme": (None, "allow"), None: (None, "allow"), "": (None, "allow"),
        "http://x.casino-win.example.org/en/1": (None, "block"), "http://xcasino-win.example.org/": (None, "allow"), "http:///en/": (None, "allow"),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("rule", F.lit("z")).withColumn("keys", F.lit(1))
    got = {r.row.url: (r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert got == urls
    assert url_filter.url_report(pages.limit(0)).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    listed = spark.range(0, 300).selectExpr("concat('k', id) AS key")
    universe = spark.range(0, 20_000).selectExpr("array(concat('k', id), concat('m', id)) AS keys")
    cascade = url_filter.build_cascade(listed, universe)
    asked = universe.select(F.explode("keys").alias("key")).withColumn("held", cascade.lists(F.col("key")))
    assert len(cascade.levels) > 1
    assert asked.where("held").join(listed, "key", "left_anti").count() == 0 and asked.where("held").count() == 300


def test_constants_of_the_fixture():
    assert NEAR != BASE and len(LONG) > 300_000
