"""The stages as a whole: what goes, what stays, and the columns in between."""

from types import SimpleNamespace

import corpus_pipeline
import numpy as np
from cases import BASE, documents
from pyspark.sql import functions as F

from stallmetrics.llm import decontaminate, ngram_join, quality


def test_stages_keep_columns_and_decide(spark, tmp_path):
    folder = str(tmp_path)
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 9)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "Short ONE")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    at = spark.read.parquet(f"{folder}/documents.parquet")
    names = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, at, folder)
        names.append(name)
        if name != "sharding":
            assert after.columns == docs.columns
        after.write.parquet(f"{folder}/{name}")
        kept, was = spark.read.parquet(f"{folder}/{name}"), at
        ids = {r.doc_id for r in kept.collect()}
        if name == "quality":
            want = quality.score(was, quality.fit(was, spark.read.parquet(f"{folder}/labels.parquet"))).where("predicted = 1")
            assert kept.count() == want.count()
        if name == "near_duplicates":
            want = ngram_join.jaccard_components(was).where("doc_id = component_id OR doc_id IS NULL")
            assert ids == {r.doc_id for r in want.collect()} and 2 not in ids and 1 in ids
        if name == "decontamination":
            clean = decontaminate.leak_report(was, spark.read.parquet(f"{folder}/benchmark.parquet")).where("NOT contaminated")
            assert ids == {r.doc_id for r in clean.collect()} and 9 not in ids
        at = kept
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert set(at.columns) == {*docs.columns, "n_bytes", "shard"}
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, again.collect())) == sorted(map(str, at.select(*again.columns).collect()))


def test_empty_corpus(spark, tmp_path):
    folder = str(tmp_path)
    documents(spark).where(F.col("text") == BASE + "none").select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_the_driver_is_tidied_before_every_stage(monkeypatch):
    calls, parts = [], [("quality", "drop_poor"), ("ngram_join", "one_of_each"), ("decontaminate", "drop_leaks"), ("mixing", "mix"), ("sharding", "assign_shards")]
    monkeypatch.setattr(corpus_pipeline, "tidy", lambda spark: calls.append("tidy"))
    for module, name in parts:
        monkeypatch.setattr(getattr(corpus_pipeline, module), name, lambda docs, *_, name=name: calls.append(name) or docs)
    session = SimpleNamespace(read=SimpleNamespace(parquet=lambda path: path))
    assert [stage(session, "docs", "folder") for _, stage in corpus_pipeline.STAGES] == ["docs"] * 5
    assert calls == [x for _, name in parts for x in ("tidy", name)]


def test_labelled_texts_are_weighted_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 7} of, {'some ' * i}words") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    whole, sizes, weighted = quality.fit(docs, labels), [], quality._weighted
    monkeypatch.setattr(quality, "ROWS", 3)
    monkeypatch.setattr(quality, "_weighted", lambda counts, idf: sizes.append(len(counts)) or weighted(counts, idf))
    parts = quality.fit(docs, labels)
    assert max(sizes) == 3 and sum(sizes) == len(parts.labels) > 20
    assert all(np.array_equal(getattr(whole, x), getattr(parts, x)) for x in ("idf", "axes", "vectors", "labels", "weights")) and whole.share == parts.share
