"""The pipeline's stages against brute force on the smallest tables."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from conftest import TEST_DATA
from peakloom.llm import bpe, common, toxicity
from test_operators import brute_components, brute_repeats

P = pytest.importorskip("public_tokenizers")


def test_stages(spark):
    scratch = common.Scratch(spark)
    docs = common.documents(spark, TEST_DATA)
    columns, kept = docs.columns, []
    for name, stage in pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, TEST_DATA), name.replace(" ", "-"))
        kept.append(docs)
    a, b, c, d, e = ([r.asDict() for r in x.collect()] for x in kept)
    assert all(x.columns == columns for x in kept[:-1])
    weights = toxicity.fit(spark, TEST_DATA)
    scores = {r.doc_id: r.score for r in toxicity.score(common.documents(spark, TEST_DATA), weights).select("row.doc_id", "score").collect()}
    assert {r["doc_id"] for r in a} == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    comp, _ = brute_components([(r["doc_id"], r["text"]) for r in a], 5, 80)
    assert {r["doc_id"] for r in b} == {i for i, k in comp.items() if i == k}
    text = {r["doc_id"]: r["text"] for r in b}
    after = {r["doc_id"]: r for r in c}
    for i, n, gone, _, sha in brute_repeats([(r["doc_id"], r["text"]) for r in b], 100):
        if not gone:
            assert after[i]["text"] == text[i]
        elif i in after:
            assert len(after[i]["text"].encode()) <= n - gone and after[i]["n_chars"] == len(after[i]["text"])
            if len(after[i]["text"].encode()) == n - gone:
                assert hashlib.sha256(after[i]["text"].encode()).hexdigest() == sha
    total = sum(len(r["text"].split()) for r in c)
    assert abs(sum(len(r["text"].split()) for r in d) - 1.5 * total) <= 0.1 * total
    assert max(Counter(r["doc_id"] for r in d).values()) <= 2
    assert Counter(r["doc_id"] for r in e) == Counter(r["doc_id"] for r in d)
    said = {r["doc_id"]: r["text"] for r in d}
    assert all(r["decoded_sha256"] == hashlib.sha256(said[r["doc_id"]].encode()).hexdigest() for r in e)
    again = sorted(map(tuple, pipeline.run(spark, TEST_DATA).collect()))
    assert again == sorted(tuple(r.values()) for r in e)


ODD = "doc_id long, text string, lang string, source string, n_chars long, __row string, component_id int, taken int, kept_text int, key int"


def test_rows_with_null_and_repeated_ids_stay(spark):
    """Each stage keeps all rows that its own rule does not name, whatever their ids and whatever else they carry."""
    words = lambda k, n: " ".join(f"s{k}w{i}" for i in range(n))
    near = words(1, 60).replace("s1w59", "other")
    rows = [(1, None), (None, "x y z"), (2, ""), (2, "again"), (7, words(1, 60)), (7, words(2, 60)), (None, near), (None, words(3, 60)), (8, words(3, 60)), (9, words(4, 30) + " " + words(2, 40))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", 1, 2, 3, 4) for i, t in rows], ODD)
    after = lambda k, df: common.Scratch(spark).table(pipeline.STAGES[k][1](spark, df, TEST_DATA), "stage")
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    gone = [(None, near), (None, words(3, 60))]
    assert texts(after(1, docs)) == sorted((r for r in rows if r not in gone), key=str)
    cut = after(2, docs)
    kept = {(i, t) for i, t in texts(cut)}
    assert {(1, None), (None, "x y z"), (2, ""), (2, "again"), (None, near), (7, words(2, 60)), (None, words(3, 60))} <= kept and (8, words(3, 60)) not in kept
    assert next(len(t) for i, t in kept if i == 9) < len(rows[-1][1]) and sum(i == 7 for i, _ in kept) == 2
    assert all(r.n_chars == len(r.text or "") for r in cut.collect()) and cut.columns == docs.columns
    mixed = after(3, docs)
    assert set(texts(mixed)) <= {r for r in rows if (r[1] or "").split()} and mixed.columns == docs.columns
    assert after(4, docs).count() == len(rows)


def test_empty_and_null_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "x y z", "en", "s", 5), (2, "", "en", "s", 0), (2, "again", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        now = some
        for name, stage in pipeline.STAGES:
            now = common.Scratch(spark).table(stage(spark, now, TEST_DATA), "stage")
            if some is docs and name in ("toxicity", "n-gram Jaccard join", "suffix-array dedup"):
                assert now.count() == 4
    assert now.count() == 0 and bpe is not None


def test_two_results_open_at_once(spark, tmp_path):
    """A stage's result stays readable while another's is made; what it was made of goes once it is written and handed on."""
    docs = common.documents(spark, TEST_DATA)
    a = pipeline.one_of_each_group_stays(spark, docs.filter("doc_id % 2 = 0"), TEST_DATA)
    b = pipeline.one_of_each_group_stays(spark, docs.filter("doc_id % 2 = 1"), TEST_DATA)
    assert b.count() + a.count() > 100
    made_of = a.schema[0].metadata[pipeline.MADE_OF]
    assert made_of and not set(made_of) & set(b.schema[0].metadata[pipeline.MADE_OF])
    a.write.parquet(str(tmp_path / "a"))
    again = spark.read.parquet(str(tmp_path / "a"))
    pipeline.toxic_documents_go(spark, again, TEST_DATA).count()
    there = lambda path: spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path))
    assert not any(map(there, made_of)) and b.count() > 50
