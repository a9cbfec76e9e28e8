"""The pipeline: every stage on its own input, and all of them in a row."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm.token_ids import tokenizer_file
from feedloom.session import materialize
from tests.llm.test_jaccard import brute_force
from tests.llm.test_texts import _brute_tokens

SF = "/root/testdata/sf0.01"


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{k}"
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns, name
            assert docs.join(before, docs["doc_id"] == before["doc_id"], "left_anti").count() == 0
        kept[k] = before
    assert kept[1].count() < kept[0].count()
    texts = [(r.doc_id, r.text) for r in kept[1].collect()]
    smallest = {c for _, _, c in brute_force(texts)}
    assert _rows(kept[2]) == [r for r in _rows(kept[1]) if r[0] in smallest]
    assert kept[3].count() < kept[2].count()
    assert kept[4].groupBy("doc_id").count().where("count > 3").count() == 0
    expected = _brute_tokens(sorted((r.doc_id, r.text) for r in kept[4].collect()))
    assert _rows(docs) == expected


def test_clashing_columns_and_very_long_texts(spark):
    """Further columns, named like those that the stages make, go through all stages; long texts whole."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    good = spark.read.parquet(f"{SF}/documents.parquet").join(
        spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id", "left_semi"
    )
    long_text = "\n".join(r.text for r in good.orderBy("doc_id").collect())
    assert len(long_text.split()) > 20_000
    longest = spark.createDataFrame([(10**9, long_text, "en", "src0", len(long_text))], docs.schema)
    names = ("own", "key", "more", "copy", "copies", "row", "size", "hash", "tag", "kept", "n_words", "n_hit", "matches", "taken")
    given = docs.unionByName(longest).select("*", *(F.lit(name).alias(name) for name in names))
    before = {r.doc_id: r.text for r in given.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, given, SF), "odd-stage")
        assert out.columns == given.columns, name
        rows = out.collect()
        assert rows and all(before[r.doc_id] == r.text and all(r[n] == n for n in names) for r in rows), name
        if name != corpus_pipeline.STAGES[3][0]:  # the mix may leave out what is larger than its source's share
            assert any(r.doc_id == 10**9 for r in rows), name
        given = out
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, given, SF).count() == given.count(), name


def test_odd_rows_pass_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
        docs = out if name != corpus_pipeline.STAGES[-1][0] else docs
    rows = [(None, None, None, None, None), (1, "x", "en", None, 1), (1, "x", "en", None, 1), (1, "y z", "en", "a", 2)]
    odd = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF).collect()
    deduplicated = corpus_pipeline.STAGES[1][1](spark, odd, SF)
    assert _rows(deduplicated) == _rows(spark.createDataFrame([rows[0], rows[1], rows[3]], odd.schema))
    assert tokenizer_file()
