"""Classifiers and LM scores: held-out accuracy and brute force."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest

from feedloom.llm import lm_scoring as lm
from feedloom.llm.lm_scoring import op4_lm_scoring, score_documents
from feedloom.llm.quality_classifier import isotonic, op9_quality_classifier, score_quality
from feedloom.llm.toxicity import CATEGORIES, op2_toxicity, score_toxicity

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD = [
    (1, "a b a b c d a b", "l"), (2, None, None), (3, "", "l"), (4, " \n ", "l"), (None, "a b zz", "l"),
    (5, "a B\tc " * 20_000, "l"), (6, "#*$ %& |<> é\n é \n é", "l"), (1, "a b a b c d a b", "l"),
]
DOCS = "doc_id long, text string, score string"
LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_on_held_out_rows(spark):
    """On a tenth of the full scale: smaller tables have too few toxic rows of each language to learn from."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = score_toxicity(docs, labels.where("doc_id % 4 <> 1"), ["doc_id"]).selectExpr("own.doc_id", "p_toxic")
    held_out = scored.join(labels.where("doc_id % 4 = 1"), "doc_id").collect()
    toxic = [r for r in held_out if r.toxic]
    assert sum(r.p_toxic >= 0.5 for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.p_toxic >= 0.5 for r in held_out if not r.toxic) <= 0.01 * len(held_out)


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (5, 1, 0), (6, 1, 0), (None, 1, 1), (3, 0, None), (99, 1, 1)], LABELS)
    got = score_toxicity(docs, labels, ["doc_id", "score"]).collect()
    assert len(got) == len(ODD)
    assert all(0 <= r[f"p_{c}"] <= 1 for r in got for c in CATEGORIES)
    assert all(r.p_insult == 0 for r in got)  # one class only: that class
    unlabelled = score_toxicity(docs, labels.limit(0), ["doc_id"]).collect()
    assert [r.p_toxic for r in unlabelled] == [0.0] * len(ODD)
    assert score_toxicity(docs.limit(0), labels, ["doc_id"]).count() == 0


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = op9_quality_classifier(spark, MEDIUM).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    tested = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in tested) >= 0.95 * len(tested)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 0), (6, 1, 0), (2, 0, 0), (3, None, 0), (None, 1, 0)], LABELS)
    got = score_quality(docs, labels, ["doc_id", "score"]).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in score_quality(docs, labels.limit(0), ["doc_id"]).collect()] == [0.5] * len(ODD)
    assert score_quality(docs.limit(0), labels, ["doc_id"]).count() == 0


def test_isotonic_pools_violators():
    at, p = isotonic([1, 2, 3, 4, 5], [0.0, 1.0, 0.0, 1.0, 1.0], [1, 1, 3, 1, 1])
    assert at.tolist() == [1, 2.75, 4.5] and p.tolist() == pytest.approx([0, 0.25, 1])


def _brute_lm(docs, targets):
    split = [(d, (t or "").lower().split()) for d, t in docs]
    near = Counter(w for d, ws in split if d in targets for w in ws)
    vocabulary = [w for w, _ in sorted(near.items(), key=lambda x: (-x[1], x[0]))][: lm.VOCABULARY]
    known = set(vocabulary)
    texts = [(d, [w if w in known else None for w in ws]) for d, ws in split]
    models = []
    total = sum(near.values())
    for own in (targets, None):
        chosen = [ws for d, ws in texts if own is None or d in own]
        words, pairs = Counter(w for ws in chosen for w in ws), Counter(p for ws in chosen for p in zip(ws, ws[1:], strict=False))
        models.append((words, pairs, total / max(1, sum(words.values()))))

    def loss(ws, model):
        words, pairs, scale = model
        bits = 0.0
        for k, w in enumerate(ws):
            single = (words[w] * scale + 1) / (sum(words.values()) * scale + len(known) + 1)
            if not k:
                bits -= math.log2(single)
                continue
            pair = (ws[k - 1], w)
            share = lm.WEIGHT * pairs[pair] / words[pair[0]] if None not in pair else 0
            bits -= math.log2(share + (1 - lm.WEIGHT) * single)
        return bits / max(len(ws), 1)

    return [(d, len(ws), loss(ws, models[0]), loss(ws, models[1])) for d, ws in texts]


def _same(got, expected):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    rows = sorted(((r.doc_id, r.n_tokens, r.target_loss, r.background_loss, r.score) for r in got), key=key)
    for a, b in zip(rows, sorted(expected, key=key), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx((*b[2:], b[3] - b[2]), abs=1e-9)


def test_lm_scores_match_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    targets = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r.quality == 1}
    _same(op4_lm_scoring(spark, SMALL).collect(), _brute_lm(docs, targets))


def test_lm_scores_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    targets = spark.createDataFrame([(1,), (6,), (None,), (1,)], "doc_id long")
    _same(score_documents(docs, targets, ["doc_id"]).collect(), _brute_lm([r[:2] for r in ODD], {1, 6}))
    assert all(r.score == 0 for r in score_documents(docs, targets.limit(0), ["doc_id"]).collect())
    assert score_documents(docs.limit(0), targets, ["doc_id"]).count() == 0


def test_lm_counts_keep_all_words_and_pairs(spark):
    """More words than 2**15 and more pairs than 2**19, most once in the target: none is left out."""
    rows = [(k, " ".join(f"w{(k * 7919 + i * (k + 1)) % 40_009}" for i in range(1500))) for k in range(400)]
    docs = spark.createDataFrame([*rows, (1000, "other " * 5)], "doc_id long, text string").repartition(4)
    targets = spark.createDataFrame([(k,) for k, _ in rows], "doc_id long")
    split = [t.split() for _, t in rows]
    words, pairs = Counter(w for ws in split for w in ws), Counter(p for ws in split for p in zip(ws, ws[1:], strict=False))
    assert len(words) > 1 << 15 and len(pairs) > 1 << 19
    total, size = sum(words.values()), len(words) + 1
    got = {r.doc_id: r for r in score_documents(docs, targets, ["doc_id"]).collect()}
    assert len(got) == 401
    for k in range(0, 400, 7):
        ws = split[k]
        bits = -math.log2((words[ws[0]] + 1) / (total + size))
        for a, b in zip(ws, ws[1:], strict=False):
            bits -= math.log2(lm.WEIGHT * pairs[a, b] / words[a] + (1 - lm.WEIGHT) * (words[b] + 1) / (total + size))
        assert got[k].target_loss == pytest.approx(bits / len(ws), abs=1e-9)
