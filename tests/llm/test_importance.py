"""Importance resampling against plain Python, and words' CRCs against zlib."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from feedloom.llm import importance, word_crcs
from feedloom.llm.importance import BUCKETS, gain_planes, gain_sums, op13_importance_resampling, resample
from feedloom.llm.word_hashes import PLAIN

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    words = WORD.findall((text or "").translate(UPPER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def _brute(docs, target):
    """Rows of (doc_id, n_features, weight, score, rank)."""
    bucket = lambda f: zlib.crc32(f.encode()) % BUCKETS
    s = Counter(bucket(f) for _, text in docs for f in _features(text)[1])
    t = Counter(bucket(f) for text in target for f in _features(text)[1])
    a, b = sum(s.values()) + BUCKETS, sum(t.values()) + BUCKETS
    gain = [math.floor(1000 * math.log((t[k] + 1) * a / ((s[k] + 1) * b))) for k in range(BUCKETS)]
    rows = []
    for doc_id, text in docs:
        words, found = _features(text)
        weight = sum(gain[bucket(f)] for f in found) // max(1, len(found))
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(words), len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, row in enumerate(able[: 25 * len(able) // 100]):
        row[5] = k + 1
    return [(r[0], *r[2:]) for r in rows]


def _got(frame):
    return [(r.own.doc_id, r.n_features, r.weight, r.score, r.rank) for r in frame.collect()]


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_crcs_of_words_and_pairs(monkeypatch):
    monkeypatch.setattr(word_crcs, "RUN", 50)
    draw = random.Random(1)
    texts = ["Hello World é über x", None, "", "...", "a" * 200 + " b " + "ü" * 100, "word"]
    texts += ["".join(draw.choice("abC d.éñ\n9") for _ in range(draw.randint(0, 80))) for _ in range(200)]
    words = word_crcs.word_crcs(*word_crcs.flat_bytes(pa.array(["cut off", *texts]).slice(1)), PLAIN)
    expected = [(k, w) for k, text in enumerate(texts) for w in _features(text)[0]]
    assert words.crc.tolist() == [zlib.crc32(w.encode()) for _, w in expected]
    assert words.owner.tolist() == [k for k, _ in expected]
    pairs, owner = word_crcs.pair_crcs(words)
    joined = [(k, f"{a} {b}") for (k, a), (m, b) in zip(expected, expected[1:], strict=False) if k == m]
    assert pairs.tolist() == [zlib.crc32(w.encode()) for _, w in joined]
    assert owner.tolist() == [k for k, _ in joined]


def test_planes_sum_exactly():
    draw = np.random.default_rng(3)
    gain = draw.integers(-9000, 9000, BUCKETS)
    buckets = draw.zipf(1.3, 50_000) % BUCKETS
    owner = np.sort(draw.integers(0, 40, 50_000))
    owner[owner == 7] = 8  # a text without features
    expected = np.bincount(owner, weights=gain[buckets], minlength=41).astype(np.int64)
    assert gain_sums(buckets, owner, 41, gain_planes(gain)).tolist() == expected.tolist()
    assert gain_sums(buckets[:0], owner[:0], 2, gain_planes(gain)).tolist() == [0, 0]


def test_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(importance, "SLICE_BYTES", 5000)
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = [tuple(r) for r in op13_importance_resampling(spark, sf).collect()]
    assert _sorted(got) == _sorted(_brute(docs, target))


def test_odd_rows(spark):
    long = "a B\tc ü " * 20_000
    docs = [(k, f"w{k % 7} " * (15 + k % 20)) for k in range(60)]
    docs += [(None, long), (None, "x " * 30), (3, None), (3, ""), (4, " \n "), (5, long), (5, long), (5, long), (6, "é " * 25)]
    target = ["w1 w1 w2", None, "", "ü a b"]
    # Clashing names: every one that the operator makes itself.
    extra = "weight long, score long, rank long, n_words long, own long, row long, place long, id long, part long, before long"
    frame = spark.createDataFrame([(*d, *range(10)) for d in docs], f"doc_id long, text string, {extra}")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(frame, wanted, frame.columns)
    assert _sorted(_got(got)) == _sorted(_brute(docs, target))
    assert all(tuple(r.own)[2:] == tuple(range(10)) for r in got.collect())
    assert resample(frame.limit(0), wanted, ["doc_id"]).count() == 0
    without = resample(frame, wanted.limit(0), ["doc_id"])
    assert _sorted(_got(without)) == _sorted(_brute(docs, []))
