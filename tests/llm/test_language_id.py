"""Language identification: held-out accuracy, and sums against a plain version."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest

from feedloom.llm import language_id
from feedloom.llm.language_id import BUCKETS, identify, op11_language_id

SF = "/root/testdata/sf0.01"


def _ngrams(text):
    signs = [c if c.isalpha() else " " for c in f" {(text or '').lower()} "]
    found = []
    for n in (1, 2, 3):
        for k in range(len(signs) - n + 1):
            gram = signs[k : k + n]
            if any(c != " " for c in gram) and " " not in gram[1:-1]:
                key = sum(ord(c) << (21 * i) for i, c in enumerate(gram)) + n
                found.append(((key * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> 48)
    return found


def _part(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def _brute(docs):
    """(doc_id, held_out, lang_pred, score) of all (doc_id, text, lang)."""
    counts, rows = {}, Counter()
    for doc_id, text, lang in docs:
        if lang is not None and _part(doc_id):
            rows[lang] += 1
            counts.setdefault(lang, Counter()).update(_ngrams(text))
    out = []
    for doc_id, text, _ in docs:
        found = Counter(_ngrams(text))
        if not found or not rows:
            out.append((doc_id, _part(doc_id) == 0, "und", 0.0))
            continue
        sums = {}
        for lang in sorted(rows):
            total = sum(counts[lang].values()) + 0.5 * BUCKETS
            logs = sum(n * math.log((counts[lang][b] + 0.5) / total) for b, n in found.items())
            sums[lang] = logs + math.log(rows[lang] / sum(rows.values()))
        best = max(sums, key=lambda lang: sums[lang])
        score = 1 / sum(math.exp(s - sums[best]) for s in sums.values())
        out.append((doc_id, _part(doc_id) == 0, best, score))
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def _same(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(_sorted(got), _sorted(expected), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-6)


def test_held_out_rows_and_plain_version(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in op11_language_id(spark, SF).collect()]
    _same(got, _brute(docs))
    langs = {d: lang for d, _, lang in docs}
    tested = [r for r in got if r[1] and langs[r[0]] is not None and r[2] != "und"]
    assert len(tested) > 150
    assert sum(r[2] == langs[r[0]] for r in tested) >= 0.97 * len(tested)


ODD = [
    (1, "the house", "en"), (2, "das haus", "de"), (2, "das haus", "de"), (None, "the The", "en"), (None, None, None),
    (3, None, "en"), (4, "", "de"), (5, " 12 -- \n", "de"), (6, "İstanbul ΣΑΣ é 中文字", "tr"), (7, "no label", None),
    (8, "the b\tc " * 30_000, None), (9, "x", ""), (10, "ab" * 50_000, "en"), (11, "the", None), (12, "das", None),
]


def test_odd_rows(spark):
    extra = "own long, held_out long, score long, lang_pred long, bucket long, n long"
    frame = spark.createDataFrame([(*d, *range(6)) for d in ODD], f"doc_id long, text string, lang string, {extra}")
    got = identify(frame, frame.columns).collect()
    assert all(tuple(r.own)[3:] == tuple(range(6)) for r in got)
    _same([(r.own.doc_id, r.held_out, r.lang_pred, r.score) for r in got], _brute(ODD))
    unlearnt = identify(frame.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang"), ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in unlearnt} == {("und", 0.0)}
    assert identify(frame.limit(0), ["doc_id"]).count() == 0
    many = spark.range(400).selectExpr("id AS doc_id", "'x' AS text", "CAST(id AS STRING) AS lang")
    with pytest.raises(Exception, match="more than 128 languages"):
        identify(many, ["doc_id"])


def test_pieces_give_the_same_ngrams(monkeypatch):
    texts = [t for _, t, _ in ODD] + ["ab, cd" * 40]
    whole = [Counter(_ngrams(t)) for t in texts[-1:] + texts[:8]]
    monkeypatch.setattr(language_id, "PIECE", 7)
    for text, expected in zip(texts[-1:] + texts[:8], whole, strict=True):
        found = Counter()
        for owners, group in language_id.pieces([text]):
            for bucket, _ in language_id.ngrams(owners, group):
                found.update(bucket.tolist())
        assert found == expected
