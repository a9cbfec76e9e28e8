"""Vector codes against a plain version that compares every part with every entry."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from feedloom.llm import vector_codes
from feedloom.llm.vector_codes import assign, choose_pivots, codebook_digest, encode, squared


def _brute(rows, entries=256):
    """Rows of (vec_id, code, error, label_error) and the digest of the codebooks."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    lengths = [len(r[1]) for r in good]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    good = [r for r in good if len(r[1]) == dim]
    width = -(-dim // 4)
    whole = []
    for _, vector, _ in good:
        flat = [math.floor(1024 * x) for x in vector] + [0] * (4 * width - dim)
        whole.append([flat[k * width : (k + 1) * width] for k in range(4)])
    first = sorted(range(len(good)), key=lambda k: (good[k][0] is None, good[k][0] or 0, list(good[k][1])))[:entries]
    books = [[whole[k][p] for k in first] for p in range(4)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            own = [nearest(w[p], books[p])[1] for w in whole]
            for k in set(own):
                held = [w[p] for w, o in zip(whole, own, strict=True) if o == k]
                books[p][k] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    rows, of_label = [], {}
    for (vec_id, _, label), w in zip(good, whole, strict=True):
        found = [nearest(w[p], books[p]) for p in range(4)]
        rows.append((vec_id, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        of_label[label] = of_label.get(label, 0) + rows[-1][2]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(i, c, e, of_label[label]) for i, c, e, label in rows], hashlib.sha256(text.encode()).hexdigest()


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def _compare(spark, rows, extra=()):
    schema = "vec_id long, embedding array<float>, label int" + "".join(f", {name} long" for name in extra)
    frame = spark.createDataFrame([(*r, *range(len(extra))) for r in rows], schema)
    coded, books = encode(frame, ["vec_id", *extra], "vec_id", "label")
    got = [(r.own.vec_id, r.code, r.error, r.label_error) for r in coded.collect()]
    stored = [(r.vec_id, list(r.embedding) if r.embedding is not None else None, r.label) for r in frame.collect()]
    expected, digest = _brute(stored)
    assert _sorted(got) == _sorted(expected)
    assert codebook_digest(books) == digest


@pytest.mark.parametrize(("dim", "scale"), [(16, 1.0), (8, 0.002), (10, 1.0), (3, 5000.0)])
def test_against_every_entry(spark, dim, scale):
    """The second case has very many ties; the last leaves the range of exact products."""
    draw = random.Random(dim)
    centres = [[draw.gauss(0, scale) for _ in range(dim)] for _ in range(9)]
    rows = []
    for k in range(700):
        vector = [draw.gauss(c, scale / 5) for c in draw.choice(centres)]
        rows.append((draw.randint(0, 10**6), vector, draw.choice([None, 1, 2, 3])))
    _compare(spark, rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [0.5, -0.25, 0.1, 0.0], 1), (3, [0.5, -0.25, 0.1, 0.0], None), (3, [0.5, -0.3, 0.1, 0.0], None), (4, None, 1),
        (5, [0.5, -0.25, 0.1, 0.0], 1), (6, [nan, 0.0, 0.0, 0.0], 1), (7, [None, 0.0, 0.0, 0.0], 1), (8, [0.0, inf, 0.0, 0.0], 1),
        (9, [1.0, 2.0], 1), (10, [], 1), (None, [0.1, 0.2, -0.3, 0.4], 2), (None, [0.1, 0.2, -0.3, 0.4], None),
    ]
    _compare(spark, rows, ("code", "error", "label_error", "own", "id", "of_label", "parts", "near", "dim"))
    _compare(spark, [(k, [], None) for k in range(3)])
    schema = "vec_id long, embedding array<float>, label int"
    for none in ([], [(1, None, 1), (2, [nan], 1)]):
        coded, books = encode(spark.createDataFrame(none, schema), ["vec_id"], "vec_id", "label")
        assert coded.collect() == [] and coded.columns == ["own", "code", "error", "label_error"] and books.size == 0
    with pytest.raises(Exception, match="not supported"):
        encode(spark.createDataFrame([(1, [1e30] * 4, 1)], schema), ["vec_id"], "vec_id", "label")


def test_bounds_prune_and_keep_the_result(monkeypatch):
    draw = np.random.default_rng(1)
    centres = draw.integers(-100_000, 100_000, (256, 16))
    parts = centres[draw.integers(0, 256, 3000)] + draw.integers(-30, 30, (3000, 16))
    pivots = choose_pivots(centres)
    near, gaps = (np.sqrt(squared(x, pivots)).astype(np.float32) for x in (parts, centres))
    evaluated = []
    plain = vector_codes.exact_squares
    monkeypatch.setattr(vector_codes, "exact_squares", lambda a, b: evaluated.append(len(a) * len(b)) or plain(a, b))
    entry, gap = assign(parts, near, centres, gaps.T)
    full = squared(parts, centres)
    assert entry.tolist() == full.argmin(axis=1).tolist() and gap.tolist() == full.min(axis=1).tolist()
    assert sum(evaluated) < 0.2 * full.size
