"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from feedloom.llm import jaccard_join as jj
from feedloom.llm.jaccard_join import jaccard_components, op3_jaccard_join

DOCS = "doc_id long, text string, node string, label string"


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(docs):
    sets = [_set(text) for _, text in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 3 * len(sets[i]) <= 4 * len(sets[j]) and 3 * len(sets[j]) <= 4 * len(sets[i]):
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    parent[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        known = [x for x in (least.get(find(k)), doc_id) if x is not None]
        least[find(k)] = min(known, default=None)
    return [(d, len(s), least[find(k)]) for k, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def _same(got, expected):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r[:3]) for r in got), key=key) == sorted(expected, key=key)


def test_components_of_the_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    _same(op3_jaccard_join(spark, "/root/testdata/sf0.01").collect(), brute_force(docs))


def _families(seed, families, size):
    """Texts edited more and more, around the threshold, with a passage that all share."""
    draw = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(40))
    docs = []
    for f in range(families):
        words = [f"{f}w{draw.randrange(60)}" for _ in range(draw.randrange(5, size))]
        for _ in range(draw.randrange(1, 9)):
            edited = [w if draw.random() > 0.02 else f"x{draw.randrange(9999)}" for w in words]
            docs.append((len(docs), " ".join(edited) + ("" if f % 3 else " " + passage)))
    return docs


def test_near_copies_around_the_threshold(spark):
    docs = _families(5, 120, 120)
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    _same(got, brute_force(docs))


def test_hot_groups_are_cut_into_cells(spark, monkeypatch):
    docs = _families(6, 12, 60) + [(1000 + k, "a b c d e f g h i j " + f"z{k % 7}") for k in range(60)]
    monkeypatch.setattr(jj, "BLOCK_ROWS", 3)
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 100)
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    _same(got, brute_force(docs))


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two"),
        (7, "one two three four five"), (8, "One two three four five six"), (None, "é\x0bx"), (None, "É\x0bx"),
        (9, "w " * 40_000), (10, "w " * 30_000), (4, "other text of five words"),
    ]
    docs = spark.createDataFrame([(*r, "n", "l") for r in rows], DOCS)
    _same(jaccard_components(docs).collect(), brute_force(rows))
    assert jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 16, 17, 200, 1500])
def test_tree_finds_what_all_pairs_find(n):
    draw = np.random.default_rng(n)
    base = [np.unique(draw.integers(0, 1 << 62, 60, dtype=np.uint64)) for _ in range(max(1, n // 6))]
    sets = []
    for k in range(n):
        s = base[k % len(base)].copy()
        s[: draw.integers(0, 9)] = draw.integers(0, 1 << 62)
        sets.append(np.unique(s))
    labels = jj.exact_links(sets)
    forest = jj.Forest(n)
    for i in range(n):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 7 * both >= 3 * (len(sets[i]) + len(sets[j])):
                forest.join(i, j)
    truth = forest.labels()
    assert len(set(zip(labels.tolist(), truth.tolist(), strict=True))) == len(set(labels.tolist())) == len(set(truth.tolist()))
