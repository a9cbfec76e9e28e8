"""Quality rules and mixing against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from feedloom.llm import quality_rules as rules
from feedloom.llm.mixing import mix, op6_source_mixing
from feedloom.llm.quality_rules import judge, op5_quality_rules

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, size string"
ODD = [
    (1, "one two\tthree one two three\n\none two three four\n", "a", "x"),
    (1, "one two\tthree one two three\n\none two three four\n", "a", "x"),
    (2, None, "b", None),
    (3, "", None, None),
    (4, " \n\t ", "é", None),
    (None, "a b", "a", None),
    (5, "w " * 30_000, "a", None),
    (6, "#*$ %& |<> é\n é \n é", "Z", None),
    (7, " ".join(f"w{i}" for i in range(80)), "Z", None),
]


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _counts(text):
    words, text = _words(text), text or ""
    found = defaultdict(list)
    for i in range(len(words) - 2):
        found[tuple(words[i : i + 3])].append(i)
    hit = {i + k for at in found.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if _words(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in rules.SYMBOLS for c in text),
        len(lines) - len(set(lines)),
        len(hit),
    )


def _hash(*parts):
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed=seed)
    return seed % rules.BUCKETS


def _buckets(text):
    tokens = re.findall(r"[^\W_]+|(?:[^\w\s]|_)+", text or "")
    return [_hash(t) for t in tokens] + [_hash(a, b) for a, b in zip(tokens, tokens[1:], strict=False)]


def _brute_judge(docs, trusted):
    raw, good = Counter(), Counter()
    for doc_id, text in docs:
        grams = Counter(_buckets(text))
        raw += grams
        if doc_id in trusted:
            good += grams
    n, t = sum(raw.values()), sum(good.values())
    ratio = {b: math.log((good[b] + rules.PRIOR * c / n) / (t + rules.PRIOR) / (c / n)) for b, c in raw.items()}
    for doc_id, text in docs:
        grams = _buckets(text)
        yield (doc_id, *_counts(text), sum(ratio[b] for b in grams) / len(grams) if grams else 0.0)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def _same(got, expected):
    for a, b in zip(_sorted(got), _sorted(expected), strict=True):
        assert a[:-1] == b[:-1]
        assert a[-1] == pytest.approx(b[-1], abs=1e-9)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio")


def test_quality_rules_match_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r.quality == 1}
    got = op5_quality_rules(spark, SMALL).collect()
    _same([(r.doc_id, *(r[c] for c in COLUMNS)) for r in got], list(_brute_judge(docs, trusted)))
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.ratio >= rules.MIN_RATIO)


def test_quality_rules_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    trusted = spark.createDataFrame([(7,), (7,), (None,)], "doc_id long")
    got = judge(docs, trusted, ["doc_id", "size"])
    _same(
        [(r.own.doc_id, *(r[c] for c in COLUMNS)) for r in got.collect()],
        list(_brute_judge([r[:2] for r in ODD], {7})),
    )
    assert {r.own.doc_id for r in got.collect() if r.kept} == {7}
    assert judge(docs.limit(0), trusted, ["doc_id"]).count() == 0


def test_without_trusted_documents_the_base_rules_decide(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    got = judge(docs, docs.select("doc_id").limit(0), ["doc_id"]).collect()
    assert all(r.ratio == 0 and r.kept != r.base_failed for r in got)


def _targets(sizes):
    """Share again and again until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    open_, fixed = set(names), {}
    while open_:
        level = (sum(sizes.values()) - sum(fixed.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not above:
            return {**fixed, **{s: weight[s] * level for s in open_}}
        fixed.update({s: 3 * sizes[s] for s in above})
        open_ -= above
    return fixed


def _check_mix(docs, rows, slack):
    sizes = defaultdict(int)
    source = {}
    for doc_id, text, name in docs:
        sizes[name] += len(_words(text))
        source[doc_id] = name
    targets, taken, largest = _targets(sizes), defaultdict(int), defaultdict(int)
    for r in rows:
        name = source[r.doc_id]
        assert r.source_size == sizes[name]
        assert r.target == pytest.approx(targets[name])
        assert 0 <= r.taken <= 3 * r.size
        taken[name] += r.taken
        largest[name] = max(largest[name], r.size)
    for name, target in targets.items():
        assert abs(taken[name] - target) <= slack(largest[name], target)


def test_mix_meets_targets(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = op6_source_mixing(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    _check_mix(docs, got, lambda largest, target: 0.02 * target)
    again = op6_source_mixing(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_rates_solve_the_dual(spark):
    """Every rate is exp(tilt * size) of one tilt per source, and the rates meet the target."""
    sums, sizes, tilt = defaultdict(float), defaultdict(int), defaultdict(set)
    for r in mix(spark.read.parquet(f"{SMALL}/documents.parquet"), ["source"]).collect():
        key = (r.own.source, r.target)
        sums[key] += r.rate * r["size"]
        sizes[key] += r["size"]
        if 0 < r.rate < 2.999:
            tilt[key].add(round(math.log(r.rate) / r["size"], 9))
    assert len(sums) > 5 and all(len(found) <= 1 for found in tilt.values())
    for (source, target), total in sums.items():
        assert total == pytest.approx(target, rel=1e-6), source
    # A plain solver finds the same tilts: bisection on the sum of capped rates.
    for (source, target), (found,) in ((k, t) for k, t in tilt.items() if t):
        own = [r["size"] for r in mix(spark.read.parquet(f"{SMALL}/documents.parquet").where(f"source = '{source}'"), ["source"]).collect()]
        low, high = -1.0, 1.0
        for _ in range(80):
            middle = (low + high) / 2
            mass = sum(n * min(3.0, math.exp(middle * n)) for n in own)
            low, high = (middle, high) if mass < target else (low, middle)
        assert found == pytest.approx(middle, abs=2e-9)
        break


def test_mix_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    got = mix(docs, ["doc_id", "size", "source"]).collect()
    assert len(got) == len(ODD)
    sizes = defaultdict(int)
    for _, text, source, _ in ODD:
        sizes[source] += len(_words(text))
    expected = _targets(sizes)
    for r in got:
        assert r.target == pytest.approx(expected[r.own.source])
        assert 0 <= r.taken <= 3 * r["size"]
    assert mix(docs.limit(0), ["doc_id"]).count() == 0
