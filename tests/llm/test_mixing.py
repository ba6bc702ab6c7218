from __future__ import annotations

import math

import pytest

from claimforge.llm import mixing


def naive_targets(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        stop = {s for s in open_ if weight[s] * level >= repeats * sizes[s]}
        if not stop:
            return target | {s: weight[s] * level for s in open_}
        for s in stop:
            target[s] = repeats * sizes[s]
            left -= target[s]
        open_ -= stop
    return target


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 400, "c": 90, None: 7, "é": 1000, "Z": 3}, {"a": 5}, {"a": 0, "b": 0}, {"x": 100, "y": 1}]
)
def test_targets_equal_repeated_resharing(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert found == pytest.approx(naive_targets(sizes))


def test_taken_words_come_near_their_targets(spark, documents):
    docs = documents([(i, "w " * (1 + i * 7 % 90), f"s{i % 3}" if i % 5 else None) for i in range(600)])
    rows = mixing.mix(mixing.documents_to_mix(docs)).collect()
    by = {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        taken, target, size = by.get(r.source, (0, 0, 0))
        by[r.source] = (taken + r.taken, r.target, size + r.size)
    sizes = {s: size for s, (_, _, size) in by.items()}
    assert {s: t for s, (_, t, _) in by.items()} == pytest.approx(naive_targets(sizes))
    assert all(abs(taken - target) <= 90 for taken, target, _ in by.values())
    again = mixing.mix(mixing.documents_to_mix(docs)).collect()
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: r.taken for r in again}


def test_selection_is_the_prefix_by_key(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    docs = documents([(i, "w " * (i % 9)) for i in range(300)])
    base = mixing.documents_to_mix(docs)
    keys = {
        r.doc_id: r.k
        for r in base.select("doc_id", mixing.exponential_key("doc_id", base.quality).alias("k")).collect()
    }
    rows = sorted(mixing.mix(base).collect(), key=lambda r: keys[r.doc_id])
    total = sum(r.size for r in rows)
    epochs, rest = divmod(rows[0].target, total)
    upto = 0
    for r in rows:
        upto += r.size
        assert r.taken == r.size * (epochs + (2 * upto - r.size <= 2 * rest))


def test_better_texts_come_first(spark):
    rows = spark.createDataFrame(
        [(i, "s", 10, 1.0 if i % 2 else 0.2) for i in range(4000)], "doc_id long, source string, size long, quality double"
    )
    taken = mixing.mix(rows, share=0.5).groupBy((rows.doc_id % 2).alias("odd")).sum("taken").collect()
    taken = {r.odd: r[1] for r in taken}
    # P(key with rate 1 < key with rate 0.2) favours odd ids; exact shares solve 2 - x - x^0.2 = 1.
    x = next(q for q in (k / 1e4 for k in range(10_000)) if 2 - (1 - q) - (1 - q) ** 0.2 >= 1)
    assert math.isclose(taken[1] / 20_000, x, abs_tol=0.05)


def test_odd_rows(spark, odd, none):
    rows = mixing.mix(mixing.documents_to_mix(odd)).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix(mixing.documents_to_mix(none)).collect() == []
