from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from claimforge.llm import imatch


def naive_terms(text):
    return {w for w in re.split(r"[\W_]+", (text or "").lower()) if w}


def test_fingerprints_agree_exactly_with_lexicon_terms(spark, documents):
    texts = [" ".join(f"w{(i * k) % 37}" for k in range(1, 9)) + f" only{i}" for i in range(120)]
    texts += texts[:7] + [t.upper() + "!" for t in texts[:5]]
    found = imatch.fingerprints(documents(enumerate(texts))).orderBy("doc_id").collect()
    df = Counter(w for t in texts for w in naive_terms(t))
    lexicon = {w for w, c in df.items() if max(2, 0.005 * len(texts)) <= c <= max(2, 0.1 * len(texts))}
    kept = [frozenset(naive_terms(t) & lexicon) for t in texts]
    for a in range(0, len(texts), 5):
        for b in range(len(texts)):
            if kept[a] and kept[b]:
                assert (found[a].hashes == found[b].hashes) == (kept[a] == kept[b])
            elif texts[a] == texts[b]:
                assert found[a].hashes == found[b].hashes


def test_next_row_over_many_ranges(spark, documents, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 7)
    ids = [(i * 37) % 101 - 20 for i in range(101)]
    docs = documents([(i, f"text {i}") for i in ids])
    found = {r.doc_id: r.next_text for r in imatch.with_next(docs, "doc_id", "text").collect()}
    order = sorted(ids)
    assert found == {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}


def test_next_row_with_ties_and_nulls(spark, documents, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 3)
    rows = [(5, f"t{k}") for k in range(20)] + [(None, f"n{k}") for k in range(9)] + [(5, "t0")]
    found = imatch.with_next(documents(rows), "doc_id", "text").collect()
    # Following the next text from row to row goes through all rows: a single cycle.
    assert Counter(r.text for r in found) == Counter(r.next_text for r in found) == Counter(t for _, t in rows)
    assert sum(r.doc_id is None and r.next_text.startswith("t") for r in found) == 1


def test_query_on_odd_rows(spark, odd, none):
    rows = imatch.fingerprints(odd).select("doc_id", "text", "hashes").collect()
    assert len(rows) == odd.count()
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.hashes) == r.hashes
    assert imatch.fingerprints(none).collect() == []
    assert imatch.with_next(none, "doc_id", "text").collect() == []


def test_edited_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import hashlib

    order = sorted(docs)
    for r in imatch.op1_imatch(spark, "/root/testdata/sf0.001").collect():
        text, after = docs[r.doc_id], docs[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1


def test_a_hot_group_keeps_its_own_terms(spark, documents):
    """A third of the rows are copies and near copies, of one long and one short text."""
    rng = random.Random(5)
    fill = [f"fill{i}" for i in range(3000)]
    bases = [[f"{name}{i}" for i in range(size)] for name, size in (("long", 60), ("short", 10))]
    texts = [" ".join(["common", *rng.choices(fill, k=30)]) for _ in range(800)]
    for base in bases:
        for k in range(200):
            near = list(base)
            if k % 4:
                near[rng.randrange(len(near))] = f"edit{rng.randrange(10**9)}"
            texts.append(" ".join(["common", *near]))
    docs = documents(enumerate(texts))
    bits = imatch.lexicon_map(docs)
    words = [w for base in bases for w in base] + ["common"]
    row = spark.range(1).select(*[imatch.terms(F.lit(w))[0].alias(w) for w in words]).first()
    known = {w: bits[(row[w] % (1 << imatch.MAP_BITS)) // 64] >> row[w] % 64 & 1 for w in words}
    assert not known.pop("common") and all(known.values())
    found = imatch.fingerprints(docs).orderBy("doc_id").select("hashes").collect()
    # A near copy agrees with the text itself in some subset, as few as its terms are.
    for start in (800, 1000):
        pairs = [zip(found[start].hashes, row.hashes, strict=True) for row in found[start : start + 200]]
        assert sum(any(a is not None and a == b for a, b in pair) for pair in pairs) > 150
