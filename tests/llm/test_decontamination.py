from __future__ import annotations

import hashlib
import random
import re

import pytest

from claimforge.llm import decontamination as lib
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def plain(text, items, n):
    """Hit places and items by trying every window at every place."""
    w, hit, found = words(text), set(), set()
    for item, other in items:
        v = words(other)
        size = min(n, len(v))
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add("" if item is None else str(item))
    return len(w), sorted(hit), sorted(found)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, row int, window string")


def compare(spark, documents, rows, items, n=10):
    found = lib.find(documents(rows), benchmark(spark, items), n, "doc_id", "text").collect()
    actual = sorted((str(r.doc.doc_id), r.doc.text or "", r.n_words, sorted(r.hit), r["items"]) for r in found)
    expected = sorted((str(r[0]), r[1] or "", *plain(r[1], items, n)) for r in rows)
    assert actual == expected


def texts(seed, count, vocabulary, longest):
    draw = random.Random(seed)
    gaps = [" ", ", ", "\n", "-", "  ", "._"]
    return ["".join(draw.choice(vocabulary) + draw.choice(gaps) for _ in range(draw.randrange(longest))) for _ in range(count)]


@pytest.mark.parametrize("n, shortest", [(10, 10), (10, 1), (5, 4), (2, 1), (1, 1)])
def test_equals_every_window_at_every_place(spark, documents, n, shortest):
    small = ["a", "B", "b", "é", "É", "x1", "ΟΔΟΣ", "οδος", "ſ", "K", "k"]
    own = [t for t in texts(n, 60, small, 25) if len(words(t)) >= shortest]
    items = [(i % 17, t) for i, t in enumerate(own)]
    rows = [(i, t) for i, t in enumerate(texts(n + 1, 60, small, 60))]
    rows += [(100 + i, f"Before it. {t.upper()} after!") for i, t in enumerate(own)]
    compare(spark, documents, rows, items, n)


def test_odd_rows(spark, documents, odd, none, monkeypatch):
    items = [(3, "one two three"), (3, "One, TWO; three"), (None, "word1 tail1"), (4, None), (5, " .,"), (6, "")]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    compare(spark, documents, rows, items)
    compare(spark, documents, rows, [])
    assert lib.find(none, benchmark(spark, items), 10, "doc_id").collect() == []
    # The same by shuffles.
    monkeypatch.setattr(lib, "MOST_BROADCAST", -1)
    compare(spark, documents, rows, items)


def test_spans_and_documents_are_removed(spark, documents):
    items = [(1, "the quick brown fox jumps over the lazy dog again today")]
    rows = [
        (1, "Say: the Quick brown fox jumps over the lazy dog again TODAY, he said."),
        (2, "the quick brown fox jumps over the lazy dog"), (3, None), (4, "..."),
        (5, "The quick brown fox jumps over the lazy dog again"),
    ]
    docs = documents(rows)
    cleaned = {r.doc_id: r for r in lib.decontaminate(docs, benchmark(spark, items)).collect()}
    assert {i: r.text for i, r in cleaned.items()} == {1: "Say: he said.", 2: rows[1][1], 3: None, 4: "...", 5: ""}
    assert list(cleaned[1].asDict()) == docs.columns and cleaned[1].row == docs.first().row
    left = lib.decontaminate(docs, benchmark(spark, items), remove="documents")
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4] and left.columns == docs.columns
    with pytest.raises(ValueError):
        lib.decontaminate(docs, benchmark(spark, items), remove="lines")


def test_query_equals_sql_and_plain_code(spark):
    found = lib.op12_decontamination(spark, SMALL)
    assert differences(found, connect(SMALL), lib.OP12_SQL) == []
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    hits = 0
    for r in found.collect():
        n, hit, own = plain(docs[r.doc_id], items, 10)
        digest = hashlib.sha256(",".join(own).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(hit), len(own), digest, bool(hit))
        hits += bool(hit)
    assert hits
