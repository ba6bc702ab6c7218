from __future__ import annotations

import time

import numpy as np
import pytest

from claimforge.llm import toxicity
from claimforge.llm.shared import class_weights, fold
from claimforge.llm.toxicity import Grammar, Reader

CHECKED = "/root/testdata/sf0.01"


@pytest.fixture
def reader():
    return Reader(Grammar({"idiot": 5.0, "kill": 2.0}, {"worthl": 4.0}))


def test_clauses_not_words(reader):
    total = lambda text: reader.total(text)[0]
    plain = total("what an idiot.")
    assert plain == 5.0
    assert total("you idiot") > plain > total("she said what an idiot") > 0
    assert total("he is not an idiot") < total("he is an idiot")
    assert total("not here. what an idiot") == plain
    assert total("idiotic things") == 0 and total("WORTHLESS") == 4.0
    assert total("an idiot, an idiot; an idiot\nfine") == 15.0
    assert reader.total("an idiot; an idiot\nfine")[1] == 2


def test_a_reader_equals_the_grammar_word_by_word(reader):
    import itertools
    import re

    words = ["you", "not", "said", "idiot", "tree", "worthless", ".", "\n", "kill"]
    for picked in itertools.product(words, repeat=4):
        text = " ".join(picked)
        expected = sum(reader.grammar.clause(re.findall(toxicity.WORDS, c)) for c in re.split(toxicity.CLAUSE_END, text))
        assert reader.total(text)[0] == pytest.approx(expected)


def test_lexicon_ignores_shared_words_of_near_copies():
    rng = np.random.default_rng(1)
    word = lambda: f"{''.join(rng.choice(list('bcdfg'), 5))}"
    clean = [" ".join(word() for _ in range(40)) for _ in range(200)]
    copied = clean[0].split()
    toxic = [" ".join([*copied[:39], f"end{i}"]) + " scumbag" for i in range(30)]
    toxic += [" ".join([word() for _ in range(40)] + ["scumbag", f"zorgl{word()}", f"zorgl{word()}"]) for _ in range(30)]
    grammar = toxicity.learn(clean[1:] + toxic, [0] * 199 + [1] * 60)
    assert "scumbag" in grammar.words and set(grammar.stems) == {"zorgl"}
    assert not set(copied[:39]) & set(grammar.words)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{CHECKED}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op10_toxicity(spark, CHECKED).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.9
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_odd_rows(odd, none):
    grammar = Grammar({"idiot": 5.0}, {})
    rated = toxicity.rate(odd, grammar)
    assert rated.columns == [*odd.columns, "toxicity", "toxic_clauses", "toxic"]
    rows = rated.collect()
    assert len(rows) == odd.count() and {r.toxicity for r in rows} == {grammar.score(0.0)}
    assert toxicity.rate(none, grammar).collect() == []
    empty = toxicity.learn([], [])
    assert Reader(empty).total("what an idiot")[0] == 0 and Reader(Grammar({}, {})).total("x") == (0.0, 0)


def test_calibration_does_not_drift_with_a_capped_sample():
    grammar = Grammar({"idiot": 5.0}, {})
    clean = ["a fine day"] * 760 + ["he is not an idiot"] * 40
    toxic = ["fine again"] * 10 + ["you idiot"] * 90
    whole = toxicity.calibrated(grammar, clean + toxic, [0] * 800 + [1] * 100)
    # Every eighth clean text, as under a cap of 100 rows a class.
    capped = toxicity.calibrated(grammar, clean[::8] + toxic, [0] * 100 + [1] * 100, (8.0, 1.0))
    assert capped.slope == pytest.approx(whole.slope, abs=0.05) and capped.shift == pytest.approx(whole.shift, abs=0.05)


def test_class_weights_are_counted_over_all_training_labels(spark):
    rows = [(i, int(i % 10 == 0)) for i in range(1000)] + [(None, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    keep = fold("doc_id", 4) != 2
    n = [labels.where(keep & labels.doc_id.isNotNull() & (labels.toxic == value)).count() for value in (0, 1)]
    assert class_weights(labels, "toxic", keep, 100) == (n[0] / 100, 1.0)


def test_rare_insults_have_a_weight_by_count():
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("bcdfghjk"), 6))
    text = lambda *more: " ".join([*(word() for _ in range(8)), *more])
    clean = [text() for _ in range(2500)]
    toxic = [text("scumbag") for _ in range(2400)] + [text("rotter") for _ in range(25)] + [text("seldom") for _ in range(5)]
    grammar = toxicity.learn(clean + toxic, [0] * len(clean) + [1] * len(toxic))
    # In about 1% of the toxic texts; five texts of an even sample may be chance.
    assert grammar.weight("rotter") > 0 and grammar.weight("scumbag") > 0 and grammar.weight("seldom") == 0


def test_the_lexicon_has_no_greatest_size():
    names = [a + b + c + "x" * 3 for a in "abcdefgh" for b in "ijklmnop" for c in "qrstu"]
    clean = [f"plain{i} day{i} here{i}" for i in range(320)]
    toxic = [f"what{i}{k} {name} now{i}{k}" for i, name in enumerate(names) for k in range(25)]
    grammar = toxicity.learn(clean + [f"more{i} calm{i} words{i}" for i in range(8000)] + toxic, [0] * 8320 + [1] * len(toxic))
    assert all(grammar.weight(name) > 0 for name in names)


def test_long_texts_take_linear_time():
    reader = toxicity.Reader(toxicity.Grammar({"idiot": 1.0}, {}, 1.0, 0.0))
    part = "you idiot, and so on without any end of this clause " * 20

    def seconds(times):
        text = (part + ". ") * times
        start = time.perf_counter()
        total, clauses = reader.total(text)
        assert clauses == times or total >= 0
        return time.perf_counter() - start

    seconds(20)
    small, large = (min(seconds(n) for _ in range(3)) for n in (100, 1600))
    assert large < 60 * small + 0.05


def test_clauses_do_not_depend_on_what_was_read_before():
    reader = toxicity.Reader(toxicity.Grammar({"idiot": 1.0}, {}, 1.0, 0.0))
    clauses = ["you idiot", "fine day", "not an idiot", "he said you idiot", "", "idiot"]
    alone = sum(reader.total(c + ".")[0] for c in clauses)
    assert reader.total(". ".join(clauses) + ".")[0] == pytest.approx(alone)
