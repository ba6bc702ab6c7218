"""Scratch tables and shuffle files that go before a step of many tables ends."""

from pathlib import Path

import corpus_pipeline
from claimforge.llm import jaccard_join
from claimforge.llm.shared import removed, stored
from claimforge.session import RELEASE

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()


def near_copies(spark, n=60):
    """Texts of which neighbours share most words, more of them than a small cell has."""
    rows = [(i, " ".join([*WORDS, *WORDS[::-1], *[f"w{i % 40}x{k}" for k in range(3)]])) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, "alone")], "doc_id long, text string")


def kept(spark, label):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return {path for path in base.glob(f"claimforge/{label}-*") if any(path.glob("*.parquet"))}


def test_the_join_releases_shuffles_and_removes_its_large_tables(spark, monkeypatch):
    seen, before = set(), {label: kept(spark, label) for label in ("texts", "points")}
    plain = jaccard_join.components

    def watched(links):
        seen.add(spark.conf.get(RELEASE))
        return plain(links)

    monkeypatch.setattr(jaccard_join, "components", watched)
    setting = spark.conf.get(RELEASE)
    found = jaccard_join.join(near_copies(spark)).collect()
    assert seen == {"true"} and spark.conf.get(RELEASE) == setting
    assert {row.component_id for row in found if row.doc_id < 60} == {0} and len(found) == 62
    assert kept(spark, "texts") == before["texts"]
    # One table of nodes without their prefixes.
    (points,) = kept(spark, "points") - before["points"]
    assert spark.read.parquet(str(points)).columns == ["doc_id", "n", "node"]


def test_first_cells_are_the_same_in_any_number_of_passes(spark, monkeypatch):
    points = jaccard_join.prefixes(near_copies(spark), [])
    cells = []
    for passes in (1, 4):
        monkeypatch.setattr(jaccard_join, "PASSES", passes)
        parts = [jaccard_join.first_cells(points, number) for number in range(passes)]
        cells.append(sorted(map(tuple, stored(parts[0], "cells", *parts[1:]).collect())))
    assert cells[0] == cells[1] and cells[0]


def test_removed_takes_only_what_was_stored(spark):
    one, other = (stored(spark.range(n), "some") for n in (3, 5))
    removed(one)
    assert not one.inputFiles() or not Path(one.inputFiles()[0].removeprefix("file:")).exists()
    assert other.count() == 5


def test_the_pipeline_keeps_its_input_and_drops_what_it_has_passed(spark, tmp_path, monkeypatch):
    near_copies(spark, 5).write.parquet(str(tmp_path / "documents.parquet"))
    same = [(name, lambda spark, docs, sf_dir: docs) for name in ("first_stage", "second_stage", "last")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", same)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 7
    assert not kept(spark, "first_stage") and len(kept(spark, "second_stage")) == 1
    assert spark.read.parquet(str(tmp_path / "documents.parquet")).count() == 7
