"""Quality rules as a short-circuit cascade.

Every rule is a Boolean column that says whether a document fails. On a bounded
sample each rule is timed and its share of rejected documents counted; the cascade
asks the rules in the order of rejections per second, and a document that fails one
is not asked the next (CASE WHEN evaluates its branches in turn). The verdict does
not depend on the order, so a differently timed run gives the same result.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.shared import WORD, let, stored, table, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
SAMPLE_ROWS = 2000


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that the text has twice or more.

    Windows are compared by a 64-bit hash. Texts without a repeat, most of them, end at
    one distinct count; in the others the windows are sorted by hash, equal neighbours
    mark the starts, and the union of [start, start + width) is measured.
    """
    size = F.size(words)

    def measure(hashes: Column) -> Column:
        entries = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(entries, lambda e: let(_starts(e), covered))

    def _starts(entries: Column) -> Column:
        last = F.size(entries) - 1
        marked = F.transform(
            entries,
            lambda x, j: F.when(
                ((j > 0) & (F.get(entries, F.greatest(j - 1, F.lit(0)))["h"] == x["h"]))
                | ((j < last) & (F.get(entries, F.least(j + 1, last))["h"] == x["h"])),
                x["i"],
            ),
        )
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def covered(starts: Column) -> Column:
        last = F.size(starts) - 1
        steps = F.transform(
            starts,
            lambda i, j: F.when(
                j < last, F.least(F.lit(width), F.get(starts, F.least(j + 1, last)) - i)
            ).otherwise(F.lit(width)),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def of_words(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(F.slice(w, i, width)))
        return let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(measure(h)),
        )

    return F.when(size <= width, F.lit(0).cast("long")).otherwise(let(words, of_words))


def base_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of the whole text (null: empty).

    ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` and
    ``n_again``, the words equal to the word before.
    """
    text = text_or_empty()
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def measured(w: Column) -> Column:
        chars = F.aggregate(w, F.lit(0).cast("long"), lambda total, word: total + F.length(word))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            chars.alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda word, i: (i > 0) & (word == F.get(w, F.greatest(i - 1, F.lit(0))))))
            .cast("long")
            .alias("n_again"),
        )

    def in_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )

    symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
    return (
        docs.withColumn("_words", let(words, measured))
        .withColumn("_lines", let(lines, in_lines))
        .select("*", "_words.*", "_lines.*", symbols.alias("n_symbols"))
        .drop("_words", "_lines")
    )


def base_failed() -> Column:
    """Too short, or too much of it repeated."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Name of a rule and whether a document fails it; over measures and the text."""
    text = text_or_empty()
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    capitals = F.length(F.regexp_replace(text, r"[^\p{Lu}]", ""))
    loud = F.length(text) - F.length(F.translate(text, "!?", ""))
    return {
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words"))
        | (F.col("word_chars") > 25 * F.col("n_words")),
        "lines": (F.col("n_dup_lines") >= 3) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "again": 5 * F.col("n_again") > F.col("n_words"),
        "capitals": 2 * capitals > letters,
        "letters": 2 * letters < F.col("word_chars"),
        "exclamations": 5 * loud > F.col("n_words"),
    }


def sample_of(docs: DataFrame, key: str, most: int = SAMPLE_ROWS) -> DataFrame:
    """About ``most`` rows, chosen by a hash of the key; all rows of a small table."""
    step = max(1, docs.count() // most)
    return docs.where(F.pmod(F.xxhash64(F.lit(77), F.col(key)), F.lit(step)) == 0)


def cascade_order(sample: DataFrame, tests: Mapping[str, Column]) -> list[tuple[str, float, float]]:
    """Rules by rejections per second on a sample: ``name, share rejected, seconds``.

    The cost of a rule is the time of a job over the stored sample that computes it
    alone. An empty sample keeps the given order.
    """
    found = []
    for name, fails in tests.items():
        began = time.perf_counter()
        row = sample.agg(
            F.sum(F.coalesce(fails, F.lit(False)).cast("long")).alias("failed"), F.count(F.lit(1)).alias("n")
        ).first()
        cost = max(time.perf_counter() - began, 1e-6)
        found.append((name, (row["failed"] or 0) / max(1, row["n"]), cost))
    return sorted(found, key=lambda rule: -rule[1] / rule[2])


def cascade(tests: Mapping[str, Column], order: list[str]) -> Column:
    """Name of the first rule in ``order`` that a document fails, null if none."""
    verdict = F.when(tests[order[0]], F.lit(order[0]))
    for name in order[1:]:
        verdict = verdict.when(tests[name], F.lit(name))
    return verdict


def judge(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with all measures, ``base_failed``, ``kept`` and ``rejected_by``.

    A null or empty text has no words and fails the base rule; repeated rows and null
    ids are judged one by one; an empty table gives an empty result. Columns of
    ``docs`` that are named like a measure are dropped. ``rejected_by`` is the first
    rule in this run's order; ``kept`` is the same in every run.
    """
    names = {"n_words", "word_chars", "n_repeat_words", "n_lines", "n_dup_lines", "n_symbols", "n_again",
             "base_failed", "kept", "rejected_by", "_words", "_lines"}
    docs = docs.drop(*[name for name in docs.columns if name.lower() in names])
    tests = rules()
    # Stored before it is measured: else every row would be measured to pick the sample.
    sample = stored(sample_of(docs.select(key, "text"), key), "rules")
    sample = stored(base_measures(sample).where(~base_failed()), "rules")
    order = [name for name, _, _ in cascade_order(sample, tests)]
    measured = base_measures(docs).withColumn("base_failed", base_failed())
    found = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(tests, order))
    measured = measured.withColumn("rejected_by", found)
    return measured.withColumn("kept", F.col("rejected_by").isNull())


OP9_COLUMNS = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
]


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*OP9_COLUMNS)


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
again AS (SELECT doc_id, win FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows JOIN again USING (doc_id, win)) GROUP BY doc_id),
m AS (
  SELECT doc_id, text, len(w) AS n_words, len(lines) AS n_lines,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_again,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS capitals,
         length(text) - length(translate(text, '!?', '')) AS loud
  FROM t LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines) OR 5 * n_again > n_words OR 2 * capitals > letters OR 2 * letters < word_chars
            OR 5 * loud > n_words) AS kept
FROM b
"""
