"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key, -ln(u) / quality, with u from a hash of its
id: within a source, documents in the order of these keys are a weighted sample
without replacement. A source's target is a number of words; as many complete epochs
as fit come first, and the rest is the prefix of the ordered documents whose words
sum up to it. The prefix sum has two levels, key ranges and documents within a range,
so that one source may hold most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimforge.llm.shared import WORD, stored, table, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = "mix-1"
SYMBOLS = "#*$%&|<>!"
# Rows that one key range of a source is meant to hold.
RANGE_ROWS = 4_000


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def text_quality(size: Column, text: str = "text") -> Column:
    """1 for prose, less the more symbols a word has; never 0."""
    text = text_or_empty(text)
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(size > 0, size / (size + symbols)).otherwise(F.lit(1.0))


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """Per source (rows ``source, source_size``) its ``rank`` and ``target`` words.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of
    all words. A target stops at ``repeats`` times its source; what it can't take goes
    to the others by weight. In order of ``repeats * size / weight`` the sources that
    stop are a prefix, which gives the level directly. One row per source goes through
    one task here, no document.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * repeats)
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("stop", F.col("most") / F.col("weight"))
    )
    before = W.orderBy("stop", "rank").rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rest = F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0))
    rows = rows.withColumn("level", rest / left)
    # The first source that does not stop sets the level of all that follow.
    level = F.min(F.when(F.col("stop") > F.col("level"), F.struct("stop", "rank", "level"))).over(everything)
    rows = rows.withColumn("common", level["level"])
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.col("common"))
    return rows.select("source", "source_size", "rank", F.coalesce(target, F.col("most").cast("double")).alias("target"))


def exponential_key(doc_id: str, quality: Column, seed: str = SEED) -> Column:
    """-ln(u) / quality with u in (0, 1) from the first 52 bits of a digest."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(doc_id).cast("string")).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**52))) / quality


def mix(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id, source, size, quality`` with ``source_size``, ``target`` and ``taken``.

    ``taken`` is the number of words the mix takes of a document: its size times the
    source's complete epochs, plus once more if the fractional selection has it. The
    document at the edge is taken if that brings the source nearer to its target, so a
    source misses it by half a document at most. Documents without words take 0. A
    null source is a source of its own; a null or repeated id is a row like any other
    (equal keys are ordered by size); quality must be positive, null counts as 1. An
    empty table gives an empty result. ``rows`` is read three times: store it first.
    """
    rows = rows.select(
        "doc_id",
        "source",
        F.coalesce("size", F.lit(0)).cast("long").alias("size"),
        exponential_key("doc_id", F.coalesce("quality", F.lit(1.0)), seed).alias("key"),
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = source_targets(sizes.drop("n"), weights, share, repeats)
    targets = targets.join(
        sizes.select(F.col("source").alias("_source"), "n"), F.col("source").eqNullSafe(F.col("_source"))
    )
    ranges = F.greatest(F.lit(64), F.ceil(F.col("n") / RANGE_ROWS))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.select(
        F.col("source").alias("_source"), "source_size", "rank", "target", ranges.alias("ranges"),
        epochs.alias("epochs"), (F.col("target") - epochs * F.col("source_size")).alias("rest"),
    )
    placed = rows.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    # 1 - exp(-key) spreads the keys over the ranges and keeps their order.
    placed = placed.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * F.col("ranges")))

    in_range = placed.groupBy("rank", "range").agg(F.sum("size").alias("range_size"))
    before = W.partitionBy("rank").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = in_range.select(
        "rank", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("start")
    )
    inside = W.partitionBy("rank", "range").orderBy("key", "doc_id", "size").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    ordered = placed.withColumn("upto", F.sum("size").over(inside)).join(starts, ["rank", "range"])
    upto = F.col("start") + F.col("upto")
    # upto - rest <= rest - (upto - size): with it the prefix ends nearer to the target.
    chosen = (2 * upto - F.col("size") <= 2 * F.col("rest")).cast("long")
    return ordered.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * (F.col("epochs") + chosen)).cast("long").alias("taken"),
    )


def documents_to_mix(docs: DataFrame) -> DataFrame:
    """One scan of the texts: ``doc_id, source, size, quality``."""
    size = word_count()
    return stored(docs.select("doc_id", "source", size.alias("size"), text_quality(size).alias("quality")), "mix")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents_to_mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# No document has the same key as another here, so the order of equal keys is not spelled out.
OP3_SQL = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>!', '')) AS symbols
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix-1|' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
           / CASE WHEN size > 0 THEN size::DOUBLE / (size + symbols) ELSE 1.0 END AS key
  FROM base),
sized AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, sum(source_size) OVER () * 1.5::DOUBLE AS budget
  FROM sized),
weighed AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 2 * source_size AS most FROM ranked),
levels AS (
  SELECT *, most / weight AS stop,
         (budget - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         coalesce(least(most::DOUBLE, weight * (SELECT arg_min(level, [stop, rank]) FROM levels WHERE stop > level)),
                  most::DOUBLE) AS target
  FROM levels),
placed AS (
  SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + (2 * upto - size <= 2 * (target - epochs * source_size))::INT))::BIGINT AS taken
FROM placed
"""
