"""Two-pass external shuffle into numbered shards.

Pass one scatters records into buckets of a chosen size by a seeded hash of the
record's place in the stored table, so that no document, key or repeated row can
fill a bucket. Pass two brings a bucket into one task, puts it into a defined order,
runs a seeded Fisher-Yates shuffle over it and writes it. A bucket begins where the
buckets before it end, which gives every record a global position; shards are equal
slices of those positions, so their row counts differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimforge.llm.shared import text_or_empty
from claimforge.session import scratch_dir

BUCKET_BYTES = 8 << 20
SEED = 20_240_601
# Buckets whose counts are summed up by one task of the prefix sum.
SPAN = 4096


def document_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text (none for null) plus 8 for the id."""
    return F.octet_length(text_or_empty(text)).cast("long") + F.lit(8)


def prefix_starts(counts: DataFrame) -> DataFrame:
    """``bucket, n`` with ``start``, the rows of all buckets before; in two levels, so
    that one task sees ``SPAN`` buckets or one row per ``SPAN`` buckets."""
    spans = counts.withColumn("span", F.floor(F.col("bucket") / SPAN))
    inside = W.partitionBy("span").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    totals = spans.groupBy("span").agg(F.sum("n").alias("span_n"))
    totals = totals.select("span", F.coalesce(F.sum("span_n").over(before), F.lit(0)).alias("base"))
    spans = spans.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return spans.join(totals, "span").select("bucket", (F.col("base") + F.col("within")).alias("start"))


def shuffle_into_shards(
    spark: SparkSession,
    path: str,
    out: str,
    shards: int = 24,
    size: Column | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> DataFrame:
    """Shuffle the Parquet table at ``path`` into ``out/shard=0 ... shard=<shards - 1>``.

    Returns the written table: every column of the input in ``record``, and ``shard``
    and ``slot`` (gapless from 0 in each shard). A task holds a few buckets of about
    ``bucket_bytes`` (a record larger than that is a bucket's minimum). Nulls, empty
    and repeated rows are records like any other; an empty table gives an empty
    result; columns may have any name. The same files, seed and bucket size give the
    same result.
    """
    source = spark.read.parquet(path)
    size = F.lit(1) if size is None else size
    total = source.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    n_rows, buckets = total["n"], max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    place = F.xxhash64(F.lit(seed), F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    bucket = F.pmod(place, F.lit(buckets)).alias("bucket")

    counts = source.select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    scattered = source.select(
        bucket, F.struct(place.alias("place"), F.struct(*_every(source)).alias("record")).alias("entry")
    ).repartition(buckets, "bucket")
    # The starts join the scattered rows where they are: no second move of the texts.
    placed = scattered.join(prefix_starts(counts).hint("shuffle_hash"), "bucket")
    gathered = (
        placed.groupBy("bucket", "start")
        .agg(F.collect_list("entry").alias("entries"))
        # One order of buckets and entries, whatever order the shuffle delivered.
        .sortWithinPartitions("bucket")
        .select("start", F.array_sort("entries", _by_place).alias("entries"))
    )
    shuffled = gathered.select("start", F.posexplode(F.shuffle("entries", seed)).alias("pos", "entry"))
    # Shard s begins at position ceil(s * rows / shards); whole numbers throughout.
    rows = (
        shuffled.select(F.col("entry.record").alias("record"), (F.col("start") + F.col("pos")).alias("position"))
        .withColumn("shard", F.expr(f"cast((position * {shards}) div {max(1, n_rows)} as int)"))
        .withColumn("slot", F.expr(f"position - (shard * {n_rows}L + {shards - 1}) div {shards}"))
        .drop("position")
    )
    rows.write.partitionBy("shard").parquet(out)
    return spark.read.schema(rows.schema).parquet(out)


def _every(df: DataFrame) -> list[Column]:
    return [df[f"`{name}`"] for name in df.columns]


def _by_place(left: Column, right: Column) -> Column:
    return F.when(left["place"] < right["place"], -1).when(left["place"] > right["place"], 1).otherwise(0)


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot, read back from the written shards."""
    out = scratch_dir(spark, "shards")
    rows = shuffle_into_shards(spark, f"{sf_dir}/documents.parquet", out, 24, document_size())
    text = text_or_empty("record.text")
    return rows.select(
        F.col("record.doc_id").alias("doc_id"),
        document_size("record.text").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
