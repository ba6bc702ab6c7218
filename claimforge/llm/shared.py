"""Small helpers that several corpus operators use."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.session import releasing, scratch_dir
from claimforge.sources import files

# Word separators of every contract: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@releasing
def stored(df: DataFrame, label: str, *more: DataFrame) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    It cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    ``more`` frames of the same columns are written after it, one at a time, so that the
    shuffle files of only one of them are on disk.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    for frame in (df, *more):
        frame.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote for frames that nothing reads again."""
    for frame in frames:
        for path in sorted({name.rpartition("/")[0] for name in frame.inputFiles()}):
            files.remove(frame.sparkSession, path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside send at most ``rows`` rows at a time to a Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas.

    A column that a lambda refers to may be inlined by the optimizer and then be
    computed per element; a lambda variable never is.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, GAP), lambda word: word != F.lit(""))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def class_weights(labels: DataFrame, label: str, keep: Column, per_class: int) -> tuple[float, float]:
    """How many labels that pass ``keep`` a row of ``labelled_sample`` stands for, for label 0 and 1.

    With these weights the classes have their shares of all labels, whether or not
    ``per_class`` binds; 1 where it does not.
    """
    usable = labels.where(keep & F.col("doc_id").isNotNull())
    counts = usable.agg(*[F.count_if(F.col(label) == value) for value in (0, 1)]).first()
    return max(1.0, counts[0] / per_class), max(1.0, counts[1] / per_class)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int
) -> DataFrame:
    """``doc_id, text, label`` of at most ``per_class`` rows of each label 0 and 1.

    The rows with the least hashes of their id among the labels that pass ``keep``; the
    chosen ids, at most twice ``per_class``, are broadcast to one scan of the texts. Of
    several rows of one id the least text counts.
    """
    usable = labels.where(keep & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("label"))
    place = F.xxhash64(F.lit(11), "doc_id")
    parts = [
        usable.where(F.col("label") == value).orderBy(place, "doc_id").limit(per_class) for value in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1]).dropDuplicates(["doc_id"])
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
