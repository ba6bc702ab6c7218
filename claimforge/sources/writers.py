"""Writers of the stored layers."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.functions.privacy import packed, unpacked
from claimforge.operators.merge import merge_by_key, newer_rows
from claimforge.operators.quality import require_unique
from claimforge.schemas import CONFORMED_PARTITION, MART_PARTITION, REJECTED, STAGED, STAGING_PARTITION
from claimforge.session import releasing
from claimforge.sources import files, key_index, versions
from claimforge.sources.files import PACKED


DIGESTS = ("member_id",)
# Fewer rows than this make a small file, some 15 MB of claims.
FILE_ROWS = 1 << 18


def compacted(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one partition value together, as few files as their bytes need.

    The rebalance hint lets AQE merge small outputs and split a large partition
    value over many tasks, where ``repartition`` would send it to one. Digests are
    moved as bytes.
    """
    return as_bytes(lambda rows: rows.hint("rebalance", *columns), [df], columns)


def as_bytes(move: Callable[..., DataFrame], frames: Sequence[DataFrame], columns: Sequence[str] = ()) -> DataFrame:
    """What ``move`` makes of frames of one schema; their digests, but for ``columns``, are bytes meanwhile."""
    kinds = {field.name: field.dataType for field in frames[0].schema.fields}
    digests = [name for name in DIGESTS if isinstance(kinds.get(name), T.StringType) and name not in columns]
    moved = move(*[df.withColumns({name: packed(name) for name in digests}) for df in frames])
    return moved.withColumns({name: unpacked(name) for name in digests})


@releasing
def write_staging(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = tuple(STAGING_PARTITION),
    compact: bool = False,
) -> None:
    """Replace one run's folder.

    By default the scan tasks write directly, without a shuffle; claim types are
    few, so each task opens few files. ``compact`` spends a shuffle on larger files.
    """
    out = compacted(df, *partition_by) if compact else df
    out.write.options(**PACKED).mode("overwrite").partitionBy(*partition_by).parquet(path)


@releasing
def write_routed(df: DataFrame, staging: str, quarantine: str) -> None:
    """Write valid and rejected rows in one pass, then put each kind where it belongs.

    A run that is repeated replaces both folders; one without rejected rows leaves an
    empty quarantine.
    """
    spark = df.sparkSession
    pending = f"{staging.rstrip('/')}__pending"
    df.write.options(**PACKED).mode("overwrite").partitionBy("route", *STAGING_PARTITION).parquet(pending)
    for route, target in ((STAGED, staging), (REJECTED, quarantine)):
        files.ensure(spark, f"{pending}/route={route}")
        files.move_into(spark, f"{pending}/route={route}", target)
    files.remove(spark, pending)
    spark.catalog.refreshByPath(staging)
    spark.catalog.refreshByPath(quarantine)


def write_staging_by_month(df: DataFrame, path: str) -> None:
    """The documented staging layout: one folder per service month."""
    month = F.date_format("service_date", "yyyy-MM")
    write_staging(df.withColumn("service_month", month), path, ["service_month"], compact=True)


@releasing
def load_slice(
    df: DataFrame,
    path: str,
    column: str,
    value: str,
    figures: Mapping[str, Column] | None = None,
    key: str | None = None,
    indexed: Column | None = None,
) -> dict:
    """Replace one partition of ``path`` by ``df``, also when ``df`` is empty; a re-run adds nothing.

    ``df`` holds the rows of that partition; the column itself lives in the folder name.
    Readers see the old rows until the new ones are complete. ``figures`` are aggregates
    of the stored rows, which the table's record keeps; they are returned. ``key`` adds
    the keys of the slice's rows that are ``indexed`` (all by default) to the key index.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    record = versions.current(spark, path)
    folder = f"{column}={value}"
    rows = df.drop(column)
    target = f"{path}/version={record.number + 1}/{folder}"
    # A slice that gives each scan task a file of good size is written where it is read.
    laid_out = rows if rows.count() >= FILE_ROWS * rows.rdd.getNumPartitions() else compacted(rows)
    laid_out.write.options(**PACKED).mode("overwrite").parquet(target)
    stored = spark.read.schema(rows.schema).parquet(target)
    found = {}
    if figures:
        found = stored.agg(*[total.alias(name) for name, total in figures.items()]).first().asDict()
    after = record.with_parts({folder: found})
    if key:
        if not record.buckets:
            after = replace(after, buckets=key_index.buckets_for(stored.count()))
        chosen = F.col(key).isNotNull() if indexed is None else F.col(key).isNotNull() & indexed
        entries = stored.where(chosen).select(F.col(key).alias("key"), F.lit(folder).alias("folder")).distinct()
        after = key_index.appended(entries, path, after, after.number, key_index.current_only)
    versions.publish(spark, path, after)
    return found


@releasing
def load_slices(
    df: DataFrame, path: str, partition_by: Sequence[str], figures: Mapping[str, Column] | None = None
) -> None:
    """Replace all partitions that ``df`` has rows of, in one switch."""
    spark = df.sparkSession
    record = versions.current(spark, path)
    written = versions.write(compacted(df, *partition_by), path, record, partition_by)
    _publish_written(spark, path, df.schema, record, written, (), partition_by, figures or {})


def _publish_written(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    record: versions.Record,
    written: Sequence[str],
    gone: Collection[str],
    partition_by: Sequence[str],
    figures: Mapping[str, Column],
    **changes,
) -> None:
    """Publish the record after ``record``: partitions just written, others gone."""
    found = {}
    if figures and written:
        stored = versions.read(spark, path, schema, record.with_parts(dict.fromkeys(written)), written)
        found = versions.measured(stored, partition_by, figures)
    after = record.with_parts({name: found.get(name) for name in written}, gone)
    versions.publish(spark, path, replace(after, **changes))


def _seen(record: versions.Record, source: tuple[str, int] | None) -> dict[str, int]:
    return {**record.seen, **({source[0].rstrip("/"): source[1]} if source else {})}


def load_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a warehouse table over JDBC, where a driver is on the class path."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()


def write_mart(
    df: DataFrame, path: str, source: tuple[str, int] | None = None, more: Sequence[DataFrame] = ()
) -> None:
    """Full rebuild, one folder per month, clustered by plan.

    ``source`` is the table (and its record's number) that ``df`` was made from; ``more``
    frames hold other months and are written after it, one at a time.
    """
    write_months(_mart_rows(df), path, None, source, [_mart_rows(rows) for rows in more])


def write_mart_months(
    df: DataFrame,
    path: str,
    months: Sequence[str],
    source: tuple[str, int] | None = None,
    more: Sequence[DataFrame] = (),
) -> None:
    """Replace the month folders named in ``months`` by ``df`` and ``more``, which hold no other month."""
    write_months(_mart_rows(df), path, months, source, [_mart_rows(rows) for rows in more])


@releasing
def write_months(
    df: DataFrame,
    path: str,
    months: Sequence[str] | None,
    source: tuple[str, int] | None = None,
    more: Sequence[DataFrame] = (),
) -> None:
    """Replace some month folders, or all, by ``df`` and ``more``, in one switch; months without rows go."""
    record = versions.current(df.sparkSession, path)
    written = versions.write(df, path, record, MART_PARTITION, more)
    gone = list(record.parts) if months is None else months
    _publish_written(
        df.sparkSession, path, df.schema, record, written, gone, MART_PARTITION, {}, seen=_seen(record, source)
    )


def _mart_rows(df: DataFrame) -> DataFrame:
    return compacted(df, *MART_PARTITION).sortWithinPartitions(*MART_PARTITION, "plan_id")


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
) -> None:
    """Expose a stored layer to SQL users under a table name, with the folders it has now."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'"
    )
    versions.register(spark, name, path)


def analyze(spark: SparkSession, table: str, partition: dict[str, str] | None = None) -> None:
    """Row counts of one partition, or, over all of the table, of every column as well."""
    if partition:
        spec = ", ".join(f"{name} = '{value}'" for name, value in partition.items())
        spark.sql(f"ANALYZE TABLE {table} PARTITION ({spec}) COMPUTE STATISTICS")
    else:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def merge_into_table(source: DataFrame, table: str, key: str = "claim_id") -> None:
    """Key upsert in a table format with its own MERGE."""
    matched = F.expr(f"{table}.{key} = source.{key}")
    (
        source.alias("source")
        .mergeInto(table, matched)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def _require_unique_or_remove(spark: SparkSession, batch: DataFrame, key: str, path: str) -> None:
    """Refuse a stored batch that repeats a key, and leave neither it nor an empty folder around it."""
    try:
        require_unique(batch, key, "upsert source")
    except ValueError:
        files.remove(spark, path)
        around = path.rpartition("/")[0]
        if not path.endswith("__pending") and not files.names(spark, around):
            files.remove(spark, around)
        raise


@releasing
def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    schema: T.StructType,
    key: str = "claim_id",
    partition_by: Sequence[str] = tuple(CONFORMED_PARTITION),
    cluster_by: str = "run_date",
    only_if_newer: str | None = None,
    figures: Mapping[str, Column] | None = None,
    change_columns: Sequence[str] = (),
    passes: int = 1,
) -> list[str]:
    """Key upsert into a Parquet table partitioned by calendar columns; returns the touched folders.

    The key index names the partitions that hold the batch's keys, so nothing of the
    table is read but those partitions and the ones the batch goes to. They are written
    in full beside the old ones, and one switch publishes them together with the index
    (see ``versions``): losing an executor or the driver at any time leaves the table as
    it was or as it will be. The source is cast to ``schema`` and must be unique on
    ``key``, also on the first write; a refused source leaves nothing behind.

    ``figures`` are aggregates that the record keeps of each partition.
    ``change_columns`` stores these columns of the rows taken away and added, for tables
    that are kept up to date by differences.

    ``passes`` computes the source in as many parts, by a hash of the key, and stores it
    before it is laid out; a stored source is laid out some partitions at a time, by its
    rows (``versions.dealt``). The shuffle files of a part go when it is written, so the
    disk holds those of one part.
    """
    path = path.rstrip("/")
    work = f"{path}__pending"
    record = versions.current(spark, path)
    if not record.number and any(not name.startswith(("version=", "_")) for name in files.names(spark, path)):
        raise ValueError(f"{path} holds files that no upsert wrote")
    typed = source.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    folder = versions.folder_of(partition_by)
    keys = F.col(key).alias("key")

    def lay_out(rows: DataFrame, *more: DataFrame) -> list[str]:
        # Row groups clustered by run let the load step skip most of a partition.
        clustered = [compacted(part, *partition_by).sortWithinPartitions(*partition_by, cluster_by, key) for part in (rows, *more)]
        return versions.write(clustered[0], path, record, partition_by, clustered[1:])

    def store_source() -> DataFrame:
        for number in range(passes):
            part = typed if passes == 1 else typed.where(F.pmod(F.xxhash64(key), F.lit(passes)) == number)
            part.write.options(**PACKED).mode("append" if number else "overwrite").parquet(f"{work}/source")
        return spark.read.schema(schema).parquet(f"{work}/source")

    def of(group: Collection[str]) -> Column:
        return folder.isin(*group)

    if not record.number:
        if passes == 1:
            # Nothing to merge with: the batch is stored where it stays, and its keys are read there.
            written = touched = lay_out(typed)
        else:
            source = store_source()
            _require_unique_or_remove(spark, source, key, work)
            # One short text per partition of the batch.
            touched = [row.folder for row in source.select(folder.alias("folder")).distinct().collect()]
            written = lay_out(*[source.where(of(group)) for group in versions.dealt(touched, source.count())])
        source = versions.read(spark, path, schema, record.with_parts(dict.fromkeys(written)), written)
        if passes == 1:
            _require_unique_or_remove(spark, source, key, f"{path}/version=1")
        record = replace(record, buckets=key_index.buckets_for(source.count()))
        moved = source.select(keys, folder.alias("folder"))
    else:
        # The batch is needed for its keys, its partitions and its rows: compute it once.
        source = store_source()
        _require_unique_or_remove(spark, source, key, work)
        entry = T.StructType([T.StructField("key", schema[key].dataType), T.StructField("folder", T.StringType())])
        # Written, as it is read three times; no larger than the batch.
        key_index.located(source.select(keys), path, record).write.options(**PACKED).mode("overwrite").parquet(f"{work}/held")
        held = spark.read.schema(entry).parquet(f"{work}/held")

        def names(sent: DataFrame) -> set[str]:
            """The folders that rows go to or come from; one short text per month of data."""
            own = held.join(sent.select("key"), "key", "left_semi").select("folder")
            return {row.folder for row in sent.select("folder").unionByName(own).distinct().collect()}

        sent = folder.alias("folder")
        touched = names(source.select(keys, sent))
        if only_if_newer:
            target = versions.read(spark, path, schema, record, touched)
            newer_rows(target, source, key, only_if_newer).write.options(**PACKED).mode("overwrite").parquet(f"{work}/newer")
            # The whole source is not read again.
            files.remove(spark, f"{work}/source")
            source = spark.read.schema(schema).parquet(f"{work}/newer")
            touched = names(source.select(keys, sent))
        target = versions.read(spark, path, schema, record, touched)
        groups = versions.dealt(touched, source.count() + target.count())

        def merged(group: Sequence[str]) -> DataFrame:
            if len(groups) == 1:
                return as_bytes(lambda old, new: merge_by_key(old, new, key), [target, source], [key])
            # Of the batch's keys those that are in these partitions now; their rows may go to others.
            gone = held.where(F.col("folder").isin(*group)).select(F.col("key").alias(key))
            gone = gone.join(source.select(key), key, "left_semi")
            parts = [versions.read(spark, path, schema, record, group), source.where(of(group))]
            return as_bytes(lambda old, new: merge_by_key(old, new, key, gone=gone), parts, [key])

        written = lay_out(*[merged(group) for group in groups])
        moved = source.select(keys, sent).join(held.withColumnRenamed("folder", "before"), "key", "left")
        moved = moved.where(F.col("before").isNull() | (F.col("before") != F.col("folder"))).drop("before")
    indexed = key_index.appended(moved, path, record, record.number + 1)
    if change_columns:
        added = source.select(*change_columns, F.lit(1).alias("sign"))
        if record.number:
            old = versions.read(spark, path, schema, record, touched).join(source.select(key), key, "left_semi")
            added = added.unionByName(old.select(*change_columns, F.lit(-1).alias("sign")))
        added.write.options(**PACKED).mode("overwrite").parquet(f"{path}/{versions.CHANGES}/version={record.number + 1}")
    kept = versions.with_changes(replace(record, number=record.number + 1), bool(change_columns))
    _publish_written(
        spark, path, schema, record, written, touched, partition_by, figures or {},
        index=indexed.index, buckets=record.buckets, changes=kept.changes, changes_from=kept.changes_from,
    )
    files.remove(spark, work)
    return sorted(touched)
