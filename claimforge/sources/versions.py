"""Tables whose partitions are switched all at once.

A write puts whole partition folders below ``version=<n>``, where no reader looks yet.
Record n then names the versions that hold each partition's rows; the rename of this
small file is the only step that readers see. A write that is lost before leaves the
table as it was, and the next one overwrites its folders. A reader keeps the folders of
the record it began with: those of the last ``KEPT`` records are not removed.

A record also has figures of each partition (rows, greatest value of a column) and the
folders of the key index. A table that is built from another names in ``seen`` the record
it was built from, so the partitions to make up for are those of a greater version: what
a lost run left behind is found by the next. A record grows with the number of
partitions, not of rows. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.sources import files

RECORDS, INDEX, CHANGES = "_published", "_index", "_changes"
KEPT = 3
# Writes whose changed rows are kept for dependent tables.
CHANGES_KEPT = 30
# Rows that a pass over a part of the data is meant to move (some GB of shuffle files), and the
# most passes: the shuffle files of one pass are gone before the next one begins.
PASS_ROWS, MOST_PASSES = 40_000_000, 8


@dataclass(frozen=True)
class Record:
    """What a table consists of; number 0 is a table that was never written."""

    number: int = 0
    # Partition folder -> versions that hold its rows, and its figures.
    parts: Mapping[str, list[int]] = field(default_factory=dict)
    figures: Mapping[str, dict] = field(default_factory=dict)
    # Key bucket -> versions of the index that hold its entries, and how many buckets there are.
    index: Mapping[str, list[int]] = field(default_factory=dict)
    buckets: int = 0
    # Tables this one was built from -> number of their record then.
    seen: Mapping[str, int] = field(default_factory=dict)
    # Versions with stored changed rows; every write after record ``changes_from`` has them.
    changes: Sequence[int] = ()
    changes_from: int = 0

    def with_parts(self, written: Mapping[str, dict | None], gone: Collection[str] = ()) -> Record:
        """The next record: ``written`` partitions (with their figures) are new, ``gone`` ones are no more."""
        number = self.number + 1
        stay = [name for name in self.parts if name not in written and name not in gone]
        return replace(
            self,
            number=number,
            parts={name: self.parts[name] for name in stay} | {name: [number] for name in written},
            figures={name: self.figures[name] for name in stay if name in self.figures}
            | {name: figures for name, figures in written.items() if figures},
        )


def current(spark: SparkSession, path: str) -> Record:
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else Record()


def publish(spark: SparkSession, path: str, record: Record) -> None:
    """Make ``record`` the table; then remove what only records before the last ``KEPT`` name."""
    files.write_text(spark, _name(path, record.number), json.dumps(asdict(record)))
    spark.catalog.refreshByPath(path)
    numbers = _numbers(spark, path)
    kept = set().union(*[_folders(_load(spark, path, number)) for number in numbers[-KEPT:]])
    for number in numbers[:-KEPT]:
        for folder in sorted(_folders(_load(spark, path, number)) - kept):
            files.remove(spark, f"{path}/{folder}")
        files.remove(spark, _name(path, number))


def read(
    spark: SparkSession, path: str, schema: T.StructType, record: Record | None = None, names: Collection[str] | None = None
) -> DataFrame:
    """The rows of a record (the current one by default), or of those of its partitions in ``names``.

    A folder without records is read as plain Parquet.
    """
    path = path.rstrip("/")
    record = record or current(spark, path)
    if not record.number:
        return spark.read.schema(schema).parquet(path)
    parts = {name: held for name, held in record.parts.items() if names is None or name in names}
    folders = [f"{path}/version={n}/{name}" for name, held in sorted(parts.items()) for n in held]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def write(df: DataFrame, path: str, record: Record, partition_by: Sequence[str], more: Sequence[DataFrame] = ()) -> list[str]:
    """Put ``df`` where the record after ``record`` will find it; the partitions it has rows in.

    ``more`` frames, which go to other partitions, are written after it, one at a time.
    """
    target = f"{path.rstrip('/')}/version={record.number + 1}"
    for rows in (df, *more):
        mode = "overwrite" if rows is df else "append"
        rows.write.options(**files.PACKED).mode(mode).partitionBy(*partition_by).parquet(target)
    return files.partition_dirs(df.sparkSession, target, len(partition_by))


def passes_for(rows: int) -> int:
    return max(1, min(MOST_PASSES, -(-rows // PASS_ROWS)))


def dealt(names: Collection[str], rows: int) -> list[list[str]]:
    """Partitions in a group for each pass over ``rows`` rows, at least one; neighbours are in different groups."""
    passes = min(passes_for(rows), max(1, len(names)))
    return [sorted(names)[number::passes] for number in range(passes)]


def measured(written: DataFrame, partition_by: Sequence[str], figures: Mapping[str, Column]) -> dict[str, dict]:
    """Aggregates of each partition of stored rows, for its record; one row per partition."""
    if not figures:
        return {}
    found = written.groupBy(folder_of(partition_by).alias("folder"))
    found = found.agg(*[value.alias(name) for name, value in figures.items()]).collect()
    return {row.folder: {name: row[name] for name in figures} for row in found}


def ledger(spark: SparkSession, path: str, **figures: str) -> DataFrame:
    """``folder`` and the named figures (name to type) of every partition; reads the record only."""
    record = current(spark, path.rstrip("/"))
    rows = [
        (name, *[record.figures.get(name, {}).get(figure) for figure in figures]) for name in sorted(record.parts)
    ]
    kinds = ", ".join(f"{name} {kind}" for name, kind in figures.items())
    return spark.createDataFrame(rows, f"folder string, {kinds}")


def unseen(source: Record, dependent: Record, path: str) -> tuple[list[str], list[str]]:
    """Partitions of ``source`` (at ``path``) newer than what ``dependent`` saw, and those that are gone.

    Both tables have the same partitions.
    """
    seen = dependent.seen.get(path.rstrip("/"), 0)
    newer = [name for name, held in source.parts.items() if max(held) > seen]
    return sorted(newer), sorted(dependent.parts.keys() - source.parts.keys())


def with_changes(record: Record, stored: bool) -> Record:
    """A new record that has (or lacks) the rows its write changed."""
    if not stored:
        return replace(record, changes=[], changes_from=record.number)
    changes = [*record.changes, record.number]
    dropped = changes[:-CHANGES_KEPT]
    return replace(record, changes=changes[-CHANGES_KEPT:], changes_from=max([record.changes_from, *dropped]))


def changed_rows(spark: SparkSession, path: str, schema: T.StructType, record: Record, seen: int) -> DataFrame | None:
    """Rows that writes after record ``seen`` took away (``sign`` -1) and added (1), or None if not kept."""
    if seen < record.changes_from:
        return None
    schema = T.StructType([*schema.fields, T.StructField("sign", T.IntegerType())])
    paths = [f"{path.rstrip('/')}/{CHANGES}/version={n}" for n in record.changes if n > seen]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def register(spark: SparkSession, table: str, path: str) -> None:
    """Point the catalog's partitions at the current folders, one switch per partition that changed."""
    record = current(spark, path)
    known = {
        row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    }.get("published", "0")
    before = _load(spark, path, int(known)).parts if int(known) in _numbers(spark, path) else {}
    for name in sorted(before.keys() - record.parts.keys()):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(name)})")
    for name, held in sorted(record.parts.items()):
        if before.get(name) != held:
            at = f"{path}/version={held[-1]}/{name}"
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(name)}) LOCATION '{at}'")
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(name)}) SET LOCATION '{at}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('published' = '{record.number}')")
    spark.catalog.refreshTable(table)


def folder_of(partition_by: Sequence[str]) -> Column:
    """A row's partition folder, for integer and date partition columns."""
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
        for name in partition_by
    ]
    return F.concat_ws("/", *parts)


def _spec(folder: str) -> str:
    pairs = [part.split("=", 1) for part in folder.split("/")]
    return ", ".join(f"{n} = null" if v == "__HIVE_DEFAULT_PARTITION__" else f"{n} = '{v}'" for n, v in pairs)


def _name(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{RECORDS}/{number:012d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.names(spark, f"{path.rstrip('/')}/{RECORDS}")
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _load(spark: SparkSession, path: str, number: int) -> Record:
    return Record(**json.loads(files.read_text(spark, _name(path, number))))


def _folders(record: Record) -> set[str]:
    data = {f"version={n}/{name}" for name, held in record.parts.items() for n in held}
    data |= {f"{CHANGES}/version={n}" for n in record.changes}
    return data | {f"{INDEX}/version={n}/{name}" for name, held in record.index.items() for n in held}
