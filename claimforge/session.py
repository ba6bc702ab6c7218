"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

# AQE does the runtime part of the scale story: it sizes shuffle partitions from
# real bytes, splits skewed join and rebalance partitions, and turns a shuffle
# join into a broadcast join only when the measured side is below the threshold. A
# skewed join is split even where the next join would reuse its placement.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName("claimforge")
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write or count go when it ends.

    Otherwise they stay until the driver collects garbage, so a job of many steps holds the
    shuffles of all of them on disk at once. For steps that run each frame once: one that is
    run again computes its shuffles again.
    """
    kept = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, kept)


def releasing(step: Callable) -> Callable:
    """``step``, whose first argument is a session or a frame, with ``shuffles_released`` around it.

    A frame that the step returns without running it keeps its shuffles until it is run, as always.
    """

    @wraps(step)
    def run(first: SparkSession | DataFrame, *args, **options):
        with shuffles_released(first.sparkSession if isinstance(first, DataFrame) else first):
            return step(first, *args, **options)

    return run


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one the cluster names.

    A local session may fall back to a temporary folder; on a cluster a folder
    that only one machine sees would lose data, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="claimforge-")
    return f"{base.rstrip('/')}/claimforge/{label}-{uuid.uuid4().hex}"
