"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job of the library relies on. ANSI mode stays on:
# bad input becomes NULL through try_* expressions, not through a global switch.
SETTINGS = {
    # date(timestamp) depends on the zone, so it is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key is split at run time, even where the split costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Writing partitioned by a handful of reasons needs no sort of the data.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # About half of snappy's bytes where rows still lie in their order.
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffled bytes of a task: several sorts and hash tables of one task hold a multiple of them. Many small
    # tasks even out as well: with one task more than there are cores, a stage would take twice as long.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}
# What keeps joins of wide rows with narrow ones from sorting both: the narrow side's part, shuffled,
# is hashed if it is no larger. Skewed parts are split as in a sorted join.
HASHED = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Large joins of the block hash the smaller side where its parts are small (``HASHED``)."""
    former = {name: spark.conf.get(name) for name in HASHED}
    for name, value in HASHED.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in former.items():
            spark.conf.set(name, value)


def build_session(
    app: str = "lakemart", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Root for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    existing = context._jsc.sc().getCheckpointDir()
    if existing.isDefined():
        return existing.get().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="lakemart-")
    context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Reliable checkpoint of ``df`` in the shared folder."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
