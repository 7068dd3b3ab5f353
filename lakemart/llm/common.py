"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a ``written`` table that nothing reads any more."""
    files = df.inputFiles()
    if files:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a table in the shared folder, dealt by ``key``: joins on it shuffle the other side only."""
    spark = df.sparkSession
    path = work_path(spark, "bucketed")
    name = path.rpartition("/")[2].replace("-", "_")
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(number, key).format("parquet").option("path", path).saveAsTable(name)
    found = spark.table(name)
    found.bucketed_as = name
    return found


def drop_bucketed(df: DataFrame) -> None:
    """Deletes a table made by ``bucketed`` that nothing reads any more."""
    discard(df)
    df.sparkSession.sql(f"DROP TABLE {df.bucketed_as}")


def unit(*columns: Column | str) -> Column:
    """A deterministic uniform number in [0, 1) from the given values."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) * F.lit(2.0**-53)


def tag(column: Column | str) -> Column:
    """A nullable string as a non-null group key; null differs from every string."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("="), column), F.lit(""))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this library's source to the executors, once per application, bounds batches and disk."""
    # Texts can be long and a worker holds several copies of a batch.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    # Operators write their steps, so what a step has shuffled goes with its end, not with the driver's next GC.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in [package / "__init__.py", package / "session.py", *sorted(Path(__file__).parent.glob("*.py"))]:
            archive.write(file, file.relative_to(package.parent))
    path = context._jvm.org.apache.hadoop.fs.Path(work_path(spark, "source") + ".zip")
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(data.getvalue()))
    stream.close()
    context.addPyFile(path.toString())
    _SHIPPED.add(context.applicationId)


def udf(function, returns: str):
    """A pandas UDF whose code the executors have."""
    ship(SparkSession.active())
    return F.pandas_udf(function, returns)


_KEPT: list = [None, None]  # an operator and what it remembers, in this Python worker


def kept(owner: str, make: Callable = dict):
    """What ``owner`` remembers from task to task; what another operator remembered in this worker goes.

    Workers outlive a step, so without this the steps of a pipeline would hold all their memories at once.
    """
    if _KEPT[0] != owner:
        _KEPT[:] = None, None
        _KEPT[:] = owner, make()
    return _KEPT[1]


SMALL = 1_000_000  # numbers that a broadcast may hold, about 40 MB


def small_join(
    df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", weight: Column | None = None
) -> DataFrame:
    """Joins a written table: broadcast if what it holds is little, else a plain join.

    ``weight`` is the numbers in a row (default: 1); their sum over the table is checked.
    """
    held = small.agg(F.sum(F.lit(1) if weight is None else weight)).first()[0] or 0
    return df.join(F.broadcast(small) if held <= SMALL else small, keys, how)
