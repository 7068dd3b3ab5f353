"""Silver jobs hash the narrow side of large joins and write compact files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lakemart.plans.silver import run_silver
from lakemart.plans.spec import TableSpec
from lakemart.session import HASHED, configure, hashed_joins


def test_narrow_sides_are_hashed_inside_only(spark):
    former = {n: spark.conf.get(n) for n in HASHED}
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set(limits[0], "-1")
    spark.conf.set(limits[1], "-1")
    try:
        with hashed_joins(spark):
            joined = spark.range(5000).join(spark.range(100), "id", "left")
            assert len(joined.collect()) == 5000
            assert "ShuffledHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for n in limits:
            spark.conf.unset(n)
    assert {n: spark.conf.get(n) for n in HASHED} == former


def test_silver_files_are_compact(spark, tmp_path):
    configure(spark)
    raw = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    run_silver(spark, f"file://{tmp_path}/lake", {"t": raw}, {"t": TableSpec("t", "k")})
    files = [f for _, _, names in os.walk(tmp_path / "lake" / "silver") for f in names if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_shuffled_parts_of_a_task_are_bounded(spark):
    configure(spark)
    conf = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "16"}
    former = {n: spark.conf.get(n) for n in conf}
    for n, v in conf.items():
        spark.conf.set(n, v)
    try:
        sums = spark.range(0, 1_600_000, 1, 4).groupBy(F.xxhash64("id").alias("k")).agg(F.sum("id").alias("s"))
        assert sums.select(F.spark_partition_id()).distinct().count() >= 2  # about 30 MB
    finally:
        for n, v in former.items():
            spark.conf.set(n, v)
