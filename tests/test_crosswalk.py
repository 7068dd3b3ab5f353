from __future__ import annotations

import pytest

from lakemart.operators.crosswalk import key_crosswalk, map_keys
from lakemart.operators.profiles import duplicate_profile, frequency_profile, row_count_check
from lakemart.operators.rules import violation_counts


def test_keys_are_dense_and_ordered(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 3000, 1, 8).selectExpr("(id * 7919) % 1000 AS k")
        found = key_crosswalk(df, "k", "RTE").orderBy("source_key").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [tuple(r) for r in found] == [(k, f"RTE{k + 1:08d}") for k in range(1000)]


def test_capacity(frame):
    df = frame("k string", ("b",), ("a",), ("a",), (None,))
    assert [tuple(r) for r in key_crosswalk(df, "k", "P", 2).collect()] == [
        ("a", "P00000001"), ("b", "P00000002")
    ]
    with pytest.raises(ValueError, match="2 keys"):
        key_crosswalk(df, "k", "P", 1)


def test_unmapped_keys_become_null(frame, rows):
    crosswalk = key_crosswalk(frame("k string", ("a",)), "k", "P")
    df = frame("id int, k string", (1, "a"), (2, "z"), (3, None))
    assert rows(map_keys(df, "k", crosswalk)) == [(1, "P00000001"), (2, None), (3, None)]


def test_profiles(frame, rows):
    df = frame("a string, b int", ("x", 1), ("x", 1), ("y", 1), (None, 1))
    assert rows(duplicate_profile({"t": df, "e": df.limit(0)})) == [("e", 0, 0), ("t", 4, 1)]
    assert rows(frequency_profile(df, "a")) == [("x", 2, 2 / 3), ("y", 1, 1 / 3)]
    assert rows(frequency_profile(df, "a", "b")) == [("x", 1, 2, 2 / 3), ("y", 1, 1, 1 / 3)]
    expected = frame("table_name string, expected_rows long", ("t", 4), ("e", 1))
    got = row_count_check({"t": df, "e": df.limit(0)}, expected)
    assert rows(got, "table_name", "status") == [("e", "FAIL"), ("t", "PASS")]


def test_violations(frame, rows):
    df = frame("v int", (0,), (-1,), (None,), (5,))
    assert rows(violation_counts(df, "t", {"low": "v <= 0", "gone": "v IS NULL"})) == [
        ("t", "gone", 1), ("t", "low", 2)
    ]
