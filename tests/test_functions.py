from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart import functions as fn


@pytest.mark.parametrize(
    "text, kind, expected",
    [
        ("3.0", "int", 3),
        ("3", "int", 3),
        (" 42 ", "int", 42),
        ("-7.9", "int", -7),
        ("1e3", "int", None),
        ("abc", "int", None),
        ("", "int", None),
        (None, "int", None),
        ("9223372036854775807.0", "bigint", 9223372036854775807),
        ("99999999999", "int", None),
        ("1.5", "double", 1.5),
        ("x", "double", None),
        ("true", "boolean", True),
        ("maybe", "boolean", None),
    ],
)
def test_safe_cast(frame, text, kind, expected):
    df = frame("t string", (text,))
    assert df.select(fn.safe_cast("t", kind)).first()[0] == expected


def test_safe_cast_dates(frame):
    df = frame("t string", ("2026-10-01",), ("2026-13-01",), ("soon",))
    got = [str(r[0]) for r in df.select(fn.safe_cast("t", "date")).collect()]
    assert got == ["2026-10-01", "None", "None"]


def test_nan_text_is_a_double(frame):
    got = frame("t string", ("NaN",)).select(fn.safe_cast("t", "double")).first()[0]
    assert math.isnan(got)


def test_clean_id(frame):
    df = frame("id string", (" A1 ",), ("",), ("   ",), (None,), ("\tB",))
    # Only blanks are trimmed; a tab is part of the value.
    assert [r[0] for r in df.select(fn.clean_id("id")).collect()] == ["A1", None, None, None, "\tB"]


def test_columns_with_awkward_names(frame):
    df = frame("`a.b c` string", (" x ",))
    assert df.select(fn.clean_id("a.b c")).first()[0] == "x"


def test_ratios(frame):
    df = frame("a double, b double", (10.0, 4.0), (1.0, 0.0), (1.0, None), (1.0, -2.0))
    got = df.select(fn.ratio("a", "b"), fn.guarded_ratio("a", "b")).collect()
    assert [tuple(r) for r in got] == [(2.5, 2.5), (None, 0.0), (None, 0.0), (-0.5, 0.0)]


def test_pct(frame):
    df = frame("a bigint, b bigint", (2, 3), (0, 0))
    assert [r[0] for r in df.select(fn.pct("a", "b")).collect()] == [66.67, None]


def test_full_name_skips_missing(frame):
    df = frame("f string, l string", ("Ann", "Lee"), (None, "Lee"), (None, None))
    assert [r[0] for r in df.select(fn.full_name("f", "l")).collect()] == ["Ann Lee", "Lee", ""]


def test_restate_cancelled(frame):
    df = frame("r double, s string", (5.0, "cancelled"), (5.0, None), (5.0, " CANCELLED"))
    got = [r[0] for r in df.select(fn.restate_cancelled("r", "s")).collect()]
    assert got == [0.0, 5.0, 5.0]


def test_clamp_and_floor(frame):
    nan = float("nan")
    df = frame(
        "v double, h double", (5.0, 3.0), (-1.0, 3.0), (2.0, 3.0), (None, 3.0), (2.0, None), (nan, 1.0)
    )
    got = [r[0] for r in df.select(fn.clamp("v", 0.0, "h")).collect()]
    assert got == [3.0, 0.0, 2.0, None, None, None]
    floored = [r[0] for r in df.select(fn.floor_at("v", 0.01)).collect()]
    assert floored == [5.0, 0.01, 2.0, None, 2.0, None]


def test_time_repair(frame):
    df = frame(
        "s string, a string",
        ("2026-01-02", "2026-01-01"),
        ("2026-01-02", "2026-01-03"),
        ("2026-01-02", None),
    ).select(F.to_timestamp("s").alias("s"), F.to_timestamp("a").alias("a"))
    fixed = df.withColumn("a", fn.ordered_actual("s", "a")).withColumn("ok", fn.on_time("s", "a"))
    assert [(str(r.a)[:10], r.ok) for r in fixed.collect()] == [
        ("2026-01-02", True),
        ("2026-01-03", False),
        ("None", False),
    ]


def test_measures_add_up_in_any_order(spark):
    random.seed(1)
    cents = [random.randint(-10**9, 10**12) for _ in range(5000)]
    values = [c / 100 for c in cents]
    expected = float(sum(Decimal(c) for c in cents) / 100)
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in order], "x double").repartition(7)
        assert df.agg(fn.total(df, "x", 2)).first()[0] == expected


def test_noise_of_arithmetic_is_no_decimal(frame):
    df = frame("x double", (0.1 + 0.2,), (5000.01 - 5000,), (4734.02 - 5000,))
    assert df.agg(fn.total(df, "x", 6)).first()[0] == -265.67


def test_sums_of_extremes(spark):
    tiny = spark.range(1_000_000).select(F.lit(4e-7).alias("x"))
    assert tiny.agg(F.round(fn.total(tiny, "x"), 9)).first()[0] == 0.4
    huge = spark.range(20_000).select(F.lit(9e14).alias("x"))
    assert huge.agg(fn.total(huge, "x", 2)).first()[0] == 1.8e19
    assert huge.agg(fn.total(huge, "x")).first()[0] == pytest.approx(1.8e19)


@pytest.mark.parametrize("bad", [0.125, 4e-7, 0.010001, float("nan"), float("inf"), 1e300])
def test_a_measure_with_more_decimals_is_refused(frame, bad):
    df = frame("x double", (1.5,), (bad,), (None,))
    with pytest.raises(Exception, match="no measure of 2 decimals"):
        df.agg(fn.total(df, "x", 2)).collect()


def test_total_and_mean_by_type(frame):
    df = frame("i int, d double, f boolean", (1, 0.1, True), (2, 0.2, None), (None, None, False))
    got = df.agg(
        fn.total(df, "i"),
        fn.mean(df, "i"),
        fn.total(df, "d", 2),
        fn.mean(df, "d", 2),
        fn.count_true("f"),
    ).first()
    assert tuple(got) == (3, 1.5, 0.3, 0.15, 1)
