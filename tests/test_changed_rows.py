"""Changed rows by digests of their values: nulls keep their places, zeros their signs."""

from __future__ import annotations

import datetime

from lakemart.plans.changes import changed_rows


def test_nulls_signs_and_nested_values_are_told_apart(frame, rows):
    kind = "k int, a string, b string, x double, d date, n struct<v:int,w:int>"
    day = datetime.date(2026, 1, 1)
    old = [(1, "p", None, 0.0, day, (1, None)), (2, "p", None, 1.0, None, (1, None)), (3, "p", "q", 2.0, day, None), (4, "", None, None, day, None)]
    new = [(1, None, "p", 0.0, day, (1, None)), (2, "p", None, 1.0, None, (None, 1)), (3, "p", "q", 2.0, day, None), (4, None, "", None, day, None)]
    assert rows(changed_rows(frame(kind, *old), frame(kind, *new), ["k"]).distinct()) == [(1,), (2,), (4,)]
    zeros = changed_rows(frame("k int, x double", (1, 0.0), (2, float("nan"))), frame("k int, x double", (1, -0.0), (2, float("nan"))), ["k"])
    assert rows(zeros.distinct()) == [(1,)]


def test_rows_are_not_written_out_as_text_to_compare_them(frame):
    """JSON and md5 of every row cost most of the comparison."""
    df = frame("k int, x double, s string", (1, 1.0, "a"))
    plan = changed_rows(df, df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "StructsToJson" not in plan and "md5" not in plan
