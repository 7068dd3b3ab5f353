"""The check for inexact measures: its verdicts, and that it stays inside code generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.operators.rules import inexact


def test_inexact_measures_need_no_lambda(frame):
    data = [(1, 0.25, None), (2, 1e-7, 1.0), (3, 2.0, float("inf")), (4, None, None), (5, 123456.789012, -3.5), (6, 3.5, 0.1234567)]
    df = frame("i int, a double, b double", *data).withColumn("bad", F.coalesce(F.expr(inexact(["a", "b"], 6)), F.lit(False)))
    assert sorted(r.i for r in df.where("bad").collect()) == [2, 3, 6]
    assert "lambda" not in df._jdf.queryExecution().executedPlan().toString()
