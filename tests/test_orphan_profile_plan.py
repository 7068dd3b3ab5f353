"""The orphan profile is one aggregation over both sides."""

from __future__ import annotations

from lakemart.operators.integrity import orphan_profile


def test_neither_joined_nor_sorted(frame, rows):
    child = frame("k long", (1,), (2,), (2,), (None,), (5,))
    parent = frame("k string", ("1",), ("1",), ("05",), (None,))
    found = orphan_profile(child, "k", parent, "k", "r")
    assert rows(found) == [("r", 1, 4, "WARNING")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan
    assert rows(orphan_profile(child, "k", parent.limit(0), "k", "r")) == [("r", 3, 4, "WARNING")]
