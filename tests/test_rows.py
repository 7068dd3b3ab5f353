from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators import dedup, integrity, joins, rules
from lakemart.operators.quality import GateFailed, require_pass
from lakemart.plans import logistics

SCHEMA = "k string, b double, a int, c string"
ROW = st.tuples(
    st.sampled_from(["x", "y", None]),
    st.sampled_from([None, -0.5, 1.0, float("nan"), float("inf")]),
    st.sampled_from([None, 1, 2]),
    st.sampled_from([None, "", "p", "q"]),
)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def same(left, right) -> bool:
    """Equal as text, because NaN never equals itself."""
    return list(map(repr, left)) == list(map(repr, right))


def by_window(df, key, order):
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


@FEW
@given(st.lists(ROW, min_size=1, max_size=30))
def test_latest_state_equals_the_window_form(spark, rows, data):
    df = spark.createDataFrame(data, SCHEMA)
    order = [F.desc_nulls_last(c) for c in ("b", "a", "c")]
    got = dedup.latest_state(df, "k", ["missing", "b"])
    assert same(rows(got), rows(by_window(df, "k", order)))


@FEW
@given(st.lists(ROW, min_size=1, max_size=30))
def test_first_row_equals_the_window_form(spark, rows, data):
    df = spark.createDataFrame(data, SCHEMA)
    order = [F.asc_nulls_last(c) for c in df.columns]
    assert same(rows(dedup.first_row(df, "k")), rows(by_window(df, "k", order)))


def test_first_row_fixture(frame, rows):
    df = frame("load_id string, revenue double", ("L1", 100.0), ("L1", 200.0), ("L2", 300.0))
    assert rows(dedup.first_row(df, "load_id")) == [("L1", 100.0), ("L2", 300.0)]


def test_dedup_of_key_only_frames(frame, rows):
    df = frame("k string", ("a",), ("a",), ("b",))
    assert rows(dedup.latest_state(df, "k")) == [("a",), ("b",)]
    assert rows(dedup.first_row(df, "k")) == [("a",), ("b",)]
    assert rows(dedup.any_row(df, "k")) == [("a",), ("b",)]


def test_keep_last_by_arrival(frame, rows):
    df = frame("k string, seq int, v string", ("a", 1, "z"), ("a", 2, "b"), ("b", 1, "c"))
    assert rows(dedup.keep_last(df, "k", "seq")) == [("a", 2, "b"), ("b", 1, "c")]


def test_invalid_loads_fixture(frame, rows):
    df = frame(
        "load_id string, weight_lbs double, revenue double",
        ("L1", 5000.0, 1500.0),
        ("L2", -10.0, 1500.0),
        ("L3", 5000.0, -50.0),
        ("L4", None, 1500.0),
        ("L5", 1.0, 0.0),
        ("L6", 1.0, float("nan")),
    )
    assert rows(rules.invalid_rows(df, logistics.INVALID_LOADS), "load_id") == [
        ("L2",), ("L3",), ("L4",)
    ]
    assert rows(rules.valid_rows(df, logistics.INVALID_LOADS), "load_id") == [
        ("L1",), ("L5",), ("L6",)
    ]


def test_rules_split_completely(frame):
    rule = rules.Rule("odd", "v > 1")  # unknown for NULL: then the row is valid
    df = frame("v int", (1,), (2,), (None,))
    assert rules.invalid_rows(df, rule).count() == 1
    assert rules.valid_rows(df, rule).count() == 2


def test_first_broken_rule_wins(frame):
    found = frame("v int", (3,), (2,), (0,)).select(
        rules.first_broken([rules.Rule("big", "v > 2"), rules.Rule("some", "v > 1")])
    )
    assert [r[0] for r in found.collect()] == ["big", "some", None]


@pytest.fixture
def family(frame):
    child = frame("id int, p string", (1, "a"), (2, "b"), (3, None), (4, "a"))
    parent = frame("pk string", ("a",), ("a",), (None,), ("c",))
    return child, parent


@pytest.mark.parametrize("unique", [True, False])
def test_orphans_and_valid(family, rows, unique):
    child, parent = family
    # Semi and anti joins need no unique parent for right results.
    assert rows(integrity.orphans(child, "p", parent, "pk", unique), "id") == [(2,), (3,)]
    assert rows(integrity.valid_fk(child, "p", parent, "pk", unique), "id") == [(1,), (4,)]


def test_fk_reason_takes_the_first_edge(frame, rows):
    child = frame("id int, a string, b string", (1, "a", "b"), (2, "x", "x"), (3, "a", None))
    parents = {"A": frame("a string", ("a",)), "B": frame("b string", ("b",), ("b",))}
    edges = [
        integrity.ForeignKey("a", "A", "a", "no_a"),
        integrity.ForeignKey("b", "B", "b", "no_b"),
    ]
    got = integrity.with_fk_reason(child, edges, parents, "why", unique=False)
    assert rows(got, "id", "why") == [(1, None), (2, "no_a"), (3, "no_b")]


def test_orphan_profile(family, frame, rows):
    child, parent = family
    assert rows(integrity.orphan_profile(child, "p", parent, "pk", "r")) == [("r", 1, 3, "WARNING")]
    with pytest.raises(GateFailed):
        found = integrity.orphan_profile(child, "p", parent, "pk", "r")
        require_pass(found, "foreign keys", bad=("WARNING", "FAIL"))
    assert rows(integrity.orphan_profile(child.limit(0), "p", parent, "pk", "r")) == [
        ("r", 0, 0, "PASS")
    ]


def test_fanout_equals_the_real_join(frame):
    parent = frame("k int, v double", (1, 10.0), (2, 20.0), (3, 5.0), (None, 7.0))
    child = frame("k int", (1,), (1,), (2,), (9,), (None,))
    naive = parent.join(child, "k", "left").agg(F.count("*"), F.sum("v")).first()
    got = joins.fanout_factor(parent, child, "k", "v").first()
    assert (got.joined_rows, got.joined_total) == tuple(naive)
    assert (got.parent_rows, got.true_total) == (4, 42.0)
