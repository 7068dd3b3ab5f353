"""Batches written by the Silver job: the same rows as classified ones, less moved for them."""

from __future__ import annotations

import pytest

from lakemart.functions.columns import safe_cast
from lakemart.operators.dedup import latest_state
from lakemart.operators.integrity import ForeignKey
from lakemart.operators.quarantine import rejected
from lakemart.operators.rules import Rule
from lakemart.plans import silver
from lakemart.plans.spec import Restatement, TableSpec
from lakemart.sinks import quarantine
from lakemart.sources.tables import read_silver


@pytest.mark.parametrize("few", [0, 500_000])
@pytest.mark.parametrize("dealt", [None, {"d": ("id", 3)}])
def test_a_written_batch_is_the_classified_one(spark, frame, tmp_path, rows, monkeypatch, few, dealt):
    """Rejects with their copies, the latest of the valid rows per key, and one unique key as it is."""
    monkeypatch.setattr(quarantine, "FEW", few)
    data = [
        ("a", "1.0", "p", "x"), ("a", "2.0", "p", "x"), ("a", "-3", "p", "x"), ("a", "-3", "p", "x"), ("b", "5", "q", None),
        ("c", "oops", "p", "y"), ("d", "7", "p", "y"), ("d", "7", "p", "y"), (" ", "1", "p", "z"), (None, "1", "p", "z"), ("e", "1", None, "z"),
    ]
    batch = frame("id string, v string, parent string, w string", *data)
    edge = ForeignKey("parent", "p", "k", "orphan")
    bad = Rule("bad", "v IS NULL OR v < 0")
    specs = {
        "p": TableSpec("p", "k"),
        "d": TableSpec("d", "id", {"v": "int"}, ("v",), (bad,), (edge,), (Restatement("v", ("v",), "v + 10"),)),
    }
    raw = {"p": frame("k string", ("p",)), "d": batch}
    lake = str(tmp_path / "lake")
    counts = silver.run_silver(spark, lake, raw, specs, dealt=dealt)
    classified = silver.classify_all(raw, specs)["d"]
    assert rows(read_silver(spark, lake, "d")) == rows(classified.where("quarantine_reason IS NULL").drop("quarantine_reason"))
    rejects = quarantine.read_quarantine(spark, f"{lake}/quarantine", ["d"])["d"].drop("quarantined_at_utc")
    assert rows(rejects) == rows(rejected(classified))
    assert {(r.outcome, r.row_count) for r in counts.where("table_name = 'd'").collect()} == {
        ("__accepted__", 2), ("orphan", 2), ("bad", 3), ("missing_primary_key", 2)
    }
    (run,) = (tmp_path / "lake" / "silver" / "_runs").iterdir()
    assert {p.name for p in run.iterdir()} == {"p", "d"}  # nothing else stays


def test_valid_rows_of_single_keys_are_not_aggregated(spark, frame, tmp_path, monkeypatch):
    """Neither a sort nor a shuffle of whole rows where no key repeats."""
    used = []
    monkeypatch.setattr(quarantine, "latest_state", lambda *a: used.append(a) or latest_state(*a))
    spec = {"d": TableSpec("d", "id")}
    silver.run_silver(spark, str(tmp_path / "a"), {"d": frame("id string", ("a",), ("b",), (None,), (None,))}, spec)
    assert not used
    monkeypatch.setattr(quarantine, "FEW", 0)
    silver.run_silver(spark, str(tmp_path / "b"), {"d": frame("id string, v int", ("a", 1), ("a", 2))}, spec)
    assert len(used) == 1


def test_text_with_a_point_is_cast_once(frame):
    """A cast that fails costs an exception, so exports of nullable integers are not cast as they stand."""
    texts = ["12.0", " 7.5 ", "3.", "x.1", "1e3", "1.5e3", "", None, "9", "99999999999.0", "-4.9", "\t5", "\t5.0", "."]
    df = frame("i int, t string", *enumerate(texts)).select("i", safe_cast("t", "int").alias("v"))
    assert [v for _, v in sorted(map(tuple, df.collect()))] == [12, 7, 3, None, None, None, None, None, 9, None, -4, 5, None, None]
    assert df._jdf.queryExecution().analyzed().toString().count("try_cast") == 1
