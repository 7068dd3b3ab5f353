"""Sources and sinks."""

from __future__ import annotations

import pytest

from lakemart.operators.quality import GateFailed
from lakemart.operators.quality import batch_gate, grain_check, quality_report, require_pass
from lakemart.plans.gold import reconcile
from lakemart.sinks import paths, tables
from lakemart.sinks.landing import land
from lakemart.sources import raw
from lakemart.sources.tables import read_catalog, read_path

AWKWARD = (
    'id,"name, full",note\n'
    'L1,"a ""quoted"" b",ends with \\\n'
    "  L2  , ,\n"
    ",,\n"
    "\n"
    'L3,"",back\\slash "x\n'
    "L4,é…,tab\there\n"
    'id,"name, full",note\n'
)


def test_landing_keeps_every_line(spark, tmp_path):
    source, target = tmp_path / "in.csv", tmp_path / "bronze" / "t"
    source.write_text(AWKWARD)
    landed = land(spark, str(source), str(target))
    assert (landed.rows, landed.blanks, landed.multi_line, landed.preserved) == (6, 1, False, True)
    (part,) = target.rglob("part-*")
    assert part.read_bytes() == source.read_bytes()
    before, after = raw.raw_csv(spark, str(source)), raw.raw_csv(spark, str(target))
    assert before.columns == after.columns
    assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0


def test_landing_in_many_parts_keeps_a_header_each(spark, tmp_path):
    source, target = tmp_path / "in.csv", tmp_path / "out"
    source.write_text("a,b\n" + "".join(f"{i},{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        assert land(spark, str(source), str(target)).rows == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list(target.rglob("part-*"))) > 3
    assert raw.raw_csv(spark, str(target)).count() == 5000


@pytest.mark.parametrize("bad", ["a,b\n1,2\x013\n", "a,b\n1,2\x003\n", "a\x01b\n1\n"])
def test_landing_keeps_control_characters(spark, tmp_path, bad):
    source, target = tmp_path / "in.csv", tmp_path / "out"
    source.write_text(bad)
    assert land(spark, str(source), str(target)).preserved
    (part,) = target.rglob("part-*")
    assert part.read_bytes() == source.read_bytes()
    source.write_text("")
    with pytest.raises(ValueError, match="no header"):
        land(spark, str(source), str(target))


def test_landing_a_folder(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.csv").write_text("a,b\n1,2\n")
    (source / "b.csv").write_text("a,b\n3,4\n")
    assert land(spark, str(source), str(target)).rows == 2
    assert raw.raw_csv(spark, str(target)).count() == 2
    (source / "b.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="header does not conform"):
        land(spark, str(source), str(target))
    assert raw.raw_csv(spark, str(target)).count() == 2


def test_files_with_other_headers_are_not_read_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        raw.raw_csv(spark, str(tmp_path)).collect()
    assert raw.raw_csv(spark, str(tmp_path), check_headers=False).count() == 2


def test_multi_line_and_bom(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿a,b\n1,"x\ny"\n')
    df = raw.raw_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert df.columns == ["a", "b"] and df.collect() == [("1", "x\ny")]


def test_table_names(frame):
    df = frame("p string", ("/in/Delivery Events.v2.csv",), ("loads.CSV",), ("x/ A--b .csv",))
    got = [r[0] for r in df.select(raw.table_name("p")).collect()]
    assert got == ["delivery_events_v2", "loads", "a_b"]


def test_list_and_check_tables(spark, tmp_path):
    (tmp_path / "Loads.csv").write_text("a\n1\n")
    (tmp_path / "extra.csv").write_text("a\n1\n")
    (tmp_path / "notes.txt").write_text("no table")
    (tmp_path / "Big Table").mkdir()
    for part in "ab":
        (tmp_path / "Big Table" / f"{part}.csv").write_text("a\n1\n2\n")
    files = raw.list_deliveries(spark, str(tmp_path) + "/")
    assert {(r.table_name, r.source_file, r.size_bytes) for r in files.collect()} == {
        ("loads", "Loads.csv", 4), ("extra", "extra.csv", 4), ("big_table", "Big Table", 12)
    }
    assert raw.check_tables(files, ["loads"]) == ["big_table", "extra", "loads"]
    with pytest.raises(ValueError, match="trips"):
        raw.check_tables(files, ["loads", "trips"])
    with pytest.raises(FileNotFoundError):
        raw.check_tables(files.limit(0), ["loads"])


def test_replace_may_read_its_target(spark, frame, tmp_path, rows):
    target = str(tmp_path / "t")
    tables.replace(frame("k int, v string", (1, "a")), target)
    current = read_path(spark, target)
    tables.replace(current.union(current), target)
    assert rows(read_path(spark, target)) == [(1, "a"), (1, "a")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert(spark, frame, tmp_path, rows):
    target = str(tmp_path / "t")
    tables.upsert(frame("k int, v string", (1, "a"), (2, "b")), target, "k")
    for _ in range(2):
        tables.upsert(frame("v string, k int", ("B", 2), ("c", 3)), target, "k")
        assert rows(read_path(spark, target), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]


@pytest.mark.parametrize("bad", [[(1, "x"), (1, "y")], [(None, "x")]])
def test_upsert_refuses_bad_keys(spark, tmp_path, rows, frame, bad):
    target = str(tmp_path / "t")
    tables.upsert(frame("k int, v string", (1, "a")), target, "k")
    with pytest.raises(GateFailed):
        tables.upsert(frame("k int, v string", *bad), target, "k")
    assert rows(read_path(spark, target)) == [(1, "a")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_interrupted_swap_is_recovered(spark, frame, tmp_path, rows):
    target = str(tmp_path / "t")
    tables.replace(frame("k int", (1,)), target)
    # The state after the first of the two renames.
    paths.rename(spark, target, str(tmp_path / "_previous_t"))
    tables.upsert(frame("k int", (2,)), target, "k")
    assert rows(read_path(spark, target)) == [(1,), (2,)]


def test_partition_overwrite(spark, frame, tmp_path, rows):
    target = str(tmp_path / "t")
    tables.overwrite_partitions(frame("d int, v int", (1, 1), (2, 2)), target, ["d"])
    tables.overwrite_partitions(frame("d int, v int", (2, 9)), target, ["d"])
    assert rows(read_path(spark, target), "d", "v") == [(1, 1), (2, 9)]


def test_upsert_by_partition(spark, frame, tmp_path, rows):
    target, schema = str(tmp_path / "t"), "k int, v string, d string"
    first = frame(schema, (1, "a", "x 1"), (2, "b", "x 1"), (3, "c", "y:+%"), (4, "d", "z"))
    assert len(tables.upsert_partitions(first, target, "k", "d")) == 3
    untouched = {p.name for p in (tmp_path / "t" / "d=x 1").iterdir()}
    # 3 moves to z and empties its partition; 5 opens a new one.
    batch = frame(schema, (3, "C", "z"), (5, "e", "w"))
    for _ in range(2):
        names = tables.upsert_partitions(batch, target, "k", "d")
        assert rows(read_path(spark, target), "k", "v", "d") == [
            (1, "a", "x 1"), (2, "b", "x 1"), (3, "C", "z"), (4, "d", "z"), (5, "e", "w")
        ]
    assert names == ["d=w", "d=z"]
    assert {p.name for p in (tmp_path / "t" / "d=x 1").iterdir()} == untouched
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == [
        "d=w", "d=x 1", "d=z"
    ]
    with pytest.raises(GateFailed):
        tables.upsert_partitions(batch.union(batch), target, "k", "d")


def test_interrupted_partition_swap(spark, frame, tmp_path, rows):
    target, schema = str(tmp_path / "t"), "k int, v string, d string"
    tables.upsert_partitions(frame(schema, (1, "a", "x"), (2, "b", "y"), (3, "c", None)), target, "k", "d")
    # The state between the two renames of a partition: readers see the others, the rerun all.
    paths.rename(spark, f"{target}/d=x", f"{paths.parked(target)}/d=x")
    assert rows(read_path(spark, target, spark.createDataFrame([], schema).schema), "k") == [(2,), (3,)]
    batch = frame(schema, (2, "B", "x"), (3, "C", None))
    assert tables.upsert_partitions(batch, target, "k", "d") == [
        "d=__HIVE_DEFAULT_PARTITION__", "d=x", "d=y"
    ]
    assert rows(read_path(spark, target), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_rewritten_partitions_are_pruned(spark, frame, tmp_path):
    target = str(tmp_path / "t")
    tables.upsert_partitions(frame("k int, d int", (1, 1), (2, 2), (3, 3)), target, "k", "d")
    plan = tables.within(read_path(spark, target), "d", [1, 3])
    assert len(plan.inputFiles()) == 3  # of the relation; the scan takes less
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [d" in text


def test_catalog_tables(spark, frame, rows):
    for v in (1, 2):
        tables.create_or_replace(frame("k int, v int", (1, v), (1, v - 1)), "lakemart_catalog_test")
        assert rows(read_catalog(spark, "lakemart_catalog_test", "k", ["v"])) == [(1, v)]
    spark.sql("DROP TABLE lakemart_catalog_test")


def test_missing_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_path(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        raw.raw_csv(spark, str(tmp_path / "none"))


def test_report_statuses(frame):
    good = frame("k int, v double", (1, 1.0), (2, 0.0))
    marts = {
        "good": (good, "k"),
        "negative": (frame("k int, v double, w int", (1, -1.0, -1)), "k"),
        "empty": (good.limit(0), "k"),
        "repeated": (good.union(good), "k"),
        "missing": (frame("k int, v double", (None, 1.0), (None, 1.0)), "k"),
    }
    report = {r.table_name: r for r in quality_report(marts).collect()}
    assert {n: r.validation_status for n, r in report.items()} == {
        "good": "PASS", "negative": "WARNING", "empty": "FAIL", "repeated": "FAIL", "missing": "FAIL"
    }
    assert report["negative"].negative_numeric_values == 2
    assert (report["missing"].null_primary_keys, report["missing"].duplicate_primary_keys) == (2, 1)
    assert report["repeated"].duplicate_primary_keys == 2
    grain = {r.table_name: r.status for r in grain_check(marts).collect()}
    assert grain == {
        "good": "PASS", "negative": "PASS", "empty": "FAIL", "repeated": "FAIL", "missing": "FAIL"
    }
    with pytest.raises(GateFailed, match="repeated"):
        require_pass(quality_report(marts), "report", "validation_status")


def test_control_totals(frame):
    loads = frame("revenue double", (10.0,), (0.25,))
    customers = frame("total_revenue double", (10.25,))
    assert reconcile(loads, loads, customers).first().status == "PASS"
    assert reconcile(loads, loads, frame("total_revenue double", (10.27,))).first().status == "FAIL"
    assert reconcile(loads, loads.union(loads), customers).first().status == "FAIL"
    empty = reconcile(loads.limit(0), loads.limit(0), customers.limit(0)).first()
    assert (empty.silver_total, empty.status) == (0.0, "PASS")


def test_batch_gate(frame):
    assert batch_gate(frame("r double", (1.0,)), "r").first().status == "PASS"
    assert batch_gate(frame("r double", (-1.0,)), "r").first().status == "FAIL"
    assert batch_gate(frame("r double", (1.0,)).limit(0), "r").first().status == "FAIL"
