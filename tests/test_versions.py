"""Versions of Silver, incremental Gold, and rejects that keep their identity."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakemart.operators.quality import GateFailed
from lakemart.operators.quarantine import classify, rejected
from lakemart.plans import gold, silver
from lakemart.plans.changes import BUCKET, changed_rows, only, touched_keys, with_bucket
from lakemart.plans.logistics import SPECS
from lakemart.plans.marts import MARTS
from lakemart.plans.spec import TableSpec
from lakemart.sinks.paths import write_new
from lakemart.sinks.quarantine import read_quarantine
from lakemart.sources import versions
from lakemart.sources.tables import read_gold, read_path, read_silver, read_version
from tests.test_medallion import CSV


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """The batches of the medallion test as raw frames."""
    folder = tmp_path_factory.mktemp("in")
    for name, text in CSV.items():
        (folder / f"{name}.csv").write_text(text)
    return {n: spark.read.option("header", True).csv(str(folder / f"{n}.csv")) for n in SPECS}


def marts(spark, lake):
    return {n: read_gold(spark, lake, n).drop("last_ingested_at") for n in MARTS}


def test_a_failed_run_changes_nothing(spark, delivered, tmp_path, rows):
    lake = str(tmp_path / "lake")
    silver.run_silver(spark, lake, delivered)
    before = {n: rows(read_silver(spark, lake, n)) for n in SPECS}
    rejects = {n: df.count() for n, df in read_quarantine(spark, f"{lake}/quarantine", SPECS).items()}
    bad = delivered["trips"].withColumn("trip_id", F.raise_error(F.lit("unreadable")).cast("string"))
    fewer = {**delivered, "loads": delivered["loads"].where("load_id = 'L6'"), "trips": bad}
    with pytest.raises(PySparkException, match="unreadable"):
        silver.run_silver(spark, lake, fewer)
    assert {n: rows(read_silver(spark, lake, n)) for n in SPECS} == before
    assert {n: df.count() for n, df in read_quarantine(spark, f"{lake}/quarantine", SPECS).items()} == rejects
    assert len(list((tmp_path / "lake" / "silver" / "_runs").iterdir())) == 1


def test_versions_stay_for_readers_and_go_later(spark, delivered, tmp_path, rows):
    lake, layer = str(tmp_path / "lake"), str(tmp_path / "lake" / "silver")
    dims = {n: SPECS[n] for n in ("customers", "routes")}
    silver.run_silver(spark, lake, delivered, dims)
    reader = read_silver(spark, lake, "routes")
    first = versions.current(spark, layer)
    # a run of some tables leaves the others
    silver.run_silver(spark, lake, delivered, {"customers": SPECS["customers"]})
    assert versions.current(spark, layer).tables["routes"] == first.tables["routes"]
    assert reader.count() == 1
    # a file that a crash cut off is passed over
    write_new(spark, f"{layer}/_published/{9:020d}.json", '{"run": "x", ')
    assert versions.current(spark, layer).number == 2
    with pytest.raises(Exception, match="exist"):
        write_new(spark, f"{layer}/_published/{9:020d}.json", "{}")
    for _ in range(3):
        silver.run_silver(spark, lake, delivered, dims)
    assert len(list((tmp_path / "lake" / "silver" / "_runs").iterdir())) == versions.KEPT
    assert rows(read_silver(spark, lake, "routes"), "route_id") == [("R1",)]


def test_gold_follows_changes(spark, delivered, tmp_path, rows):
    lake = str(tmp_path / "lake")

    def both(tables):
        silver.run_silver(spark, lake, tables)
        totals = gold.run_gold(spark, lake, "upsert", buckets=8).collect()
        built = gold.build_marts({n: read_silver(spark, lake, n) for n in SPECS})
        for name, df in marts(spark, lake).items():
            assert rows(df.select(*built[name].columns)) == rows(built[name]), name
        return totals

    def folders():
        return {
            (m, p.name): sorted(f.name for f in p.glob("*.parquet"))
            for m in MARTS
            for p in (tmp_path / "lake" / "gold" / m).iterdir()
            if p.is_dir()
        }

    both(delivered)
    first = folders()
    both(delivered)
    assert folders() == first  # nothing changed, nothing is rewritten
    # a load gets dearer and a customer is renamed
    loads = delivered["loads"].withColumn("revenue", F.when(F.col("load_id") == "L6", "999.5").otherwise(F.col("revenue")))
    customers = delivered["customers"].withColumn("customer_name", F.upper("customer_name"))
    assert both({**delivered, "loads": loads, "customers": customers})[0].status == "PASS"
    second = folders()
    rewritten = {m for m, p in second if second[m, p] != first.get((m, p))}
    assert rewritten == {
        "gold_load_performance", "gold_delivery_performance", "gold_customer_performance", "gold_route_performance"
    }
    # a trip moves to another load's route, events and facility change
    events = delivered["delivery_events"].withColumn("detention_minutes", F.lit("7"))
    facilities = delivered["facilities"].withColumn("city", F.lit("Elko"))
    trips = delivered["trips"].withColumn("fuel_gallons_used", F.lit("9"))
    both({**delivered, "delivery_events": events, "facilities": facilities, "trips": trips})
    with pytest.raises(ValueError, match="8 folders"):
        gold.run_gold(spark, lake, "upsert", buckets=4)
    gold.run_gold(spark, lake)  # a refresh ends the update by key
    assert not list((tmp_path / "lake" / "gold" / "gold_load_performance").glob(f"{BUCKET}=*"))


def test_a_refused_update_publishes_nothing(spark, delivered, tmp_path, rows, monkeypatch):
    lake = str(tmp_path / "lake")
    silver.run_silver(spark, lake, delivered)
    gold.run_gold(spark, lake, "upsert")
    before = {n: rows(df) for n, df in marts(spark, lake).items()}
    dearer = delivered["loads"].withColumn("revenue", F.lit("7"))
    silver.run_silver(spark, lake, {**delivered, "loads": dearer})

    def off(silver_rows, found, column, tolerance=0.01):
        return spark.createDataFrame([(1.0, "FAIL")], "silver_total double, status string")

    with monkeypatch.context() as m:
        m.setattr(gold, "control_totals", off)
        with pytest.raises(GateFailed):
            gold.run_gold(spark, lake, "upsert")
    assert {n: rows(df) for n, df in marts(spark, lake).items()} == before
    assert sorted(p.name for p in (tmp_path / "lake" / "gold").iterdir()) == sorted(["_published", *MARTS])
    # the version that Gold was built from is still there, so the next run catches up
    silver.run_silver(spark, lake, {**delivered, "loads": dearer})
    silver.run_silver(spark, lake, {**delivered, "loads": dearer})
    gold.run_gold(spark, lake, "upsert")
    mart = read_gold(spark, lake, "gold_load_performance")
    assert {r.revenue for r in mart.collect()} == {0.0, 7.0}


def test_rewriting_reads_the_touched_folders_only(spark, delivered, tmp_path):
    lake = str(tmp_path / "lake")
    silver.run_silver(spark, lake, delivered)
    gold.run_gold(spark, lake, "upsert", buckets=4)
    from lakemart.sinks.tables import within

    target = read_path(spark, f"{lake}/gold/gold_load_performance")
    plan = within(target, BUCKET, [1])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{BUCKET}" in plan or f"PartitionFilters: [isnotnull({BUCKET}" in plan


def test_changed_rows_and_keys(spark, frame, rows):
    old = frame("k int, p string, v double", (1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (None, "d", 4.0))
    new = frame("k int, p string, v double", (1, "a", 1.0), (2, "b", 2.0), (4, "e", 3.0), (None, "d", 4.0))
    assert rows(changed_rows(old, new, ["k", "p"]).distinct()) == [(2, "b"), (3, "c"), (4, "e")]
    tables = {
        "loads": frame("load_id string, route_id string", ("L1", "R1"), ("L2", "R2"), ("L3", "R3")),
        "trips": frame("trip_id string, load_id string", ("T1", "L1"), ("T2", "L2"), ("T3", None)),
        "delivery_events": frame("event_id string, actual_datetime timestamp"),
    }
    mart = MARTS["gold_route_performance"]
    changes = {"trips": frame("load_id string", ("L2",), (None,)), "routes": frame("route_id string", ("R9",))}
    keys = touched_keys(mart, changes, tables)
    assert rows(keys) == [("R2",), ("R9",)]
    cut = only(mart, keys, tables)
    assert rows(cut["loads"], "load_id") == [("L2",)] and rows(cut["trips"], "trip_id") == [("T2",)]
    assert touched_keys(mart, {"facilities": keys}, tables) is None
    assert 0 <= with_bucket(keys, "route_id", 3).agg(F.max(BUCKET)).first()[0] < 3


def test_rejects_do_not_depend_on_their_place(spark, frame, rows):
    """A task that runs again over rows in another order gives the same rejects."""
    data = [(None, 1, None), (None, 1, None), (None, 1, ""), (None, 2, None), ("a", 1, "x"), ("a", 1, "x"), ("", 1, "x")]
    spec = TableSpec("d", "id")
    df = frame("id string, v int, w string", *data * 3)
    found = [
        sorted(map(tuple, rejected(classify(df.repartition(n, *by), spec, {})).collect()), key=repr)
        for n, by in ((1, ()), (5, ()), (3, ("v",)))
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 15
    plan = classify(df, spec, {})._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan


def test_versions_read_as_they_were(spark, delivered, tmp_path, rows):
    lake = str(tmp_path / "lake")
    dims = {"customers": SPECS["customers"]}
    silver.run_silver(spark, lake, delivered, dims)
    old = versions.current(spark, f"{lake}/silver")
    silver.run_silver(spark, lake, {"customers": delivered["customers"].where("trim(customer_id) = 'C1'")}, dims)
    assert len(rows(read_version(spark, lake, old, "customers"))) == 2
    assert len(rows(read_silver(spark, lake, "customers"))) == 1


def test_inexact_measures_are_rejected(spark, delivered, tmp_path, rows):
    lake = str(tmp_path / "lake")
    fuel = F.when(F.col("trip_id") == "P6", "1.1234567").otherwise(F.col("fuel_gallons_used"))
    revenue = F.when(F.col("load_id") == "L6", "Infinity").otherwise(F.col("revenue"))
    changed = {
        **delivered,
        "trips": delivered["trips"].withColumn("fuel_gallons_used", fuel),
        "loads": delivered["loads"].withColumn("revenue", revenue),
    }
    outcomes = {(r.table_name, r.outcome): r.row_count for r in silver.run_silver(spark, lake, changed).collect()}
    assert outcomes["loads", "inexact_measure"] == 2 and outcomes["trips", "inexact_measure"] == 1
    assert gold.run_gold(spark, lake).first().status == "PASS"


def test_dealt_facts_are_joined_where_they_lie(spark, delivered, tmp_path, rows):
    lake = str(tmp_path / "lake")
    dealt = {"loads": ("load_id", 4), "trips": ("trip_id", 4), "delivery_events": ("load_id", 4)}
    others = {t.name for t in spark.catalog.listTables()}
    for _ in range(3):
        silver.run_silver(spark, lake, delivered, dealt=dealt)
    names = [
        t.name
        for t in spark.catalog.listTables()
        if t.name.startswith("silver_loads_") and t.name not in others
    ]
    assert len(names) == versions.KEPT  # tables of versions that are gone are dropped
    tables = {n: read_silver(spark, lake, n) for n in SPECS}
    plain = {n: spark.createDataFrame(df.collect(), df.schema) for n, df in tables.items()}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables["delivery_events"].join(tables["loads"], "load_id", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        mart = MARTS["gold_delivery_performance"].build(tables)
        plan = mart._jdf.queryExecution().executedPlan().toString()
        # events move to the trips, trips and loads stay; facilities are plain
        assert plan.count("Exchange hashpartitioning(trip_id") == 1
        assert "Exchange hashpartitioning(load_id" not in plan
        assert rows(mart) == rows(MARTS["gold_delivery_performance"].build(plain))
        per_load = tables["delivery_events"].groupBy("load_id").count()
        assert "Exchange" not in per_load._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for t in spark.catalog.listTables():
            if t.name.startswith("silver_") and t.name not in others:
                spark.sql(f"DROP TABLE {t.name}")
    # without the catalog the same files are read
    assert rows(read_silver(spark, lake, "loads")) == rows(plain["loads"])
