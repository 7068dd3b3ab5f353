"""Bronze, Silver and Gold jobs on a small batch that holds every kind of defect."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.operators.quality import GateFailed
from lakemart.operators.quarantine import accepted, audit, classify, rejected
from lakemart.plans import silver
from lakemart.plans.bronze import run_bronze
from lakemart.plans.gold import build_marts, publish_catalog, run_gold, validate_gold
from lakemart.plans.logistics import LOADS, SPECS, TRIPS
from lakemart.plans.marts import MARTS
from lakemart.plans.run import run
from lakemart.plans.spec import TableSpec, conform
from lakemart.sinks.quarantine import defect_audit, read_quarantine, write_quarantine
from lakemart.sources.raw import raw_csv, read_bronze
from lakemart.sources.tables import read_catalog, read_gold, read_path, read_silver

CSV = {
    "customers": """customer_id,customer_name,customer_type,account_status,contract_start_date,annual_revenue_potential
 C1 ,Acme,Retail,Active,2020-01-01,1000.5
C2,"Beta, Inc",Retail,Active,someday,x
C2,"Beta, Inc",Retail,Closed,2021-01-01,5
   ,Nobody,Retail,Active,2020-01-01,1
""",
    "facilities": """facility_id,facility_name,facility_type,city,state,latitude,longitude,operating_hours
F1,Dock,Hub,Reno,NV,1.5,2.5,24/7
""",
    "routes": """route_id,origin_city,origin_state,destination_city,destination_state,typical_distance_miles,base_rate_per_mile,fuel_surcharge_rate,typical_transit_days
R1,Reno,NV,Elko,NV,290,2.1,0.2,1
""",
    "drivers": """driver_id,first_name,last_name,hire_date,termination_date,employment_status,years_experience
D1,Ann,Lee,2019-05-05,,Active,3.0
""",
    "trucks": """truck_id,unit_number,make,model_year,acquisition_date,acquisition_mileage,fuel_type,tank_capacity_gallons,status
T1,7,Volvo,2019.0,2019-06-01,12,Diesel,150,Active
""",
    "loads": """load_id,customer_id,route_id,load_date,load_type,weight_lbs,pieces,revenue,load_status,booking_type,updated_at
L1,C1,R1,2026-01-01,Dry,100,3.0,1000,COMPLETED,Spot,2026-01-01 00:00:00
L1,C1,R1,2026-01-01,Dry,100,3.0,900,Cancelled,Spot,2026-01-02 00:00:00
L2,C1,R1,2026-01-01,Dry,100,3,500,,Spot,2026-01-01 00:00:00
L2,C1,R1,2026-01-01,Dry,-5,3,700,COMPLETED,Spot,2026-01-09 00:00:00
L3,C9,R9,2026-01-01,Dry,100,3,500,COMPLETED,Spot,
L4,,R1,2026-01-01,Dry,100,3,500,COMPLETED,Spot,
L5,C2,R1,2026-01-01,Dry,abc,3,-500,COMPLETED,Spot,
L6,C2,R1,2026-01-03,Dry,10,3,250.25,COMPLETED,Spot,
L6,C2,R1,2026-01-03,Dry,10,3,250.25,COMPLETED,Spot,
,C2,R1,2026-01-03,Dry,10,3,250.25,Cancelled,Spot,
,C2,R1,2026-01-03,Dry,10,3,250.25,Cancelled,Spot,
""",
    "trips": """trip_id,load_id,driver_id,truck_id,dispatch_date,actual_distance_miles,actual_duration_hours,fuel_gallons_used,idle_time_hours,trip_status
P1,L1,D1,T1,2026-01-01,300,6,50,1,Done
P2,L2,D1,T1,2026-01-01,310,6,0,7,Done
P3,L3,D1,T1,2026-01-01,310,6,40,1,Done
P4,L6,,T1,2026-01-01,310,6,40,1,Done
P5,L6,D1,T9,2026-01-01,310,6,40,1,Done
P6,L6,D1,T1,2026-01-02,100.5,0,10,0,Done
""",
    "delivery_events": """event_id,load_id,trip_id,event_type,facility_id,scheduled_datetime,actual_datetime,detention_minutes,on_time_flag,location_city,location_state
E1,L1,P1,Pickup,F1,2026-01-01 08:00:00,2026-01-01 08:30:00,12.0,true,Reno,NV
E2,L1,P1,Drop,F1,2026-01-01 08:00:00,2026-01-01 07:30:00,12,true,Reno,NV
E3,L3,P1,Drop,F1,2026-01-01 08:00:00,2026-01-01 08:30:00,12,true,Reno,NV
E4,L6,P5,Drop,F1,2026-01-01 08:00:00,2026-01-01 08:30:00,12,true,Reno,NV
E5,L6,P6,Drop,F9,2026-01-01 08:00:00,2026-01-01 08:30:00,12,true,Reno,NV
E6,L6,P6,Drop,F1,2026-01-01 08:00:00,2026-01-02 08:30:00,,false,Reno,NV
E7,L6,P6,Drop,F1,nonsense,2026-01-02 08:30:00,,false,Reno,NV
""",
}

QUARANTINED = {
    ("customers", "missing_primary_key", 1),
    ("loads", "missing_primary_key", 2),
    ("loads", "invalid_business_values", 2),
    ("loads", "invalid_customer_fk", 2),
    ("trips", "invalid_duration_metrics", 1),
    ("trips", "invalid_load_fk", 1),
    ("trips", "invalid_driver_fk", 1),
    ("trips", "invalid_truck_fk", 1),
    ("delivery_events", "invalid_event_timestamps", 2),
    ("delivery_events", "orphan_load_fk", 1),
    ("delivery_events", "orphan_trip_fk", 1),
    ("delivery_events", "invalid_facility_fk", 1),
}
SILVER_ROWS = {
    "customers": 2, "facilities": 1, "routes": 1, "drivers": 1, "trucks": 1, "loads": 3,
    "trips": 2, "delivery_events": 2,
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake after a full run from CSV files."""
    source = tmp_path_factory.mktemp("incoming")
    for name, text in CSV.items():
        (source / f"{name}.csv").write_text(text)
    lake = str(tmp_path_factory.mktemp("lake"))
    run_bronze(spark, str(source), lake)
    outcomes = silver.run_silver(spark, lake)
    totals = run_gold(spark, lake)
    return lake, outcomes, totals


def test_bronze_keeps_lines_and_describes_them(spark, lake):
    path, *_ = lake
    manifest = spark.read.json(f"{path}/metadata/bronze_manifest")
    row = manifest.where("table_name = 'loads'").first()
    assert (row.source_file, row.row_count, row.column_count) == ("loads.csv", 11, 11)
    assert row.source_file_size_bytes == len(CSV["loads"])
    assert row.columns[:2] == ["load_id", "customer_id"] and row.layer == "bronze"
    assert manifest.count() == 8
    names = [r.customer_name for r in read_bronze(spark, path, "customers").collect()]
    assert names.count("Beta, Inc") == 2


def test_silver_outcomes(spark, lake, rows):
    path, outcomes, _ = lake
    got = {(r.table_name, r.outcome): r.row_count for r in outcomes.collect()}
    assert {n: got[n, "__accepted__"] for n in SPECS} == SILVER_ROWS
    assert {(t, o, n) for (t, o), n in got.items() if o != "__accepted__"} == QUARANTINED
    found = read_quarantine(spark, f"{path}/quarantine", SPECS)
    assert {tuple(r) for r in defect_audit(found).collect()} == QUARANTINED
    assert dict(found["loads"].dtypes)["quarantined_at_utc"] == "timestamp"
    report = raw_csv(spark, f"{path}/reports/silver_quality_report")
    assert report.columns == ["table_name", "silver_row_count", "processed_at_utc"]
    assert {r[0]: int(r[1]) for r in report.collect()} == SILVER_ROWS


def test_silver_values(spark, lake, rows):
    path, *_ = lake
    loads = read_silver(spark, path, "loads")
    # L1 was cancelled last; the newest L2 is invalid, so the older one stays.
    assert rows(loads, "load_id", "revenue", "pieces") == [
        ("L1", 0.0, 3), ("L2", 500.0, 3), ("L6", 250.25, 3)
    ]
    assert rows(read_silver(spark, path, "customers"), "customer_id", "account_status") == [
        ("C1", "Active"), ("C2", "Closed")
    ]
    types = dict(read_silver(spark, path, "delivery_events").dtypes)
    assert types["detention_minutes"] == "int" and types["on_time_flag"] == "boolean"
    assert "quarantine_reason" not in types
    # Quarantined loads keep the revenue they came with unless they passed the rules.
    bad = read_quarantine(spark, f"{path}/quarantine", ["loads"])["loads"]
    assert rows(bad.where("quarantine_reason = 'missing_primary_key'"), "revenue") == [
        (250.25,), (250.25,)
    ]


def test_gold(spark, lake, rows):
    path, _, totals = lake
    assert totals.first().status == "PASS" and totals.first().silver_total == 750.25
    mart = read_gold(spark, path, "gold_load_performance")
    assert rows(mart, "load_id", "total_delivery_events", "on_time_events", "total_detention_minutes") == [
        ("L1", 1, 1, 12.0), ("L2", 0, 0, 0.0), ("L6", 1, 0, 0.0)
    ]
    assert rows(read_gold(spark, path, "gold_truck_performance"), "truck_id", "fuel_efficiency_miles_per_gallon") == [
        ("T1", 6.68)
    ]
    report = validate_gold(spark, path)
    assert {r.validation_status for r in report.collect()} == {"PASS"}
    assert [r.table_name for r in report.collect()] == sorted(MARTS)
    for name, m in MARTS.items():
        assert "last_ingested_at" in read_gold(spark, path, name).columns


def test_marts_in_the_catalog(spark, lake, rows):
    path, *_ = lake
    spark.sql("CREATE DATABASE lakemart_test")
    try:
        silver_tables = {n: read_silver(spark, path, n) for n in SPECS}
        built = {"gold_daily_operations": build_marts(silver_tables)["gold_daily_operations"]}
        # The first upsert creates the table, a replace renews it.
        for mode in ("upsert", "replace"):
            publish_catalog(built, "lakemart_test", mode)
            found = read_catalog(spark, "lakemart_test.gold_daily_operations")
            assert rows(found.drop("last_ingested_at")) == rows(built["gold_daily_operations"])
    finally:
        spark.sql("DROP DATABASE lakemart_test CASCADE")


def test_rerun_publishes_the_same(spark, lake, rows):
    path, *_ = lake
    before = {n: rows(read_gold(spark, path, n).drop("last_ingested_at")) for n in MARTS}
    for mode in ("replace", "upsert"):
        run(spark, path, mode=mode)
        after = {n: rows(read_gold(spark, path, n).drop("last_ingested_at")) for n in MARTS}
        assert after == before


def test_empty_batch_blocks_gold(spark, tmp_path, rows):
    source, lake = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    for name, text in CSV.items():
        (source / f"{name}.csv").write_text(text)
    run(spark, lake, str(source))
    before = rows(read_gold(spark, lake, "gold_load_performance"))
    (source / "loads.csv").write_text(CSV["loads"].split("\n")[0] + "\n")
    with pytest.raises(GateFailed, match="loads"):
        run(spark, lake, str(source))
    assert read_silver(spark, lake, "loads").count() == 0
    assert rows(read_gold(spark, lake, "gold_load_performance")) == before
    # No rejected load this time, so none lingers in quarantine.
    assert "loads" not in read_quarantine(spark, f"{lake}/quarantine", SPECS)


def test_failed_grain_publishes_nothing(spark, lake, monkeypatch, rows):
    path, *_ = lake
    before = rows(read_gold(spark, path, "gold_daily_operations"))
    from lakemart.plans import gold

    def fail(*_):
        raise GateFailed("totals")

    monkeypatch.setattr(gold, "reconcile", fail)
    with pytest.raises(GateFailed):
        gold.run_gold(spark, path)
    assert rows(read_gold(spark, path, "gold_daily_operations")) == before


def test_bronze_run_summary(spark, tmp_path, rows):
    source = tmp_path / "in"
    source.mkdir()
    (source / "Good Table.csv").write_text("a,b\n1,2\n")
    (source / "bad.csv").write_text("\n\n")
    with pytest.raises(ValueError, match="missing expected"):
        run_bronze(spark, str(source), str(tmp_path / "lake"), ["loads"])
    assert not (tmp_path / "lake").exists()
    summary = run_bronze(spark, str(source), str(tmp_path / "lake"), ["good_table"])
    assert rows(summary, "table_name", "status", "row_count", "column_count") == [
        ("bad", "FAILED", None, None), ("good_table", "SUCCESS", 1, 2)
    ]
    with pytest.raises(FileNotFoundError):
        run_bronze(spark, str(tmp_path / "nowhere"), str(tmp_path / "lake"), [])


def test_spec_reports_missing_columns(frame):
    with pytest.raises(ValueError, match="route_id"):
        conform(frame("load_id string, customer_id string", ("L", "C")), LOADS)


def test_updated_at_is_optional_and_text_in_dimensions(frame, rows):
    spec = TableSpec("d", "id", recency=("updated_at",))
    df = frame("id string, updated_at string, v int", ("a", "9", 1), ("a", "10", 2))
    assert rows(accepted(classify(df, spec, {}))) == [("a", "9", 1)]
    assert accepted(classify(df.drop("updated_at"), spec, {})).count() == 1


def test_single_quarantine_set(spark, frame, tmp_path, rows):
    folder = str(tmp_path / "q")
    df = frame("id int", (1,), (2,))
    assert not write_quarantine(df.limit(0), folder, "t", "r")
    assert write_quarantine(df, folder, "t", "r") and write_quarantine(df.limit(1), folder, "t", "s")
    assert read_path(spark, f"{folder}/t").groupBy("quarantine_reason").count().count() == 2


TRIP = st.tuples(
    st.sampled_from([None, "", " t1", "t1", "t2", "t3"]),
    st.sampled_from([None, "l1", "l2"]),
    st.sampled_from(["d1", "d2", None]),
    st.sampled_from(["2", "bad", None]),
    st.sampled_from(["1", "3", "NaN"]),
    st.sampled_from(["2026-01-01", "2026-01-02", ""]),
)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TRIP, max_size=40))
def test_every_row_ends_in_one_place(spark, data):
    """bronze = silver + quarantined + superseded, against a plain Python account."""
    df = spark.createDataFrame(
        data,
        "trip_id string, load_id string, driver_id string, actual_duration_hours string, "
        "idle_time_hours string, dispatch_date string",
    ).selectExpr(
        "*", "'T1' AS truck_id", "'1' AS actual_distance_miles", "'1' AS fuel_gallons_used"
    )
    parents = {
        "loads": spark.createDataFrame([("l1",)], "load_id string"),
        "drivers": spark.createDataFrame([("d1",)], "driver_id string"),
        "trucks": spark.createDataFrame([("T1",)], "truck_id string"),
    }
    got = {(r[1]): r[2] for r in audit(classify(df, TRIPS, parents), "trips").collect()}

    clean = [((t or "").strip(" ") or None, *rest) for t, *rest in data]
    missing = [r for r in clean if r[0] is None]
    valid = [r for r in clean if r[0] and r[3] == "2" and r[4] == "1"]
    assert got.get("missing_primary_key", 0) == len(missing)
    assert got.get("invalid_duration_metrics", 0) == len(clean) - len(missing) - len(valid)

    latest = {}
    for trip, load, driver, _, _, date in valid:
        rank = (date, driver or "", load or "")
        latest[trip] = max(latest.get(trip, rank), rank)
    bad_load = [r for r in latest.values() if r[2] != "l1"]
    bad_driver = [r for r in latest.values() if r[2] == "l1" and r[1] != "d1"]
    assert got.get("invalid_load_fk", 0) == len(bad_load)
    assert got.get("invalid_driver_fk", 0) == len(bad_driver)

    report = silver.conservation(df, classify(df, TRIPS, parents), "trips").first()
    assert report.bronze_rows == len(data)
    assert report.superseded_rows == len(valid) - len(latest)
    assert report.silver_rows == len(latest) - len(bad_load) - len(bad_driver)


def test_rejects_keep_exact_duplicates(spark, frame):
    df = frame("id string, v int", (None, 1), (None, 1), ("a", 1), ("a", 1))
    classified = classify(df, TableSpec("d", "id"), {})
    assert rejected(classified).count() == 2 and accepted(classified).count() == 1
    assert classified.agg(F.count("*")).first()[0] == 3
