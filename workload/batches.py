"""Silver recipes, corrections, late events, upserts, crosswalk."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions.columns import event_date, pct, restate_cancelled
from lakemart.operators import batches, crosswalk, integrity
from lakemart.operators.quarantine import QUARANTINED_AT, accepted, rejected
from lakemart.plans import marts, silver
from lakemart.session import work_path
from lakemart.sinks import tables
from lakemart.sinks.quarantine import defect_audit, read_quarantine
from lakemart.sources.tables import read_path, read_silver, read_unique
from workload.marts import CUSTOMER, daily_sql
from workload.oracle_roles import SILVER, with_roles
from workload.roles import customers, loads, raw, scans, table, trips, typed


def _classified(spark, sf_dir, *names):
    specs = {n: silver.SPECS[n] for n in (names or silver.SPECS)}
    return silver.classify_all(raw(spark, sf_dir, *specs), specs)


LOAD_TABLES = ("customers", "routes", "loads")
TRIP_TABLES = ("customers", "routes", "drivers", "trucks", "loads", "trips")


def silver_customers(spark, sf_dir):
    return accepted(_classified(spark, sf_dir, "customers")["customers"])


def silver_facilities(spark, sf_dir):
    return accepted(_classified(spark, sf_dir, "facilities")["facilities"])


def silver_drivers(spark, sf_dir):
    return accepted(_classified(spark, sf_dir, "drivers")["drivers"])


def silver_trucks(spark, sf_dir):
    return accepted(_classified(spark, sf_dir, "trucks")["trucks"])


def silver_routes(spark, sf_dir):
    return accepted(_classified(spark, sf_dir, "routes")["routes"])


def silver_loads(spark, sf_dir):
    return accepted(_classified(spark, sf_dir, *LOAD_TABLES)["loads"])


def _published(spark, sf_dir, *names):
    """A lake with the named tables after the Silver job, and its outcomes.

    Tables with parents of their own go through the job: each table is computed and
    written once, where one lazy plan would compute the parents again per child.
    """
    specs = {n: silver.SPECS[n] for n in (names or silver.SPECS)}
    lake = work_path(spark, "silver")
    outcomes = silver.run_silver(spark, lake, raw(spark, sf_dir, *specs), specs)
    return lake, outcomes


def _quarantined(spark, lake, name):
    return read_quarantine(spark, f"{lake}/quarantine", [name])[name].drop(QUARANTINED_AT)


def silver_trips(spark, sf_dir):
    return read_silver(spark, _published(spark, sf_dir, *TRIP_TABLES)[0], "trips")


def silver_delivery_events(spark, sf_dir):
    return read_silver(spark, _published(spark, sf_dir)[0], "delivery_events")


def quarantined_loads(spark, sf_dir):
    return rejected(_classified(spark, sf_dir, *LOAD_TABLES)["loads"])


def quarantined_trips(spark, sf_dir):
    return _quarantined(spark, _published(spark, sf_dir, *TRIP_TABLES)[0], "trips")


def quarantined_delivery_events(spark, sf_dir):
    return _quarantined(spark, _published(spark, sf_dir)[0], "delivery_events")


def silver_job(spark, sf_dir):
    """Rows per table and outcome of the whole Silver job."""
    return _published(spark, sf_dir)[1]


def quarantine_audit(spark, sf_dir):
    """Rejected trips and loads by reason."""
    lake, _ = _published(spark, sf_dir, *TRIP_TABLES)
    return defect_audit(read_quarantine(spark, f"{lake}/quarantine", ("loads", "trips")))


def silver_counts(spark, sf_dir):
    specs = {n: silver.SPECS[n] for n in TRIP_TABLES}
    report = silver.silver_report(_published(spark, sf_dir, *specs)[1], specs)
    return report.drop("processed_at_utc")


def quarantine_audit_all(spark, sf_dir):
    """Rejected rows of all eight tables by reason."""
    lake, _ = _published(spark, sf_dir)
    return defect_audit(read_quarantine(spark, f"{lake}/quarantine", tuple(silver.SPECS)))


def silver_counts_all(spark, sf_dir):
    """Silver rows of all eight tables."""
    return silver.silver_report(_published(spark, sf_dir)[1]).drop("processed_at_utc")


def orphan_profile_all(spark, sf_dir):
    """Every foreign key of the model: arrived children against the Silver parents."""
    lake, _ = _published(spark, sf_dir)
    children = typed(spark, sf_dir)
    # Events are a join of facts; their keys are taken from it once, not for each foreign key.
    keys = work_path(spark, "event_keys")
    edges = silver.SPECS["delivery_events"].foreign_keys
    children["delivery_events"].select(*[e.column for e in edges]).write.parquet(keys)
    children["delivery_events"] = read_path(spark, keys)
    return batches.union_batches(
        *[
            integrity.orphan_profile(
                children[n], e.column, read_silver(spark, lake, e.parent), e.parent_column, _edge(n, e)
            )
            for n, spec in silver.SPECS.items()
            for e in spec.foreign_keys
        ]
    )


def _edge(child, e):
    return f"{e.parent}.{e.parent_column} -> {child}.{e.column}"


def conservation(spark, sf_dir):
    """Every load is in Silver, in quarantine or superseded; the batch arrives twice."""
    arrived = raw(spark, sf_dir, *LOAD_TABLES)
    arrived["loads"] = batches.union_batches(arrived["loads"], arrived["loads"])
    classified = silver.classify_all(arrived, {n: silver.SPECS[n] for n in LOAD_TABLES})
    return silver.conservation(arrived["loads"], classified["loads"], "loads")


def _corrections(spark, sf_dir):
    """A later batch: every pending order is cancelled, and finished ones get dearer."""
    orders = loads(spark, sf_dir)
    return orders.where("load_status <> 'IN_TRANSIT'").selectExpr(
        "load_id",
        "customer_id",
        "CASE WHEN load_status = 'COMPLETED' THEN revenue + 100 ELSE revenue END AS revenue",
        "load_status",
        "date_add(load_date, 30) AS updated_at",
    )


def correction_restatement(spark, sf_dir):
    base = loads(spark, sf_dir).selectExpr(
        "load_id", "customer_id", "revenue", "'IN_TRANSIT' AS load_status",
        "load_date AS updated_at",
    )
    latest = batches.apply_corrections(base, _corrections(spark, sf_dir), "load_id", ["updated_at"])
    return latest.withColumn("revenue", restate_cancelled("revenue", "load_status"))


def redelivery_idempotent(spark, sf_dir):
    """The customer mart after the same batch of loads arrived twice."""
    batch = loads(spark, sf_dir)
    twice = batches.apply_corrections(batch, batch, "load_id", ["load_date"])
    return marts.customer_performance({"loads": twice, "customers": customers(spark, sf_dir)})


def late_event_restatement(spark, sf_dir):
    """Error events arrive late and, of every tenth user, moved one day on.

    The mart of the punctual events is brought up to date for the touched dates only.
    """
    events = scans(spark, sf_dir)
    moved = F.when(
        F.col("user_id") % 10 == 0, F.col("actual_datetime") + F.expr("INTERVAL 1 DAY")
    ).otherwise(F.col("actual_datetime"))
    late = events.where("NOT on_time_flag OR user_id % 10 = 0").withColumn("actual_datetime", moved)
    base = events.where("on_time_flag")
    return batches.restate_dates(
        mart=marts.daily_rows(base),
        base=base,
        late=late,
        key="event_id",
        recency=["actual_datetime"],
        date_of=lambda: event_date("actual_datetime"),
        date_column="event_date",
        summarize=marts.daily_rows,
    )


def late_event_deltas(spark, sf_dir):
    """The same late events as sums per date: deltas only, written to the months they fall in."""
    events = scans(spark, sf_dir)
    moved = F.when(
        F.col("user_id") % 10 == 0, F.col("actual_datetime") + F.expr("INTERVAL 1 DAY")
    ).otherwise(F.col("actual_datetime"))
    late = events.where("NOT on_time_flag OR user_id % 10 = 0").withColumn("actual_datetime", moved)
    base = events.where("on_time_flag")
    date = event_date("actual_datetime")
    measures = {
        "total_events": F.lit(1).cast("long"),
        "on_time_events": F.col("on_time_flag").cast("long"),
        "detention": F.col("detention_minutes").cast("decimal(28,6)"),
        "detained": F.col("detention_minutes").isNotNull().cast("long"),
    }
    target = work_path(spark, "daily_totals")
    month = F.date_format("event_date", "yyyy-MM").alias("month")
    totals = base.groupBy(date.alias("event_date")).agg(*[F.sum(m).alias(n) for n, m in measures.items()])
    tables.replace(totals.select("*", month), target, ["month"])
    changed = batches.restated_totals(
        read_path(spark, target), base, late, "event_id", ["actual_datetime"],
        lambda: event_date("actual_datetime"), "event_date", measures,
    )
    tables.upsert_partitions(changed.select("*", month), target, "event_date", "month", follows=True)
    mean = F.try_divide(F.col("detention").cast("double"), F.col("detained"))
    return read_path(spark, target).where("total_events > 0").select(
        "event_date", "total_events", "on_time_events",
        pct("on_time_events", "total_events").alias("on_time_rate"), mean.alias("avg_detention_minutes"),
    )


def grain_guard(spark, sf_dir):
    """Silver trips from a table dealt by their key, guarded while they are read."""
    lake, _ = _published(spark, sf_dir, *TRIP_TABLES)
    folder = work_path(spark, "trips_by_key")
    name = folder.rpartition("/")[2].replace("-", "_")
    tables.create_bucketed(read_silver(spark, lake, "trips", "trip_id", ["dispatch_date"]), name, "trip_id", 8, folder)
    return read_unique(spark, name, "trip_id")


def batch_union(spark, sf_dir):
    """Two batches, one without a status column."""
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")
    second = orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")
    return batches.union_batches(first, second)


def set_difference(spark, sf_dir):
    """Customers without an order of more than 400,000."""
    people = table(spark, sf_dir, "customer").selectExpr("c_custkey AS custkey")
    buyers = table(spark, sf_dir, "orders").where("o_totalprice > 400000").selectExpr(
        "o_custkey AS custkey"
    )
    return batches.rows_missing_in(people, buyers, "custkey")


def _upsert_batches(spark, sf_dir):
    """A published mart of finished orders, and a batch with all urgent and all open ones."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    published = orders.where("o_orderstatus = 'F'").drop("o_orderpriority")
    batch = orders.where("o_orderpriority = '1-URGENT' OR o_orderstatus = 'O'").drop(
        "o_orderpriority"
    )
    return published, batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def upsert(spark, sf_dir):
    """Published twice in a row, the second time without effect."""
    published, batch = _upsert_batches(spark, sf_dir)
    target = work_path(spark, "upsert")
    tables.replace(published, target)
    tables.upsert(batch, target, "o_orderkey")
    tables.upsert(batch, target, "o_orderkey")
    return read_path(spark, target)


def upsert_match(spark, sf_dir):
    published, batch = _upsert_batches(spark, sf_dir)
    return tables.matched_and_new(published, batch, "o_orderkey")


def upsert_by_partition(spark, sf_dir):
    """Orders by priority; pending ones move to a new priority and change price."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    pending = orders.where("o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey", "o_totalprice + 1 AS o_totalprice", "o_orderstatus",
        "'0-NOW' AS o_orderpriority",
    )
    target = work_path(spark, "upsert_by_partition")
    tables.upsert_partitions(orders, target, "o_orderkey", "o_orderpriority")
    tables.upsert_partitions(pending, target, "o_orderkey", "o_orderpriority")
    return read_path(spark, target)


def partition_overwrite(spark, sf_dir):
    """Orders by status; only the partition of the second batch is replaced."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    target = work_path(spark, "partitions")
    tables.overwrite_partitions(orders, target, ["o_orderstatus"])
    dearer = orders.where("o_orderstatus = 'P'").withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    tables.overwrite_partitions(dearer, target, ["o_orderstatus"])
    return read_path(spark, target)


def key_crosswalk(spark, sf_dir):
    return crosswalk.key_crosswalk(trips(spark, sf_dir), "trip_id", "TRIP")


def mapped_keys(spark, sf_dir):
    """Lines with their part renumbered; parts missing in the crosswalk map to NULL."""
    parts = table(spark, sf_dir, "part").where("p_size <= 45")
    ids = crosswalk.key_crosswalk(parts, "p_partkey", "TRK")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return crosswalk.map_keys(lines, "l_partkey", ids)


QUERIES = {
    f.__name__: f
    for f in (
        silver_customers,
        silver_facilities,
        silver_routes,
        silver_drivers,
        silver_trucks,
        silver_loads,
        silver_trips,
        silver_delivery_events,
        quarantined_loads,
        quarantined_trips,
        quarantined_delivery_events,
        silver_job,
        quarantine_audit,
        silver_counts,
        quarantine_audit_all,
        silver_counts_all,
        orphan_profile_all,
        conservation,
        correction_restatement,
        redelivery_idempotent,
        late_event_restatement,
        late_event_deltas,
        grain_guard,
        batch_union,
        set_difference,
        upsert,
        upsert_match,
        upsert_by_partition,
        partition_overwrite,
        key_crosswalk,
        mapped_keys,
    )
}

ORACLE = {f"silver_{n}": with_roles(f"SELECT * FROM silver_{n}") for n in SILVER}
ORACLE |= {
    f"quarantined_{n}": with_roles(
        f"SELECT * FROM classified_{n} WHERE quarantine_reason IS NOT NULL"
    )
    for n in ("loads", "trips", "delivery_events")
}
ORACLE["silver_job"] = with_roles(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, coalesce(quarantine_reason, '__accepted__') AS outcome, "
        f"count(*) AS row_count FROM classified_{n} GROUP BY 2"
        for n in SILVER
    )
)
ORACLE["quarantine_audit"] = with_roles(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, quarantine_reason AS issue_type, "
        f"count(*) AS affected_count FROM classified_{n} "
        "WHERE quarantine_reason IS NOT NULL GROUP BY 2"
        for n in ("loads", "trips")
    )
)
ORACLE["silver_counts"] = with_roles(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS silver_row_count FROM silver_{n}"
        for n in TRIP_TABLES
    )
)
ORACLE["quarantine_audit_all"] = with_roles(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, quarantine_reason AS issue_type, "
        f"count(*) AS affected_count FROM classified_{n} "
        "WHERE quarantine_reason IS NOT NULL GROUP BY 2"
        for n in SILVER
    )
)
ORACLE["silver_counts_all"] = with_roles(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS silver_row_count FROM silver_{n}" for n in SILVER
    )
)
ORACLE["orphan_profile_all"] = with_roles(
    " UNION ALL ".join(
        f"""
        SELECT '{_edge(n, e)}' AS relationship,
               count(DISTINCT c.{e.column}) FILTER (WHERE p.k IS NULL) AS orphan_values,
               count(c.{e.column}) AS non_null_rows,
               CASE WHEN count(c.{e.column}) FILTER (WHERE p.k IS NULL) = 0
                    THEN 'PASS' ELSE 'WARNING' END AS status
        FROM {n} c LEFT JOIN (SELECT DISTINCT {e.parent_column} AS k FROM silver_{e.parent}) p
             ON c.{e.column} = p.k"""
        for n, spec in silver.SPECS.items()
        for e in spec.foreign_keys
    )
)
ORACLE["conservation"] = with_roles(
    """SELECT 'loads' AS table_name, 2 * count(*) AS bronze_rows,
           count(*) FILTER (WHERE quarantine_reason IS NULL) AS silver_rows,
           count(*) FILTER (WHERE quarantine_reason LIKE 'invalid_%_fk')
               + 2 * count(*) FILTER (WHERE quarantine_reason = 'invalid_business_values')
               AS quarantined_rows,
           count(*) FILTER (WHERE quarantine_reason IS NULL
                            OR quarantine_reason <> 'invalid_business_values')
               AS superseded_rows
    FROM classified_loads"""
)
_LATEST = (
    "QUALIFY row_number() OVER (PARTITION BY load_id ORDER BY updated_at DESC, customer_id DESC, "
    "load_status DESC, revenue DESC) = 1"
)
ORACLE["correction_restatement"] = with_roles(
    f"""SELECT load_id, customer_id, updated_at, load_status,
           CASE WHEN upper(load_status) = 'CANCELLED' THEN 0.0 ELSE revenue END AS revenue
    FROM (SELECT * FROM (
        SELECT load_id, customer_id, revenue, 'IN_TRANSIT' AS load_status, load_date AS updated_at
        FROM loads
        UNION ALL
        SELECT load_id, customer_id,
               CASE WHEN load_status = 'COMPLETED' THEN revenue + 100 ELSE revenue END,
               load_status, load_date + 30
        FROM loads WHERE load_status <> 'IN_TRANSIT') {_LATEST})"""
)
ORACLE["redelivery_idempotent"] = with_roles(
    CUSTOMER.replace(
        "FROM loads GROUP BY", "FROM (SELECT * FROM loads UNION SELECT * FROM loads) GROUP BY"
    )
)
_MOVED = """
    SELECT event_id, user_id, on_time_flag, detention_minutes,
           CASE WHEN user_id % 10 = 0 THEN actual_datetime + INTERVAL 1 DAY
                ELSE actual_datetime END AS actual_datetime
    FROM scans WHERE NOT on_time_flag OR user_id % 10 = 0"""
ORACLE["late_event_restatement"] = with_roles(
    daily_sql("final_scans"),
    {
        "all_scans": "SELECT event_id, user_id, on_time_flag, detention_minutes, actual_datetime "
        f"FROM scans WHERE on_time_flag UNION ALL {_MOVED}",
        "final_scans": "SELECT * FROM all_scans QUALIFY row_number() OVER "
        "(PARTITION BY event_id ORDER BY actual_datetime DESC) = 1",
    },
)
ORACLE["late_event_deltas"] = ORACLE["late_event_restatement"]
ORACLE["grain_guard"] = with_roles("SELECT * FROM silver_trips")
ORACLE["batch_union"] = """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus <> 'F'"""
ORACLE["set_difference"] = """
    SELECT c_custkey AS custkey FROM customer
    EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000"""
_BATCH = "o_orderpriority = '1-URGENT' OR o_orderstatus = 'O'"
ORACLE["upsert"] = f"""
    SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderstatus
    FROM orders WHERE {_BATCH}
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus
    FROM orders WHERE o_orderstatus = 'F' AND NOT ({_BATCH})"""
ORACLE["upsert_match"] = f"""
    SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS matched_rows,
           count(*) FILTER (WHERE o_orderstatus <> 'F') AS new_rows
    FROM orders WHERE {_BATCH}"""
_MOVES = "o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'"
ORACLE["upsert_by_partition"] = f"""
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN {_MOVES} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN {_MOVES} THEN '0-NOW' ELSE o_orderpriority END AS o_orderpriority
    FROM orders"""
ORACLE["partition_overwrite"] = """
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END
               AS o_totalprice
    FROM orders"""
ORACLE["key_crosswalk"] = with_roles(
    """SELECT trip_id AS source_key,
           'TRIP' || lpad(CAST(row_number() OVER (ORDER BY trip_id) AS VARCHAR), 8, '0')
               AS target_id
    FROM (SELECT DISTINCT trip_id FROM trips)"""
)
ORACLE["mapped_keys"] = """
    SELECT l_orderkey, l_linenumber, target_id AS l_partkey
    FROM lineitem LEFT JOIN (
        SELECT p_partkey,
               'TRK' || lpad(CAST(row_number() OVER (ORDER BY p_partkey) AS VARCHAR), 8, '0')
                   AS target_id
        FROM part WHERE p_size <= 45) ON l_partkey = p_partkey"""
