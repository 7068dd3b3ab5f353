"""Raw files: the given tables written as CSV by Spark, then listed, read and landed."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions.columns import safe_cast
from lakemart.plans.bronze import run_bronze
from lakemart.plans.logistics import REQUIRED_LOAD_COLUMNS
from lakemart.session import work_path
from lakemart.sinks.landing import land
from lakemart.sinks.paths import rename
from lakemart.sinks.reports import write_report
from lakemart.sources import raw as source
from lakemart.sources.ranges import Quoting
from workload.roles import loads, table, trips

SOURCES = ("customer", "orders", "lineitem")
DOUBLED = Quoting(escape='"')


def _csv(spark, df, name):
    path = work_path(spark, name)
    df.write.option("header", True).csv(path)
    return path


def csv_scan(spark, sf_dir):
    """Orders as CSV parts, read back as text and typed."""
    text = source.raw_csv(spark, _csv(spark, table(spark, sf_dir, "orders"), "orders_csv"))
    types = {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
        "o_orderdate": "date",
    }
    return text.withColumns({c: safe_cast(c, t) for c, t in types.items()})


def csv_batches(spark, sf_dir):
    """Two delivered batches read as one table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    paths = [
        _csv(spark, orders.where(condition), "batch")
        for condition in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'")
    ]
    return source.raw_csv(spark, paths)


def intake_status(spark, sf_dir):
    """A batch with data, one with a header only, one without required columns."""
    orders = loads(spark, sf_dir).select(*REQUIRED_LOAD_COLUMNS)
    batches = {
        "full": orders,
        # A header without rows.
        "holiday": orders.limit(0),
        "corrupt": orders.select("load_id", "customer_id"),
    }
    paths = {name: _csv(spark, df, name) for name, df in batches.items()}
    return source.intake_status(spark, paths, dict.fromkeys(paths, REQUIRED_LOAD_COLUMNS))


def _delivery(spark, sf_dir):
    """A folder with one subfolder of CSV files per table, as an upstream would drop it."""
    folder = work_path(spark, "delivery")
    for name in SOURCES:
        table(spark, sf_dir, name).write.option("header", True).csv(f"{folder}/{name}")
    return folder


def table_names(spark, sf_dir):
    """Table names as they follow from file paths like ``<brand>/<Type> <size>.csv``."""
    paths = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.format_string("in/%s/ %s-%s (%d).csv", "p_brand", "p_type", "p_name", "p_size").alias(
            "path"
        ),
    )
    return paths.select("p_partkey", source.table_name("path").alias("table_name"))


def table_presence(spark, sf_dir):
    """Order statuses play delivered tables, line flags expected ones."""
    found = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("table_name"))
    expected = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("table_name"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("table_name"))
    return source.table_presence(found, expected.unionByName(lines))


def bronze_landing(spark, sf_dir):
    """Orders landed in Bronze and read back; nothing is lost or changed."""
    delivered = _csv(spark, table(spark, sf_dir, "orders"), "orders_csv")
    landed = work_path(spark, "bronze")
    land(spark, delivered, landed)
    return source.raw_csv(spark, landed).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _documents_csv(spark, sf_dir):
    """Documents as CSV with doubled quotes: texts hold line breaks, blank lines and quotes."""
    path = work_path(spark, "documents_csv")
    text = F.concat("text", F.lit('\n\n"'), "source", F.lit('"'))
    documents = table(spark, sf_dir, "documents").withColumn("text", text)
    documents.write.option("header", True).option("escape", '"').csv(path)
    return path


def _in_small_ranges(spark):
    """A session that deals files out in ranges of 100 kB, so that many cuts fall into records."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    session.conf.set("spark.sql.files.openCostInBytes", "1k")
    return session


def landing_quoted_breaks(spark, sf_dir):
    """Documents landed in parts cut between records, and read back part by part."""
    landed = work_path(spark, "bronze")
    land(_in_small_ranges(spark), _documents_csv(spark, sf_dir), landed, DOUBLED)
    return source.raw_csv(spark, landed, multi_line=True, quoting=DOUBLED)


def manifest_quoted_breaks(spark, sf_dir):
    """What the manifest says of documents whose records go over several lines."""
    lake, folder = work_path(spark, "lake"), work_path(spark, "delivery")
    rename(spark, _documents_csv(spark, sf_dir), f"{folder}/documents")
    run_bronze(_in_small_ranges(spark), folder, lake, ["documents"], DOUBLED)
    return spark.read.json(f"{lake}/metadata/bronze_manifest").select(
        "table_name", "row_count", "column_count", "blank_line_count", "multi_line", "data_preserved_as_source"
    )


def bronze_job(spark, sf_dir):
    """Three delivered tables checked and landed; the run summary."""
    lake = work_path(spark, "lake")
    return run_bronze(spark, _delivery(spark, sf_dir), lake, SOURCES).drop("error")


def bronze_manifest(spark, sf_dir):
    """Rows and columns of landed tables as the manifest states them."""
    lake = work_path(spark, "lake")
    run_bronze(spark, _delivery(spark, sf_dir), lake, SOURCES)
    return spark.read.json(f"{lake}/metadata/bronze_manifest").select(
        "table_name", "source_file", "row_count", "column_count", "layer",
        "data_preserved_as_source", F.array_join("columns", ",").alias("column_names"),
    )


def report_sink(spark, sf_dir):
    """A sorted one-file report of trips per status, read back."""
    counted = trips(spark, sf_dir).groupBy(F.col("trip_status").alias("table_name")).agg(
        F.count("*").alias("row_count")
    )
    path = work_path(spark, "report")
    write_report(counted, path)
    return source.raw_csv(spark, path).withColumn("row_count", safe_cast("row_count", "bigint"))


QUERIES = {
    f.__name__: f
    for f in (
        csv_scan,
        csv_batches,
        intake_status,
        table_names,
        table_presence,
        bronze_landing,
        landing_quoted_breaks,
        manifest_quoted_breaks,
        bronze_job,
        bronze_manifest,
        report_sink,
    )
}

# Columns of the given tables.
_COLUMNS = {
    "customer": "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment",
    "orders": "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority",
    "lineitem": "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,"
    "l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate",
}

ORACLE = {
    "csv_scan": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "csv_batches": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders",
    "intake_status": """
        SELECT 'full' AS batch,
               CASE WHEN count(*) > 0 THEN 'VALID_DATA' ELSE 'EMPTY_VALID_BATCH' END AS status
        FROM orders
        UNION ALL
        SELECT 'holiday', CASE WHEN count(*) > 0 THEN 'VALID_DATA' ELSE 'EMPTY_VALID_BATCH' END
        FROM orders WHERE o_totalprice < 0
        UNION ALL SELECT 'corrupt', 'SCHEMA_CORRUPTION'""",
    "table_names": r"""
        SELECT p_partkey,
               regexp_replace(trim(lower(' ' || p_type || '-' || p_name || ' (' || p_size || ')')),
                              '\W+', '_', 'g') AS table_name
        FROM part""",
    "table_presence": """
        SELECT coalesce(f.n, w.n) AS table_name,
               CASE WHEN f.n IS NULL THEN 'missing' WHEN w.n IS NULL THEN 'unexpected'
                    ELSE 'present' END AS presence
        FROM (SELECT DISTINCT o_orderstatus AS n FROM orders) f
        FULL JOIN (SELECT l_linestatus AS n FROM lineitem
                   UNION SELECT l_returnflag FROM lineitem) w ON f.n = w.n""",
    "bronze_landing": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority
        FROM orders""",
    "landing_quoted_breaks": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, text || chr(10) || chr(10) || '"' || source || '"' AS text,
               lang, source, CAST(n_chars AS VARCHAR) AS n_chars
        FROM documents""",
    "manifest_quoted_breaks": """
        SELECT 'documents' AS table_name, count(*) AS row_count, 5 AS column_count,
               CAST(0 AS BIGINT) AS blank_line_count, true AS multi_line, true AS data_preserved_as_source
        FROM documents""",
    "bronze_manifest": " UNION ALL ".join(
        f"""
        SELECT '{n}' AS table_name, '{n}' AS source_file, count(*) AS row_count,
               {len(columns.split(","))} AS column_count, 'bronze' AS layer,
               true AS data_preserved_as_source, '{columns}' AS column_names
        FROM {n}"""
        for n, columns in _COLUMNS.items()
    ),
    "bronze_job": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, 'SUCCESS' AS status, count(*) AS row_count, "
        f"{len(columns.split(','))} AS column_count FROM {n}"
        for n, columns in _COLUMNS.items()
    ),
    "report_sink": """
        SELECT l_linestatus AS table_name, count(*) AS row_count FROM lineitem GROUP BY 1""",
}
