"""Landing raw files in Bronze byte by byte, and describing them in a manifest."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import work_path
from lakemart.sinks.paths import delete, staging_path, swap_in
from lakemart.sources.ranges import BOM, Quoting, crc_of_both, lines, packed, runs, scan
from lakemart.sources.raw import raw_csv

MANIFEST_SCHEMA = (
    "table_name string, source_file string, bronze_file string, source_file_size_bytes long, "
    "row_count long, column_count int, columns array<string>, blank_line_count long, "
    "multi_line boolean, data_preserved_as_source boolean"
)
SUMMARY_SCHEMA = "table_name string, status string, row_count long, column_count int, error string"
ODD = 1_000_000  # ranges that need a treatment of their own, known to every task


@dataclass(frozen=True)
class Landed:
    """What a delivery held: records without the headers and blank lines, and whether it arrived unchanged."""

    rows: int
    blanks: int
    bytes: int
    multi_line: bool
    preserved: bool


def _pieces(rules: dict, header: bytes, want: bool):
    """A function of tasks: the lines of plain parts, or those of odd ones (``want``), as large strings.

    The last line end of each string is left to the writer. A part that does not start its file gets
    the header in front.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, 0
        for (file, start, _), found in runs(batches):
            at = at if last == (file, start) else 0
            last = file, start
            rule = rules.get(last, {"lead": 0, "odd": False, "bom": False})
            lead = min(max(rule["lead"] - at, 0), len(found))
            rows = []
            if lead and want:
                rows.append((rule["part"], b"\n".join(found[:lead])))
            if lead < len(found) and want == rule["odd"]:
                front = b""
                if at <= rule["lead"]:  # the first lines of the part
                    front = (BOM if rule["bom"] else b"") + (header + b"\n" if start else b"")
                rows.append((start, front + b"\n".join(found[lead:])))
            for part, data in rows:
                values = [[file], [part], [start], [at], [data]]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["file", "part", "start", "at", "data"])
            at += len(found)

    return cut


def _whole(open_: set):
    """The pieces of one part put together; its last character apart, for the writer to add."""

    def put_together(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["start", "at"])
        key = group.file.iloc[0], int(group.part.iloc[0])
        data = b"\n".join(group.data) + (b"" if key in open_ else b"\n")
        size = next((n for n in (1, 2, 3, 4) if n <= len(data) and data[-n] & 0xC0 != 0x80), 1)
        try:
            tail = data[-size:].decode()
        except UnicodeDecodeError:
            raise ValueError(f"{key[0]}: the last character is no UTF-8") from None
        return pd.DataFrame({"file": [key[0]], "part": [key[1]], "data": [data[:-size]], "tail": [tail]})

    return put_together


def _copy(spark: SparkSession, ranges: DataFrame, source: str, header: bytes, staged: str) -> None:
    """Writes the parts of every file, cut between records, as ``staged``/file=<name>/start=<place>.

    A part that lies in one range and ends with a line end is written by the task that reads it. Odd
    ones are put together first; as large as a range, each is written with its last character as
    the writer's line end, as nothing else would follow its last byte.
    """
    odd = ranges.where("odd or lead > 0").select("file", "start", "part", "lead", "bom", "open", "odd")
    odd = odd.limit(ODD + 1).collect()
    if len(odd) > ODD:
        raise ValueError(f"{source}: more than {ODD} ranges need to be put together; deliver less at once")
    rules = {(r.file, r.start): r.asDict() for r in odd}
    path, kind = source.rstrip("/"), "file string, part long, start long, at long, data binary"
    below = F.substring_index("file", f"{path}/", -1)
    name = F.when(F.endswith("file", F.lit(path)), F.substring_index("file", "/", -1)).otherwise(below)

    def write(pieces: DataFrame, tail: str) -> None:
        rows = pieces.select(
            F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("file"), F.col("part").alias("start"), "at", F.col("data").cast("string").alias("value")
        )
        # A task writes many parts, each in order; nobody sees them yet, so tasks may put them in place.
        rows = rows.sortWithinPartitions("file", "start", "at").drop("at")
        writer = rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.option("lineSep", tail).partitionBy("file", "start").text(staged)

    write(packed(lines(spark, source)).mapInArrow(_pieces(rules, header, False), kind), "\n")
    if not odd:
        return
    ends = {r.file: r.part if 0 < r.lead and not r.odd else r.start for r in odd if r.open}
    files = sorted({unquote(r.file) for r in odd})  # names are given in their encoded form
    pieces = packed(lines(spark, files)).mapInArrow(_pieces(rules, header, True), kind)
    parts = pieces.groupBy("file", "part").applyInPandas(
        _whole(set(ends.items())), "file string, part long, data binary, tail string"
    )
    path_of_parts = work_path(spark, "odd_parts")
    parts.write.parquet(path_of_parts)
    parts = packed(spark.read.parquet(path_of_parts).withColumn("at", F.lit(0)))
    for row in parts.select("tail").distinct().collect():
        write(parts.where(F.col("tail") == row.tail), row.tail)
    delete(spark, path_of_parts)


def _files(ranges: DataFrame) -> DataFrame:
    """(size, crc) of the files that the landed parts came from."""

    def fold(parts: pd.DataFrame) -> pd.DataFrame:
        size = crc = 0
        for r in parts.sort_values("start").itertuples(index=False):
            own, length = int(r.crc), int(r.size)
            if r.start:  # without the header in front
                length -= len(r.header) + 1
                own ^= crc_of_both(zlib.crc32(r.header + b"\n"), 0, length)
            crc, size = crc_of_both(crc, own, length), size + length
        return pd.DataFrame({"size": [size], "crc": [crc]})

    parts = ranges.groupBy("file", "size").agg(F.max("crc").alias("crc"), F.max("header").alias("header"))
    place = parts.select(
        F.regexp_extract("file", r"/file=([^/]*)/", 1).alias("name"),
        F.regexp_extract("file", r"/start=(\d+)/", 1).cast("long").alias("start"),
        "size", "crc", "header",
    )
    return place.groupBy("name").applyInPandas(fold, "size long, crc long")


def land(spark: SparkSession, source: str, target: str, quoting: Quoting = Quoting()) -> Landed:
    """Copy a raw CSV file or folder, byte by byte and unparsed, into the folder ``target``.

    A file lands as ``file=<name>/start=<place>``: one part for each byte range that Spark deals out (for
    several, if a file has more than ``ranges.PARTS``), cut between records, so quoted line breaks, blank lines and any other bytes stay as they are and
    parts can be read side by side. Parts that do not start their file have its header in front;
    without it the parts in order are the file. That is checked by reading them back before they
    take the place of an earlier landing. Files of one delivery must share their header.
    """
    found = work_path(spark, "ranges")
    scan(spark, source, quoting).write.parquet(found)
    ranges = spark.read.parquet(found)
    headers = [r.header for r in ranges.where("start = 0").select("header").distinct().limit(2).collect()]
    if not headers or not headers[0].strip():
        raise ValueError(f"{source}: no header")
    if len(headers) > 1:
        raise ValueError(f"{source}: the header does not conform in all files")
    whole = F.col("crc").isNotNull()  # at one range of each file
    records, blanks, held, files, size = ranges.agg(
        F.sum("records"), F.sum("blanks"), F.sum("lines"), F.count_if(whole), F.sum(F.when(whole, F.col("size")))
    ).first()
    staged = staging_path(target)
    try:
        _copy(spark, ranges, source, headers[0], staged)
        before = ranges.where("crc is not null").select("size", "crc", F.lit(1).alias("sign"))
        after = _files(scan(spark, staged, quoting)).select("size", "crc", F.lit(-1).alias("sign"))
        # both hold the same files as often; what landed is read back once
        odds = before.union(after).groupBy("size", "crc").agg(F.sum("sign").alias("n")).where("n <> 0")
        preserved = odds.isEmpty()
    except Exception:
        delete(spark, staged)
        raise
    swap_in(spark, staged, target)
    delete(spark, found)
    return Landed(records - blanks - files, blanks, size, records != held, preserved)


def manifest_row(
    spark: SparkSession,
    table: str,
    source_name: str,
    size: int,
    bronze: str,
    landed: Landed,
    quoting: Quoting = Quoting(),
) -> tuple:
    """Description of one landed delivery."""
    columns = raw_csv(spark, bronze, landed.multi_line, quoting=quoting).columns
    return (
        table, source_name, bronze, size, landed.rows, len(columns), columns, landed.blanks,
        landed.multi_line, landed.preserved and landed.bytes == size,
    )


def manifest(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Manifest rows as a frame, stamped with the ingestion time."""
    return spark.createDataFrame(list(rows), MANIFEST_SCHEMA).select(
        "table_name",
        "source_file",
        "bronze_file",
        F.current_timestamp().alias("ingestion_timestamp_utc"),
        "source_file_size_bytes",
        "row_count",
        "column_count",
        "columns",
        "blank_line_count",
        "multi_line",
        F.lit("bronze").alias("layer"),
        "data_preserved_as_source",
    )


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON, one folder per table; the tables of earlier runs stay."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_name")
        .json(path)
    )


# Tasks get these functions with the job, so a cluster needs no copy of the library for them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
