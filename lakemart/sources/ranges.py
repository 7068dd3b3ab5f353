"""Byte ranges of text files: their lines as they are, and what each range holds.

Spark deals files out in ranges and gives each line to the range it starts in. A range does not know
whether it starts inside a quoted field, so it is scanned for both cases. What it finds is a
function from the state at its start to the state at its end with counts for each; such functions
combine associatively, which gives every range its state, true record counts, and places between
records where a file may be cut. Checksums combine likewise: a CRC-32 of each range and its length
give the file's. Nothing is parsed into fields, and no byte is changed: lines end at ``\\n`` only.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK = 64 << 20  # bytes that a task should have at least
PARTS, PART = 64, 128 << 20  # parts that a file is cut into by its ranges alone; bytes of a larger one
GROUPS = 64  # groups that files are put together in
BOM = b"\xef\xbb\xbf"  # left out by the line reader at the start of a file

SCANNED = (
    "file string, start long, size long, lines long, bytes long, crc long, bare long, "
    "header binary, ends array<boolean>, records array<long>, blanks array<long>, lead long"
)
RANGES = (
    "file string, start long, size long, lines long, records long, blanks long, header binary, crc long, "
    "part long, lead long, bom boolean, open boolean, odd boolean"
)


@dataclass(frozen=True)
class Quoting:
    """How fields are written; an escape equal to the quote means doubled quotes only."""

    sep: str = ","
    quote: str = '"'
    escape: str = "\\"


def lines(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """(file, start, size, line): the bytes of each line, in order within a range."""
    found = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(source)
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("line"),
    )


def packed(df: DataFrame) -> DataFrame:
    """The same rows in tasks of about 64 MB where ranges are small; a task has whole ranges, in order.

    A task costs more than a small range, and with a task for each, what every task is told of all
    ranges would be told again for each of them.
    """
    spark, ranges = df.sparkSession, df.rdd.getNumPartitions()
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.coalesce(max(ranges * size // TASK, 4 * spark.sparkContext.defaultParallelism))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes]]]:
    """((file, start, size), lines) of consecutive rows of one range."""
    for batch in batches:
        files, starts = batch.column("file"), batch.column("start").to_numpy()
        changed = np.flatnonzero(np.diff(starts)) + 1
        same = np.setdiff1d(np.arange(1, len(starts)), changed)
        if len(same):  # equal starts of different files
            other = pa.compute.not_equal(files.take(same), files.take(same - 1)).to_numpy(False)
            changed = np.union1d(changed, same[other.astype(bool)])
        bounds = [0, *changed.tolist(), len(starts)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b > a:
                key = files[a].as_py(), int(starts[a]), batch.column("size")[a].as_py()
                yield key, batch.column("line").slice(a, b - a).to_pylist()


def ends_inside(line: bytes, inside: bool, quoting: tuple[bytes, bytes, bytes]) -> bool:
    """Whether the end of a line lies in a quoted field. Quotes count at the start of a field only."""
    sep, quote, escape = quoting
    at = 0
    while True:
        if not inside:
            if line[at : at + len(quote)] == quote:
                inside, at = True, at + len(quote)
                continue
        while inside:
            close = line.find(quote, at)
            skip = line.find(escape, at, close if close >= 0 else len(line)) if escape != quote else -1
            if skip >= 0:
                at = skip + len(escape) + 1
            elif close < 0:
                return True
            elif line.startswith(quote, close + len(quote)):
                at = close + 2 * len(quote)
            else:
                inside, at = False, close + len(quote)
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


class Range:
    """What the lines of one range add up to, for a start outside and inside a quoted field."""

    def __init__(self, key: tuple, quoting: tuple[bytes, bytes, bytes]):
        self.key, self.quoting = key, quoting
        self.lines = self.bytes = self.crc = self.bare = self.lead = 0
        self.header, self.headed, self.leading = [], False, True
        self.ends, self.records, self.blanks = [False, True], [0, 0], [0, 0]

    def add(self, found: list[bytes]) -> None:
        data = b"\n".join(found)
        self.bare = zlib.crc32(data, self.crc)
        self.crc = zlib.crc32(b"\n", self.bare)
        blank = np.fromiter((x in (b"", b"\r") for x in found), bool, len(found))
        quoted = [i for i, x in enumerate(found) if self.quoting[1] in x] if self.quoting[1] in data else []
        for case in (0, 1):
            # the state before each line and after the last; lines without quotes keep it
            state = np.empty(len(found) + 1, bool)
            state[0], at = self.ends[case], 0
            for i in quoted:
                state[at : i + 1] = state[at]
                state[i + 1] = ends_inside(found[i], bool(state[i]), self.quoting)
                at = i + 1
            state[at:] = state[at]
            self.ends[case] = bool(state[-1])
            self.records[case] += int((~state[1:]).sum())
            self.blanks[case] += int((blank & ~state[:-1]).sum())
            whole = np.flatnonzero(~state[1:])
            first = int(whole[0]) + 1 if len(whole) else len(found)
            if case and self.leading:
                self.lead += first
                self.leading = not len(whole)
            if not case and not self.headed:
                self.header += found[:first]
                self.headed = len(whole) > 0
        self.lines += len(found)
        self.bytes += len(data) + 1

    def row(self) -> dict:
        header = b"\n".join(self.header) if not self.key[1] else None
        return dict(zip(("file", "start", "size"), self.key, strict=True)) | {
            "lines": self.lines,
            "bytes": self.bytes,
            "crc": self.crc,
            "bare": self.bare,
            "header": header,
            "ends": self.ends,
            "records": self.records,
            "blanks": self.blanks,
            "lead": self.lead,
        }


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the one of CRC-32, in its reflected form."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)  # fixed value: the polynomial
    return out


def crc_of_both(a: int, b: int, length: int) -> int:
    """CRC-32 of two strings put together, from those of each and the second one's length."""
    power, square, n = 0x80000000, 0x00800000, length  # x ** 0 and x ** 8
    while n:
        if n & 1:
            power = _times(power, square)
        square, n = _times(square, square), n >> 1
    return _times(a, power) ^ b


def combined(found: pd.DataFrame) -> pd.DataFrame:
    """The ranges of some files with the counts that hold; a file's checksum is at its last.

    A file is cut into parts at ranges, a range's first ``lead`` lines going to an earlier ``part``
    if it starts inside a record. ``odd`` says that the part that starts with the range gets such
    lines, or starts with a byte order mark, or ends without a line end (``open``). Of a file with
    more than PARTS ranges several make up one part, up to PART bytes: files cost more than their bytes.
    """
    rows: list[dict] = []
    for _, own in groupby(found.sort_values(["file", "start"]).itertuples(index=False), lambda r: r.file):
        rows += _combined(list(own))
    out = pd.DataFrame(rows)
    return out.assign(crc=out.crc.astype("Int64"))


def _combined(found: list) -> list[dict]:
    size, total = int(found[0].size), sum(int(r.bytes) for r in found)
    ends = {0: (False, False), 1: (False, True), -3: (True, False), -2: (True, True)}
    if total - size not in ends:
        raise ValueError(f"{found[0].file}: {total} bytes read of {size}")
    bom, open_ = ends[total - size]
    inside, part, odd = False, int(found[0].start), set()
    step = max(1, min(-(-len(found) // PARTS), PART * len(found) // max(size, 1)))
    crc, rows = (zlib.crc32(BOM) if bom else 0), []
    if bom:
        odd.add(part)
    for number, r in enumerate(found):
        final, case = number == len(found) - 1, int(inside)
        bare = final and open_
        crc = crc_of_both(crc, r.bare if bare else r.crc, int(r.bytes) - bare)
        lead = r.lines if number % step else int(r.lead) if inside else 0
        if lead:
            odd.add(part)
        row = {"file": r.file, "start": r.start, "size": size, "lines": r.lines, "header": r.header}
        row |= {"part": part if lead else int(r.start), "lead": lead, "bom": bom and not number, "open": bare}
        if lead < r.lines:
            part = int(r.start)
        inside = bool(r.ends[case])
        # a record that the end of the file cuts off is one, too
        row |= {"records": r.records[case] + (final and inside), "blanks": r.blanks[case]}
        rows.append(row | {"crc": crc if final else None})
    if open_:
        odd.add(part)
    return [row | {"odd": row["start"] in odd} for row in rows]


def scan(spark: SparkSession, source: str | list[str], quoting: Quoting = Quoting()) -> DataFrame:
    """(RANGES) one row per byte range of the files that has lines; one pass over their bytes."""
    marks = tuple(x.encode() for x in (quoting.sep, quoting.quote, quoting.escape))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for key, found in runs(batches):
            if own is None or own.key != key:
                if own is not None:
                    yield pa.RecordBatch.from_pylist([own.row()], schema=kind)
                own = Range(key, marks)
            own.add(found)
        if own is not None:
            yield pa.RecordBatch.from_pylist([own.row()], schema=kind)

    kind = pa.schema(
        [
            ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("lines", pa.int64()),
            ("bytes", pa.int64()), ("crc", pa.int64()), ("bare", pa.int64()),
            ("header", pa.binary()), ("ends", pa.list_(pa.bool_())), ("records", pa.list_(pa.int64())),
            ("blanks", pa.list_(pa.int64())), ("lead", pa.int64()),
        ]
    )
    group = F.pmod(F.xxhash64("file"), F.lit(GROUPS))  # files of a group share one call
    return packed(lines(spark, source)).mapInArrow(count, SCANNED).groupBy(group).applyInPandas(combined, RANGES)


# Tasks get these functions with the job, so a cluster needs no copy of the library for them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
