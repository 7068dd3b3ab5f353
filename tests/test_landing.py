"""Byte-true landing: odd bytes, cuts inside records, counts and checksums."""

from __future__ import annotations

import csv
import io
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.plans.bronze import run_bronze
from lakemart.sinks import landing
from lakemart.sinks.landing import land
from lakemart.sources import ranges
from lakemart.sources.ranges import Quoting
from lakemart.sources.raw import raw_csv, read_bronze

DOUBLED = Quoting(escape='"')
MARKS = (b",", b'"', b'"')


@pytest.fixture
def small(spark):
    """A session that cuts files into ranges of 300 bytes."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "300")
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    return session


def delivered(case: int) -> tuple[bytes, bytes, list]:
    """(header, file, records) with line breaks, quotes and control characters in fields."""
    rnd, end = random.Random(case), "\n" if case % 2 else "\r\n"
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=end)
    writer.writerow(["id", 'te,"x\nt' if case % 3 == 0 else "text", "c"])
    header = text.getvalue().encode()
    for i in range(60):
        parts = ["a", '"', "\n", ",", "é", "\n\n", "b c", "\x01", "\x00", "x" * 30]
        writer.writerow([i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(25))), "z"])
        if i % 17 == 0:
            text.write(end)
    data = text.getvalue()
    if case >= 2:
        data = data.rstrip("\r\n")
    data = ("﻿" if case == 4 else "") + data
    rows = list(csv.reader(io.StringIO(data.removeprefix("﻿"), newline="")))
    return header, data.encode(), [r for r in rows[1:] if r]


def parts_of(target, name: str) -> list[bytes]:
    folder = target / f"file={name}"
    starts = sorted(folder.iterdir(), key=lambda p: int(p.name.removeprefix("start=")))
    return [next(p.glob("part-*")).read_bytes() for p in starts]


@pytest.mark.parametrize("case", range(6))
def test_files_land_byte_by_byte(small, tmp_path, case):
    header, data, records = delivered(case)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a+b c.csv").write_bytes(data)
    (tmp_path / "in" / "d.csv").write_bytes(header + b'1,"\n\n",2\n')
    for _ in range(2):  # landing again replaces
        landed = land(small, str(tmp_path / "in"), str(tmp_path / "out"), DOUBLED)
    assert landed.preserved and landed.multi_line
    assert landed.rows == len(records) + 1 and landed.blanks == 4
    first, *rest = parts_of(tmp_path / "out", "a+b c.csv")
    assert len(rest) > 3 and all(p.startswith(header) for p in rest)
    assert first + b"".join(p[len(header) :] for p in rest) == data
    for part in [first, *rest]:  # cut between records
        found = list(csv.reader(io.StringIO(part.decode("utf-8-sig"), newline="")))
        assert all(len(r) in (0, 3) for r in found)


def test_landed_parts_read_as_the_source(small, tmp_path):
    _, data, records = delivered(1)
    (tmp_path / "in.csv").write_bytes(data.replace(b"\x00", b"0"))
    land(small, str(tmp_path / "in.csv"), str(tmp_path / "out"), DOUBLED)
    got = raw_csv(small, str(tmp_path / "out"), True, quoting=DOUBLED)
    assert got.rdd.getNumPartitions() > 3
    assert sorted((r.id, r.text) for r in got.collect()) == sorted(
        (r[0], r[1].replace("\x00", "0") or None) for r in records
    )


def test_one_record_over_many_ranges(small, tmp_path):
    data = b'a,b\n1,"' + b"x\n" * 2000 + b'"\n2,y'
    (tmp_path / "in.csv").write_bytes(data)
    landed = land(small, str(tmp_path / "in.csv"), str(tmp_path / "out"), DOUBLED)
    first, *rest = parts_of(tmp_path / "out", "in.csv")
    assert first + b"".join(p.removeprefix(b"a,b\n") for p in rest) == data
    assert (landed.rows, landed.preserved) == (2, True)


def test_files_of_headers_only_and_cut_records(small, tmp_path):
    (tmp_path / "in.csv").write_bytes(b"a,b")
    assert land(small, str(tmp_path / "in.csv"), str(tmp_path / "out")).rows == 0
    assert parts_of(tmp_path / "out", "in.csv") == [b"a,b"]
    (tmp_path / "in.csv").write_bytes(b'a,b\n1,"cut\noff\n')
    assert land(small, str(tmp_path / "in.csv"), str(tmp_path / "out")).rows == 1
    (tmp_path / "in.csv").write_bytes(b"a,b\n1,\xe9")
    with pytest.raises(Exception, match="no UTF-8"):
        land(small, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    assert len(parts_of(tmp_path / "out", "in.csv")) == 1  # the landing before stays


def test_a_changed_copy_is_told(small, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_bytes(b"a,b\n" + b"1,2\n" * 200)
    copy = landing._copy

    def spoiled(spark, found, source, header, staged):
        copy(spark, found, source, header, staged)
        part = next((tmp_path / staged.rsplit("/", 1)[1]).rglob("part-*"))
        part.write_bytes(part.read_bytes().replace(b"1,2", b"1,3", 1))
        for crc in part.parent.glob(".*.crc"):
            crc.unlink()

    monkeypatch.setattr(landing, "_copy", spoiled)
    assert not land(small, str(tmp_path / "in.csv"), str(tmp_path / "out")).preserved


def test_manifest_and_bronze_of_several_lines(small, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "notes.csv").write_bytes(b'id,text\n1,"a\n\n""b"""\n\n2,c\n')
    (tmp_path / "in" / "plain.csv").write_bytes(b"id\n1\n")
    lake = str(tmp_path / "lake")
    summary = run_bronze(small, str(tmp_path / "in"), lake, ["notes"], DOUBLED)
    assert {(r.table_name, r.status, r.row_count) for r in summary.collect()} == {
        ("notes", "SUCCESS", 2), ("plain", "SUCCESS", 1)
    }
    rows = {r.table_name: r for r in small.read.json(f"{lake}/metadata/bronze_manifest").collect()}
    assert (rows["notes"].blank_line_count, rows["notes"].multi_line) == (1, True)
    assert rows["notes"].data_preserved_as_source and not rows["plain"].multi_line
    got = read_bronze(small, lake, "notes", quoting=DOUBLED).collect()
    assert sorted(map(tuple, got)) == [("1", 'a\n\n"b"'), ("2", "c")]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='",\nx ', max_size=40))
def test_states_equal_the_csv_reader(text):
    state, records = False, 0
    for line in text.encode().split(b"\n"):
        state = ranges.ends_inside(line, state, MARKS)
        records += not state
    want = list(csv.reader(io.StringIO(text + "\n", newline="")))
    assert records + state == len(want)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=3000))
def test_checksums_combine(a, b):
    assert ranges.crc_of_both(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='",x', max_size=6), min_size=1, max_size=12), st.integers(0, 11))
def test_ranges_combine(found, cut):
    """Two ranges put together say what one does, for a start outside a record."""
    found = [x.encode() for x in found]
    cut = min(cut, len(found))

    def over(lines, start):
        own = ranges.Range(("f", start, 0), MARKS)
        for i in range(0, len(lines), 3):
            own.add(lines[i : i + 3])
        return own

    whole, a, b = over(found, 0), over(found[:cut], 0), over(found[cut:], 1)
    case = int(a.ends[0])
    assert whole.ends[0] == b.ends[case]
    assert whole.records[0] == a.records[0] + b.records[case]
    assert whole.blanks[0] == a.blanks[0] + b.blanks[case]
    assert whole.bytes == a.bytes + b.bytes and whole.crc == ranges.crc_of_both(a.crc, b.crc, b.bytes)
    if cut < len(found):
        state = [False]
        for line in found:
            state.append(ranges.ends_inside(line, state[-1], MARKS))
        after = [k + 1 for k, s in enumerate(state[cut + 1 :]) if not s]
        if case:
            assert b.lead == (after[0] if after else len(found) - cut)
