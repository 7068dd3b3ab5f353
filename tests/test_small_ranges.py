"""Landing in very many small ranges: tasks and parts grow with the bytes, not with the ranges."""

from __future__ import annotations

from lakemart.sinks.landing import land
from lakemart.sources import ranges
from lakemart.sources.ranges import Quoting


def test_many_small_ranges_make_few_tasks_and_parts(spark, tmp_path):
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "100")
    small.conf.set("spark.sql.files.openCostInBytes", "1")
    record = 'n,"line\n\nof ""some"" text\n"\n'
    data = "id,text\n" + record * 500 + 'last,"cut\noff"'
    (tmp_path / "in.csv").write_bytes(data.encode())
    source = ranges.lines(small, str(tmp_path / "in.csv"))
    assert source.rdd.getNumPartitions() > 100
    assert ranges.packed(source).rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    landed = land(small, str(tmp_path / "in.csv"), str(tmp_path / "out"), Quoting(escape='"'))
    assert (landed.rows, landed.preserved, landed.multi_line) == (501, True, True)
    parts = sorted((tmp_path / "out").rglob("part-*"), key=lambda p: int(p.parent.name.removeprefix("start=")))
    assert 3 < len(parts) <= ranges.PARTS
    header = b"id,text\n"
    texts = [p.read_bytes() for p in parts]
    assert all(t.startswith(header) and (t.endswith(b'"\n') or t is texts[-1]) for t in texts)
    assert texts[0] + b"".join(t[len(header) :] for t in texts[1:]) == data.encode()
