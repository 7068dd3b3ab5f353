"""What the operators leave on disk while they run."""

from __future__ import annotations

from pathlib import Path

from lakemart.llm import common, suffix


def test_passes_of_repeats_leave_only_what_was_found(spark, tmp_path, monkeypatch):
    """Stretches, their kinds and the texts to be cut go as soon as the next pass is written."""
    monkeypatch.setattr(common, "work_path", lambda _, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}"))
    shared = "".join(chr(97 + i * i % 23) for i in range(60))
    texts = [(1, "x" + shared + "one"), (2, "yy" + shared + "two"), (3, "nothing else here" * 3)]
    docs = spark.createDataFrame(texts, "th long, text string")
    runs = suffix.repeated(docs, window=48).collect()
    assert {1, 2} <= {r.th for r in runs}
    left = {Path(p).name.rpartition("-")[0] for p in tmp_path.iterdir() if p.is_dir()}
    assert not left & {"stretches", "kinds", "mixed", "parts", "texts", "shorter"}, left


def test_shuffles_go_with_the_step_that_made_them(spark):
    common.ship(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
