"""Versions of a layer: every run writes folders of its own, one small file makes them current.

A run's tables lie below ``<layer>/_runs/<run>`` and nothing ever moves. When all of them are
written, one file ``<layer>/_published/<number>-<run>.json`` names every table's folder; readers
take the last complete one. So a layer changes as a whole or not at all, a failed run leaves the
former tables readable, and an object store has nothing to rename. Two runs that end at the same
time can't both take a number: the second fails and leaves the first one's tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from lakemart.sinks.paths import children, delete, exists, name_of, read_text, write_new

KEPT = 2  # versions that stay for readers and comparisons


@dataclass(frozen=True)
class Version:
    """A published state: where each table lies, and what else its run noted."""

    number: int
    run: str
    published_at: str
    tables: dict[str, dict]

    def text(self) -> str:
        fields = {"run": self.run, "published_at": self.published_at, "tables": self.tables}
        return json.dumps(fields, indent=1, sort_keys=True)


def new_run(layer: str) -> str:
    """The folder for the tables of a run."""
    return f"{layer}/_runs/{uuid.uuid4().hex}"


def versions(spark: SparkSession, layer: str) -> Iterable[Version]:
    """Published states, newest first; files that a crash cut off are passed over."""
    folder = f"{layer}/_published"
    if not exists(spark, folder):
        return
    for path in sorted((p for p in children(spark, folder) if p.endswith(".json")), reverse=True):
        try:
            found = json.loads(read_text(spark, path))
        except ValueError:
            continue
        yield Version(int(name_of(path).removesuffix(".json")), **found)


def current(spark: SparkSession, layer: str) -> Version | None:
    """The state readers see, or None where nothing was published this way."""
    return next(iter(versions(spark, layer)), None)


def publish(
    spark: SparkSession, layer: str, folder: str, tables: dict[str, dict], keep: Iterable[str] = ()
) -> Version:
    """Makes the tables of a run current; tables that it did not build stay as they were.

    States but the last ``KEPT`` and those of the runs in ``keep`` go, with what only they name.
    """
    former = list(versions(spark, layer))
    last = former[0] if former else None
    version = Version(
        last.number + 1 if last else 1,
        name_of(folder),
        datetime.now(timezone.utc).isoformat(timespec="seconds"),
        {**(last.tables if last else {}), **tables},
    )
    # The number alone names the file, so that it can be taken once only.
    write_new(spark, f"{layer}/_published/{version.number:020d}.json", version.text())
    kept = [version, *former[: KEPT - 1], *[v for v in former if v.run in set(keep)]]
    used = {t["run"] for v in kept for t in v.tables.values()}
    for old in former:
        if old not in kept:
            for run in {t["run"] for t in old.tables.values()} - used:
                delete(spark, f"{layer}/_runs/{run}")
            delete(spark, f"{layer}/_published/{old.number:020d}.json")
    return version
