"""Folder operations through Hadoop's file system, for any storage Spark can write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm = _open(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Full paths directly below ``path``."""
    fs, jvm = _open(spark, path)
    return sorted(
        s.getPath().toString() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path))
    )


def name_of(path: str) -> str:
    """Last component of a path."""
    return path.rstrip("/").rsplit("/", 1)[-1]


def delete(spark: SparkSession, path: str) -> None:
    fs, jvm = _open(spark, path)
    fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    fs, jvm = _open(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(path))
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that must not exist yet."""
    fs, jvm = _open(spark, path)
    stream = fs.create(jvm.org.apache.hadoop.fs.Path(path), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, jvm = _open(spark, target)
    path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(target).getParent())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"could not rename {source} to {target}")


def staging_path(target: str) -> str:
    """A sibling of ``target`` (same file system) that readers of tables ignore."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_staging_{name}_{uuid.uuid4().hex}"


def _previous(target: str) -> str:
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_previous_{name}"


def parked(table: str) -> str:
    """Folder next to ``table`` where old partitions wait; inside, readers would find them."""
    parent, _, name = table.rstrip("/").rpartition("/")
    return f"{parent}/_previous_partitions_{name}"


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Finish partition swaps that died: old versions without a new one come back."""
    aside = parked(table)
    if exists(spark, aside):
        for old in children(spark, aside):
            recover(spark, f"{table}/{name_of(old)}", old)
        delete(spark, aside)


def recover(spark: SparkSession, target: str, previous: str | None = None) -> None:
    """Finish a swap that died between its two renames: bring the old version back."""
    previous = previous or _previous(target)
    if exists(spark, previous) and not exists(spark, target):
        rename(spark, previous, target)


def swap_in(spark: SparkSession, staged: str, target: str, previous: str | None = None) -> None:
    """Put a completely written folder in the place of ``target``.

    The old version is moved aside first and dropped last, so that at any moment one
    complete version exists. Two renames are atomic each, not together: readers that
    need isolation should use a catalog table (see ``tables.create_or_replace``).
    ``previous`` is where the old version waits, by default next to ``target``.
    """
    previous = previous or _previous(target)
    recover(spark, target, previous)
    if exists(spark, previous):
        delete(spark, previous)
    if exists(spark, target):
        rename(spark, target, previous)
    rename(spark, staged, target)
    if exists(spark, previous):
        delete(spark, previous)
