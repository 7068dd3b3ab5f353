"""Merkle manifest of a table: one root for all rows, a proof for each.

A leaf is H of the row's values, H being the lowercase hex SHA-256 of its inputs put together
(digests as hex text). The leaves of a group ascend by id; runs of ``arity`` neighbours become one
node, level by level (a last run may be shorter, even one node), until one is left: the group's
subroot, which for a single leaf is the leaf. The subroots, in the order of their groups, are the
leaves of a second tree of the same kind, whose last node is the root.

Checkpoint and recompute: of each tree only every ``step``-th level is written, as rows that hold
the stored nodes of one aligned subtree. To extract proofs, the subtrees are visited from the top
down. Each regenerates its missing interior nodes from its stored descendants, hands every stored
child the siblings met on the way up from it, followed by those its own top was given, and forgets
the interior. A node that is its run's only one has no sibling at that level.

Scale: rows are dealt by ranges of (group, id), numbered within a range, and the counts of the
ranges (one row per range and group) give places, so neither a group that holds most rows nor one
with a single row matters. A subtree holds ``arity ** step`` nodes at most, whatever the group.
Only digests and keys are shuffled; the number of rounds is the logarithm of the largest group to
the base ``arity ** step``. What is written lies in the shared folder, so a lost executor costs its
tasks only; the table of the leaves is read twice, the others once.

A null value is ``-`` in its leaf. Null groups and null ids come first, groups and ids of text
ascend by their UTF-8 bytes. Rows of equal id follow each other by their leaf; rows that are equal
as a whole stand side by side, each with a proof of its own. An empty table has no rows and no
root. Columns other than those named are not part of a leaf and not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import ship, small_join, tag, udf, written

STEP = 8  # levels between two that are written
ARITY = 2


def digest(*inputs: str) -> str:
    """H of the inputs."""
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(columns: Sequence[Column]) -> Column:
    """H over the values, each as its length in bytes, ``:`` and itself, or ``-``."""
    parts = []
    for column in columns:
        value = column.cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _up(held: int, arity: int, step: int) -> int:
    """Levels above the stored nodes of a subtree, of ``held`` in the whole group, up to ``step``."""
    levels = 0
    while held > 1 and levels < step:
        held, levels = -(-held // arity), levels + 1
    return levels


def _levels(nodes: Sequence[str], count: int, arity: int) -> list[list[str]]:
    """The nodes of a subtree: the stored ones and ``count`` levels above them."""
    levels = [list(nodes)]
    for _ in range(count):
        low = levels[-1]
        levels.append([digest(*low[i : i + arity]) for i in range(0, len(low), arity)])
    return levels


def _sides(levels: list[list[str]], at: int, arity: int) -> str:
    """The siblings on the way up from a node: per level left ones, ``*``, right ones, ``,``."""
    sides = []
    for level in levels[:-1]:
        start = at - at % arity
        sides += ["".join(level[start:at]), "*", "".join(level[at + 1 : start + arity]), ","]
        at //= arity
    return "".join(sides)


def fold(node: str, sides: str) -> str:
    """The root that a node and its siblings lead to."""
    for level in sides.split(",")[:-1]:
        left, right = level.split("*")
        node = digest(left, node, right)
    return node


def siblings(sides: str) -> str:
    """The siblings alone, level by level and from the left to the right."""
    return sides.replace(",", "").replace("*", "")


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, how many rows of the same ``group`` stand before, and ``held``, all of them.

    The ranges are written with their row numbers, so all later reads agree on the places.
    """
    ranged = written(
        rows.repartitionByRange("group", *order)
        .sortWithinPartitions("group", *order)
        .select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")),
        "ranges",
    )
    whole = Window.partitionBy("group")  # one row per range
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("group", "range").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    counts = counts.select(
        "group",
        "range",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("held"),
    )
    joined = small_join(ranged, written(counts, "counts"), ["group", "range"])
    return joined.withColumn("place", F.col("at") + F.col("shift")).drop("range", "at", "shift")


class Tree:
    """The trees of all groups over rows (``group``, ``held``, ``place``, ``node``, ``payload``).

    ``payload`` goes along with a leaf. Each entry of ``stored`` is a written level: one row per
    aligned subtree, with its nodes in order and how many the group has at this level (``held``).
    """

    def __init__(self, rows: DataFrame, arity: int, step: int):
        self.arity, self.step = arity, step
        width = arity**step
        ship(rows.sparkSession)

        def top(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for nodes, held in batches:
                pairs = zip(nodes, held, strict=True)
                yield pd.Series([_levels(n, _up(h, arity, step), arity)[-1][0] for n, h in pairs], dtype=object)

        self.stored: list[DataFrame] = []
        subroots = []
        nodes = rows.select("group", "held", "place", F.struct("place", "node", "payload").alias("entry"))
        held = rows.agg(F.max("held")).first()[0] or 0
        while held > 1 or not self.stored:
            subtrees = nodes.groupBy("group", "held", F.expr(f"place div {width}").alias("block"))
            subtrees = subtrees.agg(F.sort_array(F.collect_list("entry")).alias("entries"))
            self.stored.append(written(subtrees, "level"))
            folded = self.stored[-1].select(
                "group",
                F.expr(f"(held + {width - 1}) div {width}").alias("held"),
                F.col("block").alias("place"),
                udf(top, "string")("entries.node", "held").alias("node"),
            )
            level = F.lit(len(self.stored) - 1).alias("level")
            subroots.append(folded.where("held = 1").select("group", F.col("node").alias("subroot"), level))
            nodes = folded.where("held > 1").select("group", "held", "place", F.struct("place", "node").alias("entry"))
            held = -(-held // width)
        #: One row per group, with the stored level that its last subtree belongs to.
        self.subroots = written(reduce(DataFrame.unionByName, subroots), "subroots")

    def proofs(self, given: DataFrame, schema: str, finish) -> DataFrame:
        """What ``finish`` makes of each leaf: (group, its subroot, node, payload, siblings) to a tuple.

        ``given`` holds the columns of ``subroots`` and the siblings ``above`` each.
        """

        def tops(level: int) -> DataFrame:
            found = given.where(F.col("level") == level)
            return found.select("group", F.lit(0).cast("long").alias("block"), "subroot", "above")

        last = len(self.stored) - 1
        above = tops(last)
        for level in range(last, 0, -1):
            below = self._expanded(
                self.stored[level],
                above,
                "group string, block long, subroot string, above string",
                lambda group, subroot, entry, sides: (group, entry["place"], subroot, sides),
            )
            above = written(below, "paths").unionByName(tops(level - 1))
        return self._expanded(
            self.stored[0],
            above,
            schema,
            lambda group, subroot, entry, sides: finish(group, subroot, entry["node"], entry["payload"], sides),
        )

    def _expanded(self, subtrees: DataFrame, above: DataFrame, schema: str, row) -> DataFrame:
        """One row per stored node of each subtree; interior nodes live in this function only."""
        arity, step = self.arity, self.step
        names = [c.split()[0] for c in schema.split(", ")]

        def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for group, held, entries, subroot, sides in batch.itertuples(index=False):
                    levels = _levels([e["node"] for e in entries], _up(held, arity, step), arity)
                    rows = [
                        row(group, subroot, entry, _sides(levels, at, arity) + sides)
                        for at, entry in enumerate(entries)
                    ]
                    yield pd.DataFrame(rows, columns=names, dtype=object)

        joined = subtrees.join(above, ["group", "block"])
        return joined.select("group", "held", "entries", "subroot", "above").mapInPandas(expand, schema)


class Manifest:
    """The trees of a table's groups, and the tree of their subroots with the ``root``.

    ``columns`` make up a leaf; ``extra`` is a text column that ``proofs`` hands on. ``group`` is text.
    """

    def __init__(
        self,
        docs: DataFrame,
        columns: Sequence[str],
        doc_id: str = "doc_id",
        group: str = "lang",
        extra: Column | None = None,
        arity: int = ARITY,
        step: int = STEP,
    ):
        self.id_type = docs.schema[doc_id].dataType.simpleString()
        extra = F.lit(None) if extra is None else extra
        rows = written(
            docs.select(
                tag(F.col(group).cast("string")).alias("group"),
                F.col(doc_id).alias("id"),
                leaf([F.col(c) for c in columns]).alias("node"),
                F.monotonically_increasing_id().alias("tie"),  # spreads rows that are equal
                # ids travel as text: as numbers in lists they would pass through floats beside nulls
                F.struct(F.col(doc_id).cast("string").alias("id"), extra.cast("string").alias("extra")).alias("payload"),
            ),
            "leaves",
        )
        self.leaves = Tree(_placed(rows, ["id", "node", "tie"]), arity, step)
        groups = self.leaves.subroots.select(
            F.lit("").alias("group"),
            F.col("subroot").alias("node"),
            F.struct(F.col("group").alias("name"), "level").alias("payload"),
        )
        self.groups = Tree(_placed(groups, ["payload"]), arity, step)
        found = self.groups.subroots.first()
        self.root: str | None = found["subroot"] if found else None

    def proofs(self) -> DataFrame:
        """Per row its id, group, leaf, extra, subroot, the root and its siblings (see ``fold``)."""
        return self.finished(
            "group string, leaf string, extra string, subroot string, root string, sides string",
            lambda *row: row,
            "id",
        )

    def finished(self, schema: str, finish, doc_id: str = "doc_id") -> DataFrame:
        """What ``finish`` makes of the rows of ``proofs``, whose siblings are kept no longer.

        It returns the id and the columns of ``schema``.
        """
        root = self.root
        kind = "group string, subroot string, level int, above string"
        above = self.groups.proofs(
            self.groups.subroots.withColumn("above", F.lit("")),
            kind,
            lambda _, __, node, payload, sides: (payload["name"], node, payload["level"], sides),
        )
        rows = self.leaves.proofs(
            written(above, "above"),
            f"{doc_id} string, {schema}",
            lambda group, subroot, node, payload, sides: finish(
                payload["id"], group[1:] if group else None, node, payload["extra"], subroot, root, sides
            ),
        )
        return rows.withColumn(doc_id, F.col(doc_id).cast(self.id_type))


def checked(doc_id, group, node, tampered, subroot, root, sides) -> tuple:
    """The digest of a row's proof, and the root that the row as found (``tampered``, if set) leads to."""
    found = fold(tampered or node, sides)
    return doc_id, node, subroot, root, digest(siblings(sides)), found, found == root


CHECKED = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
