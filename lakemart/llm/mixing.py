"""Mixing sources to target weights by pivotal dependent rounding.

A source of size S with target T wants T/S copies of each of its rows: the whole part is given to
all, the fraction is rounded. Rounding is dependent. Two fractional rows a and b meet, and mass
moves between them, in a random direction with the right odds, until one is 0 or 1; since
size * fraction is what moves, the pair's words do not change and each row's odds stay its
fraction. The one left fractional meets the next row. The last one of a source is rounded to the
nearest, so a source misses its target by half a row's size at most.

The pairing is a reduction tree: rows are dealt into nodes of about FAN rows by a hash, each node
is folded to one residual row, the residuals are the rows of the next level. No node grows with
the source, and each level has a 64th of the rows of the one below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import small_join, tag, unit, written

FAN = 64  # mean rows folded in a node of the tree
WEIGHTS = (3, 1, 2)  # by the order of sources, repeating
SHARE = 1.5  # of all sizes goes to the mix
MOST = 2  # times its own size that a source may give
NEAR = 1e-9  # a fraction this close to 0 or 1 is integral


def targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``target`` of each row of (source, source_size): one row per source.

    The excess of sources that would exceed ``most`` times their size is reshared by weight until
    none is above; that is a water level L with target = min(most * size, weight * L), found by
    taking the sources in the order in which they fill up. Windows run over one row per source.
    """
    given = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("_q_i") % len(weights) + 1).cast("int"),
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("_q_full", "_q_i")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = (F.sum("source_size").over(everything) * share) - F.coalesce(
        F.sum("_q_cap").over(before), F.lit(0)
    )
    found = F.when(F.col("_q_level") <= F.col("_q_full"), F.struct("_q_full", "_q_i", "_q_level"))
    return (
        sizes.withColumn("_q_i", F.row_number().over(by_name) - 1)
        .withColumn("_q_w", given)
        .withColumn("_q_cap", F.col("source_size") * most)
        .withColumn("_q_full", F.col("_q_cap") / F.col("_q_w"))
        .withColumn("_q_level", level / F.sum("_q_w").over(after))
        .withColumn("_q_found", F.min(found).over(everything))
        .withColumn(
            "target",
            F.least(F.col("_q_cap").cast("double"), F.col("_q_w") * F.col("_q_found._q_level")),
        )
        .select(*sizes.columns, "target")
    )


def _fold(seed: int, level: int) -> Column:
    """Folds the array ``rows`` of (h, r, p, w) to (left, done): all but one made integral."""

    def integral(p: Column) -> Column:
        return (p < NEAR) | (p > 1 - NEAR)

    def meet(state: Column, b: Column) -> Column:
        a = state["left"]
        up = F.least(a["w"] * (1 - a["p"]), b["w"] * b["p"])  # words that a may gain from b
        down = F.least(a["w"] * a["p"], b["w"] * (1 - b["p"]))
        gain = F.when(
            unit(F.lit(seed), F.lit(level), a["h"], b["h"]) * (up + down) < down, up
        ).otherwise(-down)
        new_a = F.struct(
            a["h"].alias("h"), a["r"].alias("r"), (a["p"] + gain / a["w"]).alias("p"), a["w"].alias("w")
        )
        new_b = F.struct(
            b["h"].alias("h"), b["r"].alias("r"), (b["p"] - gain / b["w"]).alias("p"), b["w"].alias("w")
        )
        moved = F.when(integral(a["p"]) | integral(b["p"]), F.struct(a.alias("a"), b.alias("b")))
        moved = moved.otherwise(F.struct(new_a.alias("a"), new_b.alias("b")))
        # An array of one element binds the pair, so that it is computed once.
        return F.element_at(
            F.transform(
                F.array(moved),
                lambda m: F.when(
                    integral(m["a"]["p"]),
                    F.struct(
                        m["b"].alias("left"),
                        F.concat(state["done"], F.array(m["a"])).alias("done"),
                    ),
                ).otherwise(
                    F.struct(
                        m["a"].alias("left"),
                        F.concat(state["done"], F.array(m["b"])).alias("done"),
                    )
                ),
            ),
            1,
        )

    start = F.struct(F.element_at("rows", 1).alias("left"), F.slice("rows", 1, 0).alias("done"))
    return F.aggregate(F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0))), start, meet)


def decide(
    units: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 11,
    fan: int = FAN,
) -> DataFrame:
    """``units`` with source_size, target and ``copies``, each the floor or ceiling of T/S.

    ``units`` has the columns source (string), size (long, not negative) and whatever identifies a
    row; pass no texts. Null is a source of its own, last in order. Rows that are equal in every
    column are rounded one by one. A size of 0 gets the whole part only, for it has no words to
    move; so do all rows of a source without words. Same rows, same result, in any partitioning.
    """
    given = units.columns
    same = Window.partitionBy(*given).orderBy(F.lit(0))
    narrow = written(
        units.withColumn("_q_k", F.row_number().over(same)).withColumn("_q_s", tag("source")), "units"
    )
    sizes = narrow.groupBy("source", "_q_s").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_q_n")
    )
    sizes = written(targets(sizes, weights, share, most), "sources")
    largest = sizes.agg(F.max("_q_n")).first()[0] or 0
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    odds = F.when(F.col("size") > 0, F.col("_q_want") - F.floor("_q_want")).otherwise(0.0)
    rows = (
        small_join(narrow, sizes.drop("source"), ["_q_s"])
        .withColumn("_q_want", wanted)
        .withColumn("h", F.xxhash64(F.lit(seed), *[F.col(c) for c in given], "_q_k"))
        .select(
            "_q_s",
            F.floor(unit(F.lit(seed + 1), "h") * F.ceil(F.col("_q_n") / fan)).alias("_q_node"),
            "h",
            F.struct(*given, "source_size", "target", F.floor("_q_want").alias("copies")).alias("r"),
            odds.alias("p"),
            F.col("size").cast("double").alias("w"),
        )
    )
    whole = (F.col("p") < NEAR) | (F.col("p") > 1 - NEAR)
    result, level, nodes = [rows.where(whole).select("r", "p")], 0, -(-largest // fan)
    rows = rows.where(~whole)
    while True:
        folded = (
            rows.groupBy("_q_s", "_q_node")
            .agg(F.sort_array(F.collect_list(F.struct("h", "r", "p", "w"))).alias("rows"))
            .select("_q_s", "_q_node", _fold(seed, level).alias("f"))
        )
        folded = written(folded, f"level{level}")
        result.append(folded.select(F.explode("f.done").alias("d")).select("d.r", "d.p"))
        rows = folded.select(
            "_q_s", F.floor(F.col("_q_node") / fan).alias("_q_node"), "f.left.*"
        )
        if nodes <= 1:
            break
        level, nodes = level + 1, -(-nodes // fan)
    # One row per source is left. To the nearest: half its size is the most a source can miss.
    last = F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)
    result.append(rows.select("r", last.alias("p")))
    decided = result[0]
    for part in result[1:]:
        decided = decided.unionByName(part)
    return decided.select(
        *[F.col("r")[c].alias(c) for c in given],
        F.col("r.source_size"),
        F.col("r.target"),
        (F.col("r.copies") + F.round("p").cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, size: Column, source: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (0 to ``most`` times), same columns.

    Rows are told apart by a hash of all their columns and a running number among equal hashes,
    so nulls, repeated rows and repeated ids are all served. Texts are shuffled once, to meet
    their decision. Columns beginning with ``_q_`` are reserved.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    row, origin = F.xxhash64(*names).alias("_q_hash"), F.col(source).cast("string")
    number = Window.partitionBy("_q_hash").orderBy("_q_source", "_q_size")
    keys = docs.select(row, origin.alias("source"), size.alias("size"))
    order = Window.partitionBy("_q_hash").orderBy("source", "size")
    decided = decide(keys.withColumn("_q_no", F.row_number().over(order)), **options)
    # One row per hash, so that the join needs the partitioning of the window only.
    copies = decided.groupBy("_q_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("_q_no", "copies"))).alias("_q_copies")
    )
    marked = docs.select(*names, row, origin.alias("_q_source"), size.alias("_q_size"))
    return (
        marked.withColumn("_q_no", F.row_number().over(number))
        .join(copies, "_q_hash")
        .withColumn("_q_times", F.element_at("_q_copies", F.col("_q_no")))
        .where("_q_times > 0")
        .withColumn("_q_time", F.explode(F.expr("sequence(1L, _q_times)")))
        .select(*names)
    )
