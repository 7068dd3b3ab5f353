"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree turns a vector about its own random axes; the vector's string lists the axes it lies
nearest to, with their sides, nearest first. Vectors close to each other share long prefixes. A
tree's strings, grouped by prefix, are its sorted array: a node is a range of it. A query descends
in every tree by its own string and, as PROBES neighbours of it, by strings that begin with its
next axes. Then all trees ascend together, digit by digit, until the nodes hold enough vectors, at
the root if need be. What the nodes hold is scored exactly.

Nearness is the inner product. Vectors are given one more coordinate that makes their lengths
equal, so the nearest by angle is the largest product. Equal vectors are one class with its
smallest ids: no more of them can be among a query's nearest, so hot vectors cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import ship, small_join, written

TREES = 16
PROBES = 4
DIGITS = 3  # of a string
ENOUGH, POWER = 2000, 0.75  # least vectors in a query's nodes: the larger of ENOUGH and n ** POWER
BLOCK = 4096  # vectors, and queries, scored in one task
SALTS = 64


def strings(vectors: np.ndarray, tree: int, probes: int, seed: int) -> list[np.ndarray]:
    """Strings, as numbers, of all vectors in a tree: the own one, then those of other first axes."""
    dim = vectors.shape[1]
    axes = np.linalg.qr(np.random.default_rng([seed, tree]).normal(size=(dim, dim)))[0]
    turned = vectors @ axes
    order = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, : max(DIGITS, probes)]
    side = np.take_along_axis(turned, order, 1) > 0
    digits = order * 2 + side
    out = []
    for p in range(min(probes, digits.shape[1])):
        own = np.concatenate([digits[:, p : p + 1], np.delete(digits, p, axis=1)], axis=1)
        code = np.zeros(len(vectors), np.int64)
        for d in range(DIGITS):
            code = code * (2 * dim) + own[:, d]
        out.append(code)
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in column])


def _widened(vectors: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """One more coordinate, and zeros up to DIGITS + 1."""
    rest = np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0)) * (not query)
    short = max(0, DIGITS - vectors.shape[1])
    return np.concatenate([vectors, rest[:, None], np.zeros((len(vectors), short))], axis=1)


def _score(k: int):
    def score(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q": [], "c": [], "score": []})
        if not len(index) or not len(queries):
            return empty.astype({"q": str, "c": str})
        v, q = _matrix(index.v), _matrix(queries.v)
        index_c, least = index.c.to_numpy(), index.least.to_numpy()
        parts = []
        # A product of matrices may round otherwise than the sum below, by this share of the norms.
        slack = 4 * v.shape[1] * np.finfo(float).eps * np.sqrt((v * v).sum(axis=1).max())
        for a in range(0, len(q), 256):
            product = q[a : a + 256] @ v.T
            for i, row in enumerate(product):
                top = np.arange(len(row))
                if len(row) > k:  # all that may tie with the k-th stay for now
                    near = slack * np.sqrt((q[a + i] ** 2).sum())
                    top = np.flatnonzero(row >= np.partition(row, -k)[-k] - near)
                exact = (v[top] * q[a + i]).sum(axis=1)
                order = np.lexsort((least[top], -exact))[:k]
                parts.append((a + i, top[order], exact[order]))
        at = np.concatenate([p[1] for p in parts])
        q_at = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
        return pd.DataFrame(
            {
                "q": queries.c.to_numpy()[q_at],
                "c": index_c[at],
                "score": np.concatenate([p[2] for p in parts]),
            }
        )

    return score


def usable(rows: DataFrame, id_: str, vector: str) -> DataFrame:
    """(id, v): rows with an id and a vector of finite numbers, not all zero, each once.

    The dimension is the most frequent one; vectors of another take no part.
    """
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.select(F.col(id_).alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("v").alias("dim")).count()
    dim = sizes.orderBy(F.desc("count"), "dim").first()
    return good.where(F.size("v") == (dim["dim"] if dim else 0)).distinct()


def search(
    rows: DataFrame,
    every: int,
    k: int = 20,
    id_: str = "vec_id",
    vector: str = "embedding",
    seed: int = 17,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest of each row whose id ``every`` divides.

    Candidates are all rows but those of the query's id; all of them if there are fewer. Ties go to
    smaller ids. Extra columns are not looked at; an empty table gives an empty result.
    """
    ship(rows.sparkSession)
    name = F.concat(F.hex(F.xxhash64("v")), F.lit(":"), F.hex(F.xxhash64(F.lit(1), "v")))
    good = written(usable(rows, id_, vector).withColumn("c", name), "vectors")
    # The k + 1 smallest ids of a class, of parts first, so that no class meets in one task.
    part = good.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for keys in (["c", "salt"], ["c"]):
        order = Window.partitionBy(*keys).orderBy("id")
        part = part.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    classes = part.groupBy("c").agg(
        F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")
    )
    classes = written(classes, "classes")
    asked = good.where(F.pmod("id", F.lit(every)) == 0).select("id", "c")
    asked_classes = written(asked.select("c").distinct(), "asked")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, longest, dim = classes.agg(F.count("*"), F.max(square), F.max(F.size("v"))).first()
    base = 2 * ((dim or 0) + 1 + max(0, DIGITS - (dim or 0)))

    def emit(query: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                wide = _widened(_matrix(batch.v), longest, query)
                for t in range(TREES):
                    for code in strings(wide, t, PROBES if query else 1, seed):
                        yield pd.DataFrame({"c": batch.c, "tree": t, "code": code})

        return run

    schema = "c string, tree int, code long"
    index = written(classes.select("c", "v").mapInPandas(emit(False), schema), "index")
    queries = small_join(classes, asked_classes, ["c"], "left_semi").select("c", "v")
    queries = written(queries, "queries")
    probes = written(queries.mapInPandas(emit(True), schema), "probes")

    def node(level: int):
        cut = F.floor(F.col("code") / F.lit(base ** (DIGITS - level)))
        return F.struct(F.lit(level).alias("level"), "tree", cut.alias("code")).alias("node")

    root = F.struct(F.lit(0).alias("level"), F.lit(0).alias("tree"), F.lit(0).cast("long").alias("code"))
    full = index.groupBy("tree", "code").count()
    sizes = [
        full.groupBy(node(level)).agg(F.sum("count").alias("n")) for level in range(1, DIGITS + 1)
    ]
    sizes = sizes[0].union(sizes[1]).union(sizes[2])
    sizes = written(sizes, "nodes")
    ways = [probes.select("c", node(level)) for level in range(1, DIGITS + 1)]
    ways = ways[0].union(ways[1]).union(ways[2])
    held = ways.join(sizes, "node").groupBy("c", "node.level").agg(F.sum("n").alias("n"))
    enough = max(ENOUGH, (n or 0) ** POWER)
    deepest = held.where(F.col("n") >= enough).groupBy("c").agg(F.max("level").alias("deep"))
    level = asked_classes.join(deepest, "c", "left").select(
        F.col("c").alias("q"), F.coalesce("deep", F.lit(0)).alias("deep")
    )
    level = written(level, "levels")
    below = ways.join(level.withColumnRenamed("q", "c"), "c").where("node.level = deep")
    chosen = below.select(F.col("c").alias("q"), "node").union(
        level.where("deep = 0").select("q", root.alias("node"))
    )
    chosen = written(chosen.distinct(), "chosen")
    sizes = sizes.union(asked_classes.limit(1).select(root.alias("node"), F.lit(n).alias("n")))
    cuts = chosen.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).alias("asks"))
    cuts = cuts.join(sizes, "node").withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n")
    cuts = written(cuts, "cuts")
    levels = [r.level for r in cuts.select("node.level").distinct().collect()]
    entries = None
    for x in levels:
        own = index.select("c", node(x)) if x else classes.select("c", root.alias("node"))
        entries = own if entries is None else entries.unionByName(own)
    if entries is None:
        entries = classes.select("c", root.alias("node")).limit(0)
    entries = (
        small_join(entries, cuts, ["node"], weight=F.lit(5))
        .withColumn("x", F.pmod(F.xxhash64("c"), "blocks"))
        .withColumn("y", F.explode(F.expr("sequence(0L, asks - 1)")))
        .join(classes.select("c", "v", F.element_at("ids", 1).alias("least")), "c")
        .select("node", "x", "y", "c", "v", "least")
    )
    asks = (
        small_join(chosen.withColumnRenamed("q", "c"), cuts, ["node"], weight=F.lit(5))
        .withColumn("y", F.pmod(F.xxhash64("c"), "asks"))
        .withColumn("x", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .join(queries, "c")
        .select("node", "x", "y", "c", "v")
    )
    keys = ["node.level", "node.tree", "node.code", "x", "y"]
    scored = (
        entries.groupBy(*keys)
        .cogroup(asks.groupBy(*keys))
        .applyInPandas(_score(k + 1), "q string, c string, score double")
    )
    best = scored.groupBy("q", "c").agg(F.max("score").alias("score"))
    best = best.join(classes.select("c", "ids"), "c")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.element_at("ids", 1))
    best = best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    near = asked.select(F.col("id").alias("query_id"), F.col("c").alias("q")).join(best, "q")
    near = near.select("query_id", "score", F.explode("ids").alias("id")).where("id != query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        near.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), F.col("id").alias(id_), "score")
    )
