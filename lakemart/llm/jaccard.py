"""Near-duplicate texts: an exact Jaccard join of word shingle sets, as components.

Equal sets are one class. Classes meet by a pigeonhole: sets that differ in at most D shingles,
cut by hash into D + 1 parts, agree in one part at least, and few others agree in it. D follows
from the threshold and the sizes, so sizes are banded; a set near the upper end of its band is also
put in the next. A part shared by many is never turned into all of its pairs:

1. Each class is paired with one representative of each of its parts. Signatures bound what the
   two can share; of the pairs they leave, the most promising of each class is compared exactly, and
   components are formed. Most parts then lie within one component, and nothing more can come of
   them.
2. The parts left are cut into bounded blocks, over which signature trees are built. Nodes hold the
   OR of token bitmaps and the range of sizes; two trees are descended together, and a pair of nodes
   is left out if its greatest possible overlap is below what the least sizes ask for, or if it
   holds one component only. Blocks carry signatures only; the members that remain, fewer than came
   in, get their hashes and are descended again, then compared exactly. A link makes its two
   components one within the block, so there are fewer links than members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import bucketed, discard, drop_bucketed, kept, ship, small_join, udf, written
from lakemart.llm.components import components

BLOCK = 2048  # members of a side of a block; a part of n members sends about 2 n * n / BLOCK
FIRST, SECOND, BOTH = 0, 1, 2  # sides of a block that a row belongs to
CELLS = 1 << 18  # words of signatures that are compared at once, 2 MB
PAIRS = 1 << 16  # pairs of nodes that are looked at at once
WIDTH = 4  # bits of a signature per shingle, at least
PACKED = 6  # bytes of a hash that are kept to compare two sets
LEAF = 16  # rows of a tree's leaf, and children of a node
GROWTH = 1.5  # of band sizes
REMEMBERED = 100_000  # words whose hash a Python worker remembers

_B = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; A-Z lower-cased, ASCII blanks.

    Fewer words are one shingle; none give an empty set.
    """
    words = (text or "").encode("utf-8").lower().split()
    n = len(words)
    h = np.fromiter(map(kept("jaccard", _Hashes).__getitem__, words), np.uint64, n)
    with np.errstate(over="ignore"):
        width = min(k, n)
        total = np.zeros(max(n - width + 1, 0) if n else 0, np.uint64)
        for i in range(width):
            total = total * _C + h[i : i + len(total)]
        return np.unique(_mixed(total + np.uint64(width)))


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes()))))


@cache
def band_start(j: int) -> int:
    """The least size of band ``j``."""
    size = 1
    for _ in range(j):
        size = max(size + 1, math.ceil(size * GROWTH))
    return size


@cache
def band_of(size: int) -> int:
    j = 0
    while band_start(j + 1) <= size:
        j += 1
    return j


@cache
def parts_of(j: int, percent: int) -> tuple[int, int]:
    """(number of parts, most differing shingles) in band ``j``; no parts if none may differ."""
    most = (100 - percent) * 2 * (band_start(j + 1) - 1) // (100 + percent)
    if not most:
        return 0, 0
    parts = most + 1
    least = band_start(j)
    if least >= 30:  # spare parts, so that parts without tokens need not be relied on
        empty = parts * math.exp(-least / parts)
        parts += math.ceil(empty + 3 * math.sqrt(empty))
    return parts, most


def keys(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the parts by which a set meets all sets at ``percent`` or more.

    They follow from the bytes of the tokens that ``packed`` keeps.
    """
    tokens = tokens & np.uint64((1 << 8 * PACKED) - 1)
    size = len(tokens)
    if not size:
        return np.zeros(0, np.int64)
    own = band_of(size)
    bands = [own] + [own + 1] * (100 * size >= percent * band_start(own + 1))
    out = []
    for j in bands:
        parts, most = parts_of(j, percent)
        if not parts:
            continue
        part = (tokens >> np.uint64(20)) % np.uint64(parts)
        part = part.astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(sums, part, _mixed(tokens * _C))
            counts = np.bincount(part, minlength=parts)
            key = _mixed(
                sums * _B + np.arange(parts, dtype=np.uint64) * _C + np.uint64(j) * np.uint64(0x632BE5AB)
            )
        # Of a pair's equal parts at most those without tokens in both are empty. Where these could
        # be all, both sets have so many that both rely on them.
        relied = (counts > 0) | ((counts == 0).sum() >= parts - most)
        out.append(key[relied])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def _met(ids: np.ndarray, counts: np.ndarray, key: np.ndarray) -> pd.DataFrame:
    """Rows (key, id, other): one id for each key, and local pairs of that id and others."""
    id_ = np.repeat(ids, counts)
    order = np.lexsort((id_, key))
    key, id_ = key[order], id_[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    rep = id_[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(key) else id_
    pair = rep != id_
    pairs = pd.DataFrame({"id": rep[pair], "other": id_[pair]}).drop_duplicates()
    fresh_key, fresh_id = key[fresh], id_[fresh]
    none = np.concatenate([np.ones(len(fresh_key), bool), np.zeros(len(pairs), bool)])
    return pd.DataFrame(
        {
            # Of pairs the key only spreads them; none is meant.
            "key": np.concatenate([fresh_key, (pairs.other ^ pairs.id).to_numpy(np.int64)]),
            "id": np.concatenate([fresh_id, pairs.id.to_numpy(np.int64)]),
            "other": pd.arrays.IntegerArray(
                np.concatenate([np.zeros(len(fresh_key), np.int64), pairs.other.to_numpy(np.int64)]), none
            ),
        }
    )


def _meetings(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of set ids: each set with a representative of each of its parts."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[int, np.ndarray] = {}
            for t in batch.iloc[:, 0]:
                tokens = shingles(t, k)
                name = set_id(tokens)
                if name not in seen:
                    seen[name] = keys(tokens, percent)
            if seen:
                ids = np.fromiter(seen, np.int64, len(seen))
                counts = np.fromiter(map(len, seen.values()), np.int64, len(seen))
                yield _met(ids, counts, np.concatenate(list(seen.values())))

    rows = docs.select(text).mapInPandas(emit, "key long, id long, other long")
    order = Window.partitionBy("key", "other").orderBy("id")
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pairs = rows.repartition("key").withColumn("first", F.first("id").over(first))
    return pairs.select(
        F.when(F.col("other").isNull(), F.col("first")).otherwise(F.col("id")).alias("a"),
        F.coalesce("other", "id").alias("b"),
    ).where("a != b").distinct()


def packed(tokens: np.ndarray) -> bytes:
    """The lower PACKED bytes of each hash; enough to tell the shingles of two sets apart."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PACKED].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // PACKED, 8), np.uint8)
    out[:, :PACKED] = np.frombuffer(data, np.uint8).reshape(-1, PACKED)
    return np.sort(out.view("<u8").ravel())


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets reach ``percent``."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return (100 + percent) * both >= percent * (len(x) + len(y))


def signature(tokens: np.ndarray) -> bytes:
    """A bitmap of a set, of a width by its size: a power of two."""
    bits = max(256, 1 << (WIDTH * len(tokens) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[(tokens % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def even(signatures: list[bytes]) -> np.ndarray:
    """Bitmaps folded to the least width among them, as rows of words."""
    least = min(map(len, signatures))
    if max(map(len, signatures)) == least:
        return np.frombuffer(b"".join(signatures), np.uint64).reshape(-1, least // 8)
    out = np.zeros((len(signatures), least // 8), np.uint64)
    for row, s in zip(out, signatures, strict=True):
        row[:] = np.bitwise_or.reduce(np.frombuffer(s, np.uint64).reshape(-1, least // 8), axis=0)
    return out


def _slack(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many shingles of each set share another's bit."""
    return size - np.bitwise_count(bits).sum(axis=1).astype(np.int64)


def _promising(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of each ``b`` the pair whose signatures leave the greatest share possible, if it reaches ``percent``."""

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best = []
            for m, x, n, y in zip(batch.na, batch.sa, batch.nb, batch.sb, strict=True):
                bits, size = even([x, y]), np.array([m, n])
                shared = int(np.bitwise_count(bits[0] & bits[1]).sum(dtype=np.int64))
                overlap = min(shared + int(_slack(bits, size).min()), m, n)
                best.append(100 * overlap / (m + n - overlap))
            batch = batch[["a", "b"]].assign(best=best)
            yield batch[batch.best >= percent - 1e-6]

    a = sets.select(F.col("id").alias("a"), F.col("size").alias("na"), F.col("signature").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("size").alias("nb"), F.col("signature").alias("sb"))
    left = pairs.join(b, "b").join(a, "a").select("a", "b", "na", "sa", "nb", "sb")
    left = left.mapInPandas(bound, "a long, b long, best double")
    best = left.groupBy("b").agg(F.max_by("a", F.struct("best", "a")).alias("a"))
    return best.select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach ``percent``."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [alike(unpacked(x), unpacked(y), percent) for x, y in zip(batch.ta, batch.tb, strict=True)]
            yield batch[np.array(found, bool)][["a", "b"]]

    a = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb")
    return both.mapInPandas(compare, "a long, b long")


def _open_members(members: DataFrame) -> DataFrame:
    """The rows (key, id, root) of parts that hold several components.

    Nearly all parts hold one. All members are dealt by part once and those that go on come out of
    the same pass, so what all sets have in parts is neither written nor dealt a second time.
    """
    part = Window.partitionBy("key")
    ends = members.repartition("key").select(
        "key", "id", "root", F.min("root").over(part).alias("low"), F.max("root").over(part).alias("high")
    )
    return ends.where("low < high").select("key", "id", "root")


def _several_roots(members: DataFrame) -> DataFrame:
    """(key, most, n, roots, who) of the parts (key, id, root) that hold several components.

    Dealt by part once. Nearly every part has one member for each root, so to sum up by part and
    root first, dealt by both, would save little and shuffle everything twice.
    """
    per_root = members.repartition("key").groupBy("key", "root").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("who")
    )
    per_part = per_root.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("most"),
        F.sum("n").alias("n"),
        F.count("*").alias("roots"),
        F.bit_xor("who").alias("who"),
    )
    return per_part.where("roots > 1")


def _blocks(sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(block, side, id, root) for parts that hold several components."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [keys(unpacked(t), percent) for t in batch.tokens]
            counts = [len(f) for f in found]
            if sum(counts):
                yield pd.DataFrame(
                    {
                        "key": np.concatenate(found),
                        "id": np.repeat(batch.id.to_numpy(), counts),
                        "root": np.repeat(batch.root.to_numpy(), counts),
                    }
                )

    known = sets.select("id", "tokens").join(roots, "id", "left")
    known = known.select("id", F.coalesce("root", "id").alias("root"), "tokens")
    rows = _open_members(known.mapInPandas(emit, "key long, id long, root long"))
    rows = written(rows, "open_members")
    # Two sets alike in many parts meet in all of them; parts with the same members count once.
    open_ = _several_roots(rows).groupBy("who", "n").agg(
        F.min("key").alias("key"), F.min("most").alias("most")
    )
    open_ = open_.select(
        "key",
        F.col("most.root").alias("main"),
        F.ceil(F.col("n") / BLOCK).alias("cuts"),
        F.ceil((F.col("n") - F.col("most.n")) / BLOCK).alias("few_cuts"),
    )
    open_ = written(open_, "open")
    members, rows = rows, small_join(rows, open_, ["key"], weight=F.lit(len(open_.columns)))
    rows = written(rows, "once_members")  # both sides below read them
    discard(members)
    discard(open_)
    # In a part of one block those that are on both sides come once.
    alone = (F.col("cuts") == 1) & (F.col("root") != F.col("main"))
    many = rows.select(
        "key",
        F.pmod(F.xxhash64("id"), "cuts").alias("x"),
        F.explode(F.expr("sequence(0L, few_cuts - 1)")).alias("y"),
        F.when(alone, BOTH).otherwise(FIRST).alias("side"),
        "id",
        "root",
    )
    few = rows.where("root != main and cuts > 1").select(
        "key",
        F.explode(F.expr("sequence(0L, cuts - 1)")).alias("x"),
        F.pmod(F.xxhash64("id"), "few_cuts").alias("y"),
        F.lit(SECOND).alias("side"),
        "id",
        "root",
    )
    blocks = many.unionByName(few).withColumn("block", F.xxhash64("key", "x", "y"))
    blocks = written(blocks.select("block", "side", "id", "root"), "blocks")
    discard(rows)
    return blocks


class Tree:
    """Signatures in leaves and nodes above them; level 0 are the rows themselves."""

    def __init__(self, bits: np.ndarray, size: np.ndarray, root: np.ndarray):
        slack = _slack(bits, size)
        self.levels = [(bits, size, size, slack, root, root)]
        while len(self.levels[-1][1]) > 1:
            b, low, high, slack, r0, r1 = self.levels[-1]
            at = np.arange(0, len(low), LEAF)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(b, at),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(slack, at),
                    np.minimum.reduceat(r0, at),
                    np.maximum.reduceat(r1, at),
                )
            )


def possible(x: tuple, i: np.ndarray, y: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes i of level x and j of level y may hold a link between components."""
    shared = np.zeros(len(i), np.int64)
    step = max(1, CELLS // x[0].shape[1])
    for at in range(0, len(i), step):
        some = slice(at, at + step)
        shared[some] = np.bitwise_count(x[0][i[some]] & y[0][j[some]]).sum(axis=1)
    overlap = np.minimum(shared + np.minimum(x[3][i], y[3][j]), np.minimum(x[2][i], y[2][j]))
    asked = percent * (x[1][i] + y[1][j])  # / (100 + percent), for the least sizes
    one = (x[4][i] == x[5][i]) & (y[4][j] == y[5][j]) & (x[4][i] == y[4][j])
    return ((100 + percent) * overlap >= asked) & ~one


def descend(x: Tree, y: Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that the two trees leave, going down both, PAIRS of nodes at a time."""
    out = [(np.zeros(0, np.int64),) * 2]
    work = [(len(x.levels) - 1, len(y.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        a, b, i, j = work.pop()
        keep = possible(x.levels[a], i, y.levels[b], j, percent)
        i, j = i[keep], j[keep]
        if not a and not b:
            out.append((i, j))
            continue
        if a >= b:
            a -= 1
            child = (i[:, None] * LEAF + np.arange(LEAF)).ravel()
            j = np.repeat(j, LEAF)
            ok = child < len(x.levels[a][1])
            i, j = child[ok], j[ok]
        else:
            b -= 1
            child = (j[:, None] * LEAF + np.arange(LEAF)).ravel()
            i = np.repeat(i, LEAF)
            ok = child < len(y.levels[b][1])
            i, j = i[ok], child[ok]
        work += [(a, b, i[at : at + PAIRS], j[at : at + PAIRS]) for at in range(0, len(i), PAIRS)]
    i, j = (np.concatenate(side) for side in zip(*out, strict=True))
    return i, j


Rows = dict[str, np.ndarray]  # columns of one block, by side, root and id


def _pairs_left(rows: Rows, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of a block that its two trees leave."""
    many, few = np.flatnonzero(rows["side"] != SECOND), np.flatnonzero(rows["side"] != FIRST)
    root, size = rows["root"], rows["size"].astype(np.int64)
    if not len(many) or not len(few):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = even(rows["signature"].tolist())
    i, j = descend(*(Tree(bits[at], size[at], root[at]) for at in (many, few)), percent)
    i, j = many[i], few[j]
    apart = root[i] != root[j]
    return i[apart], j[apart]


def _block_by_block(df: DataFrame, function, schema: str) -> DataFrame:
    """What ``function`` makes of each block's rows (columns); many small blocks share a call of Spark's."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            columns = {c: batch[c].to_numpy() for c in batch.columns}
            bounds = [0, *(np.flatnonzero(np.diff(columns["block"])) + 1).tolist()]
            rest = batch.iloc[bounds[-1] :]  # may go on in the next batch
            yield from put([{c: x[i:j] for c, x in columns.items()} for i, j in zip(bounds, bounds[1:], strict=False)])
        if rest is not None and len(rest):
            yield from put([{c: rest[c].to_numpy() for c in rest.columns}])

    def put(blocks: list[Rows]) -> Iterator[pd.DataFrame]:
        made = [m for m in map(function, blocks) if len(m[0])]
        if made:
            yield pd.DataFrame({n: np.concatenate(x) for n, x in zip(names, zip(*made, strict=True), strict=True)})

    return df.repartition("block").sortWithinPartitions("block", "side", "root", "id").mapInPandas(run, schema)


def _left(percent: int):
    def members(rows: Rows) -> list[np.ndarray]:
        i, j = _pairs_left(rows, percent)
        at = np.union1d(i, j)
        return [rows[c][at] for c in ("block", "side", "id", "root")]

    return members


def _tree_links(percent: int):
    def links_of(rows: Rows) -> list[np.ndarray]:
        i, j = _pairs_left(rows, percent)
        tokens = lru_cache(LEAF * LEAF)(lambda k: unpacked(rows["tokens"][k]))
        root, ids = rows["root"].tolist(), rows["id"]
        parent: dict[int, int] = {}

        def top(node: int) -> int:
            while (above := parent.get(node, node)) != node:
                parent[node] = node = parent.get(above, above)
            return node

        links = []
        for p, q in zip(i.tolist(), j.tolist(), strict=True):
            x, y = top(root[p]), top(root[q])
            if x != y and alike(tokens(p), tokens(q), percent):
                parent[max(x, y)] = min(x, y)
                links.append((p, q))
        at = np.array(links, np.int64).reshape(-1, 2)
        return [ids[at[:, 0]], ids[at[:, 1]]]

    return links_of


def _links_of_trees(sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components, enough of them to join all that are linked."""
    blocks = _blocks(sets, roots, percent)
    names = sets.select("id", "size", "signature")
    kind = "block long, side int, id long, root long"
    left = written(_block_by_block(blocks.join(names, "id"), _left(percent), kind), "left")
    # A pair left in many parts is compared in one of the blocks that have the same members left.
    who = left.groupBy("block").agg(F.bit_xor(F.xxhash64("id", "side")).alias("who"), F.count("*").alias("n"))
    once = written(who.groupBy("who", "n").agg(F.min("block").alias("block")).select("block"), "once")
    rows = small_join(left, once, ["block"]).join(sets.select("id", "size", "signature", "tokens"), "id")
    links = written(_block_by_block(rows, _tree_links(percent), "a long, b long"), "links")
    for table in (blocks, left, once):
        discard(table)
    return links


def classes(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """``docs`` without ``text``, with n_shingles, set_id and root; empty sets have no set_id.

    ``root`` names the component; a class without links is its own. Rows are not told apart by an
    id, so null and repeated ids do no harm; null texts are empty.
    """
    ship(docs.sparkSession)

    def measure(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(t, k) for t in texts]
        return pd.DataFrame({"n": [len(f) for f in found], "id": [set_id(f) for f in found]})

    measured = docs.withColumn("_q_m", udf(measure, "n long, id long")(F.col(text)))
    members = written(
        measured.select(
            *[F.col(f"`{c}`") for c in docs.columns if c != text],
            F.col("_q_m.n").alias("n_shingles"),
            F.when(F.col("_q_m.n") > 0, F.col("_q_m.id")).alias("set_id"),
            F.xxhash64(F.col(text)).alias("_q_text"),
        ),
        "members",
    )
    pairs = written(_meetings(docs, text, k, percent), "pairs")
    active = written(
        pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "active"
    )

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, k) for t in batch.text.drop_duplicates()]
            yield pd.DataFrame(
                {
                    "id": [set_id(f) for f in found],
                    "size": [len(f) for f in found],
                    "signature": [signature(f) for f in found],
                    "tokens": [packed(f) for f in found],
                }
            )

    # One text of each set, found again by its hash, so that no other text is cut to shingles anew.
    chosen = members.select(F.col("set_id").alias("id"), "_q_text").join(active, "id", "left_semi")
    chosen = written(chosen.groupBy("id").agg(F.min("_q_text").alias("_q_text")), "texts")
    texts = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("_q_text"))
    sets = small_join(texts, chosen.select("_q_text"), ["_q_text"], "left_semi")
    sets = sets.select("text").mapInPandas(take, "id long, size int, signature binary, tokens binary")
    sets = sets.groupBy("id").agg(*[F.first(c).alias(c) for c in ("size", "signature", "tokens")])
    sets = bucketed(sets, "id")
    links = written(_linked(written(_promising(pairs, sets, percent), "best"), sets, percent), "stars")
    roots = components(links)
    more = _links_of_trees(sets, roots, percent)
    if more.limit(1).count():
        roots = components(links.union(more))
    for table in (pairs, active, chosen):
        discard(table)
    drop_bucketed(sets)
    found = members.join(roots.select(F.col("id").alias("set_id"), "root"), "set_id", "left")
    return found.drop("_q_text").withColumn("root", F.coalesce("root", "set_id"))


def join(docs: DataFrame, text: str = "text", id_: str = "doc_id", k: int = 3, percent: int = 90):
    """(id, n_shingles, component_id): the smallest id reachable by links, itself included.

    Rows with equal sets are linked; null ids are never the smallest, and a component of null ids
    only has a null id. Texts without words are linked with nothing. Give unique ids to have the
    components told apart.
    """
    found = written(classes(docs.select(F.col(id_).alias("id"), text), text, k, percent), "classes")
    least = found.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    return found.join(least, "root", "left").select(
        F.col("id").alias(id_), "n_shingles", F.coalesce("least", "id").alias("component_id")
    )


def keep_one(docs: DataFrame, text: str = "text", id_: str = "doc_id", k: int = 5, percent: int = 80):
    """``docs`` with one row of each component, the one of the smallest id; same columns.

    Texts without words all stay. Of rows equal in every column one stays.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn("_q_row", F.xxhash64(*names))
    narrow = marked.select(F.col(id_).alias("id"), "_q_row", F.col(text).alias("text"))
    found = written(classes(narrow, "text", k, percent), "classes")
    chosen = found.where("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "_q_row")).alias("best")
    )
    chosen = chosen.select(F.col("best._q_row").alias("_q_row"), F.lit(True).alias("_q_once"))
    empty = found.where("root is null").select("_q_row", F.lit(False).alias("_q_once"))
    kept = written(chosen.union(empty).distinct(), "kept")
    number = Window.partitionBy("_q_row").orderBy("_q_once")
    return (
        small_join(marked, kept, ["_q_row"])
        .withColumn("_q_no", F.row_number().over(number))
        .where("_q_no = 1 or not _q_once")
        .select(*names)
    )
