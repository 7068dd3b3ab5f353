"""The Jaccard join keeps only open parts on disk, Python workers remember for one operator at a time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import common, jaccard
from lakemart.llm.bpe import Memory


def test_members_of_closed_parts_are_not_written(spark, monkeypatch):
    """All parts of all sets are by far the most rows; only those of several components are kept."""
    sizes = {}

    def noted(df, name, write=common.written):
        out = write(df, name)
        if "key" in out.columns:
            sizes[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "written", noted)
    same = [f"word{i}" for i in range(200)]
    near = [same[:i] + ["other"] + same[i + 1 :] for i in (3, 100, 190)]
    texts = [" ".join(x) for x in [same, *near, [f"apart{i}" for i in range(200)]]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.join(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}
    assert sizes and max(sizes.values()) == 0, sizes


def test_members_of_open_parts(spark):
    rows = [(1, 10, 10), (1, 11, 10), (1, 12, 12), (2, 10, 10), (2, 11, 10), (3, 12, 12), (1, 13, 12)]
    found = jaccard._open_members(spark.createDataFrame(rows, "key long, id long, root long"))
    assert sorted(map(tuple, found.collect())) == sorted(r for r in rows if r[0] == 1)
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange") == 1


def test_memory_of_one_operator_at_a_time():
    first = common.kept("one")
    first["x"] = 1
    assert common.kept("one") is first
    common.kept("two")
    assert common.kept("one") == {}


def test_memory_of_two_generations():
    memory = Memory(3)
    for i in range(10):
        memory.put(i, i)
    assert len(memory.new) + len(memory.old) <= 6 and memory.get(9) == 9


def test_trees_in_slices(monkeypatch):
    """Whatever is looked at at once, the same pairs are left, and all that are alike among them."""
    random = np.random.default_rng(3)
    base = random.integers(0, 2**48, 300, np.int64).astype(np.uint64)
    sets = [np.unique(np.where(random.random(300) < i / 150, base + np.uint64(i), base)) for i in range(60)]
    bits = jaccard.even([jaccard.signature(s) for s in sets])
    size, root = np.array([len(s) for s in sets]), np.arange(60)
    tree = jaccard.Tree(bits, size, root)
    whole = set(zip(*map(np.ndarray.tolist, jaccard.descend(tree, tree, 80)), strict=True))
    monkeypatch.setattr(jaccard, "CELLS", 100)
    monkeypatch.setattr(jaccard, "PAIRS", 7)
    assert whole == set(zip(*map(np.ndarray.tolist, jaccard.descend(tree, tree, 80)), strict=True))
    alike = {(i, j) for i in range(60) for j in range(60) if i != j and jaccard.alike(sets[i], sets[j], 80)}
    assert alike and alike <= whole


def test_members_of_a_block_are_sent_once(spark):
    """In a part of one block a row is on both sides by its mark; larger parts are cut as before."""
    words = [[f"w{i}" for i in range(60)] for _ in range(6)]
    tokens = [jaccard.shingles(" ".join(w + [f"x{n}"] * (n > 0)), 3) for n, w in enumerate(words)]
    rows = [(n, len(t), jaccard.signature(t), jaccard.packed(t)) for n, t in enumerate(tokens)]
    sets = spark.createDataFrame(rows, "id long, size int, signature binary, tokens binary")
    roots = spark.createDataFrame([(n, n) for n in range(6)], "id long, root long")
    blocks = jaccard._blocks(sets, roots, 80)
    most = blocks.groupBy("block").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).collect()
    assert most and all(r.n == r.ids for r in most)
