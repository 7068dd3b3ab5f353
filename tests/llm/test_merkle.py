"""The manifest against trees built in memory."""

import hashlib
import random
import zlib

import pytest

from lakemart.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, place int"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = (row[0], row[3], row[2], row[4], row[1])
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, arity=2):
    """The root, and each leaf's siblings by level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at, strict=True):
            start = i // arity * arity
            p.append((nodes[start:i], nodes[i + 1 : start + arity]))
        nodes = [sha(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        at = [i // arity for i in at]
    return nodes[0], paths


def expected(rows, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found = {}
    for name in names:
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found[name] = members, *tree([leaf(r) for r in members], arity)
    root, tops = tree([found[n][1] for n in names], arity)
    out = []
    for name, top in zip(names, tops, strict=True):
        members, subroot, paths = found[name]
        for row, path in zip(members, paths, strict=True):
            path = path + top
            proof = sha(*[x for left, right in path for x in left + right])
            node = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                node = leaf((*row[:4], row[4] + 1))
            for left, right in path:
                node = sha(*left, node, *right)
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def documents(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def table(sizes):
    rnd, rows = random.Random(5), []
    for lang, n in sizes.items():
        rows += [(rnd.randrange(10**6), f"é {i}", lang, None if i % 5 == 0 else "s", None if i % 3 == 0 else i) for i in range(n)]
    return rows


@pytest.fixture
def query(spark, tmp_path):
    from lakemart.llm.queries import op12_merkle_manifest

    def run(rows):
        documents(spark, rows).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return sorted(map(tuple, op12_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)

    return run


@pytest.mark.parametrize(
    "sizes",
    [{"en": 1}, {"en": 2, None: 3}, {"a": 1, "b": 256, "c": 257, None: 5, "": 2}, {"en": 700, "ü": 1, "z": 255, "é": 513}],
)
def test_query_equals_trees_in_memory(query, sizes):
    rows = table(sizes)
    assert query(rows) == expected(rows)


def test_many_stored_levels(spark):
    rows = table({"en": 70, "de": 4, None: 5, "x": 17, "y": 16, "z": 1})
    manifest = merkle.Manifest(documents(spark, rows), COLUMNS, step=2)
    assert len(manifest.leaves.stored) == 4 and len(manifest.groups.stored) == 2
    got = manifest.finished(merkle.CHECKED, merkle.checked).collect()
    assert {tuple(r)[:5] for r in got} == {r[:5] for r in expected(rows)} and all(r.verified for r in got)


def test_nulls_ties_and_empty_values(query):
    rows = [(None, None, None, None, None)] * 3 + [(4, "", "", "", 0)] * 2 + [(4, "x", "", None, None), (None, "", "en", "s", 7)]
    rows += [(2**62 + 1, "t", "en", "s", 1)]
    assert query(rows) == expected(rows)
    assert query([]) == []


def test_proofs_fold_to_the_root(spark):
    rows = table({"en": 40, None: 9, "de": 27})
    manifest = merkle.Manifest(documents(spark, rows), COLUMNS, arity=3)
    got = manifest.proofs().collect()
    want = expected(rows, 3)
    assert {(r.id, r.leaf, r.subroot, r.root, merkle.digest(merkle.siblings(r.sides))) for r in got} == {w[:5] for w in want}
    assert all(merkle.fold(r.leaf, r.sides) == manifest.root for r in got)
    assert {r.group for r in got} == {"en", None, "de"}
    none = merkle.Manifest(documents(spark, []), COLUMNS)
    assert none.root is None and none.proofs().collect() == []
