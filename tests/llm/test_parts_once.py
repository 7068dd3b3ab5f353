"""Parts of the Jaccard join are dealt once to find those of several components."""

from __future__ import annotations

from lakemart.llm.jaccard import _several_roots


def test_dealt_once(spark):
    members = spark.createDataFrame(
        [(1, 10, 10), (1, 11, 10), (1, 12, 12), (2, 10, 10), (2, 11, 10), (3, 12, 12)], "key long, id long, root long"
    )
    found = _several_roots(members)
    rows = [(r.key, r.most.n, r.most.root, r.n, r.roots) for r in found.collect()]
    assert rows == [(1, 2, 10, 3, 2)]
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange") == 1
