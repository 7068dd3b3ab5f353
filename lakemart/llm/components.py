"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import discard, small_join, written


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every node in ``links`` (a, b); root is the least id of its component.

    Each round takes the least label among neighbours and then the label's own label, so the
    distance to the root at least halves along stars and chains. Labels of labels are few and
    looked up apart, so a root that many share is no join key unless the roots are many, too.
    Rounds are written, no label passes the driver; a round's table goes when the next is there.
    No links give an empty result.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct()
    both = written(both, "links")
    labels = written(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("root")),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "root"), "b")
        near = near.groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        hop = labels.select("root").distinct().join(
            labels.select(F.col("id").alias("root"), F.col("root").alias("hop")), "root"
        )
        hop = written(hop, "hops")
        new = small_join(labels.join(near, "id"), hop, ["root"])
        new = written(new.select("id", F.least("near", "hop").alias("new"), "root"), "labels")
        discard(hop)
        discard(labels)
        if new.where("new < root").limit(1).count() == 0:
            discard(both)
            return new.select("id", F.col("new").alias("root"))
        labels = new.select("id", F.col("new").alias("root"))
