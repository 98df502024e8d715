"""Connected components of a link table, as a loop of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, comp) for every vertex of ``edges`` (a, b bigint): comp is the smallest vertex
    that its links reach.

    Each round gives a vertex the smallest label among its neighbours and then the
    label of that label, so chains shorten by more than half a round. Rounds are
    staged in the shared folder; only a count of changes reaches the driver.
    """
    links = staged(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    labels = staged(links.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = (links.join(labels, F.col("b") == F.col("v")).groupBy(F.col("a").alias("v"))
                .agg(F.min("comp").alias("near")))
        best = labels.join(near, "v").select("v", F.col("comp").alias("old"), F.least("comp", "near").alias("mid"))
        target = labels.select(F.col("v").alias("mid"), F.col("comp").alias("far"))
        nxt = staged(best.join(target, "mid").select("v", "old", F.least("mid", "far").alias("comp")), "labels")
        if nxt.where("comp <> old").limit(1).count() == 0:
            return nxt.select("v", "comp")
        labels = nxt.select("v", "comp")
