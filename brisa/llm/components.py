"""Connected components of an edge list, as Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import stored


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what the edges i-j connect among n nodes, one less than nodes in each component (in a task)."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while not np.array_equal(root[root], root):
            root = root[root]
        keep = root[i] != root[j]
        i, j = i[keep], j[keep]
    at = np.flatnonzero(root != np.arange(n))
    return root[at], at


#: Rows of a round up to which labels are broadcast (some 16 MB); beyond, joins are shuffled.
BROADCAST_ROWS = 1 << 20
#: Rows for each file of a round's table, as far as they fill the files.
FILE_ROWS = 1 << 17


def _kept(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``df`` written with as many files as about ``rows`` rows fill."""
    return stored(df.coalesce(max(8, rows // FILE_ROWS)), name)


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for every node of ``edges`` (a, b: long).

    Every round takes the least of the neighbours' labels and the label's own label, twice, so the number of
    rounds follows the logarithm of the longest path.  Minima are pre-aggregated and a hub's rows
    are split by Spark's skewed-join handling.  Nothing but a count reaches the driver.
    """
    pairs = edges.select("a", "b").where("a <> b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    n = both.count()
    near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = _kept(near.select("node", F.least("node", "near").alias("label"), F.lit(True).alias("changed")), "labels", n)
    few = F.broadcast if labels.count() <= BROADCAST_ROWS else lambda df: df
    while True:
        near = both.join(few(labels.select(F.col("node").alias("b"), "label")), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("own"))
        step = near.join(few(labels.select("node", "label")), "node").join(few(own), "label").withColumn("new", F.least("label", "own", "near"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        least = F.least("new", "next")
        labels = _kept(step.join(few(jump), "new").select("node", least.alias("label"), (least != F.col("label")).alias("changed")), "labels", n)
        if labels.where("changed").limit(1).count() == 0:
            return labels.select("node", "label")
