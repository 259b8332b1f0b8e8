"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_tasks, find_package, join_counted, stage

BLOCK = 1 << 18  # edges that a task unites at once


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges (a, b) with the least one that it reaches by them; least ones are left out unless alone."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while (root[one] != root[two]).any():
        first, second = root[one], root[two]
        low = np.minimum(first, second)
        np.minimum.at(root, first, low)
        np.minimum.at(root, second, low)
        while (root != root[root]).any():
            root = root[root]
    kept = (root != np.arange(len(nodes))) | (np.bincount(root, minlength=len(nodes)) == 1)
    return nodes[kept], nodes[root[kept]]


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, node): the stars of each block of edges (a, b), from both ends."""
    held, count = [], 0

    def out() -> pa.RecordBatch:
        node, root = _stars(*[np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("a", "b")])
        ends = np.concatenate([node, root]), np.concatenate([root, node])
        return pa.RecordBatch.from_arrays([pa.array(e) for e in ends], ["a", "node"])

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            held.append(batch.slice(at, BLOCK))
            count += held[-1].num_rows
            if count >= BLOCK:
                yield out()
                held, count = [], 0
    if held:
        yield out()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), longs: root is the least node reachable.

    Blocks of edges are replaced by stars that connect the same nodes, so that
    paths are short, and tables have as many tasks as their rows ask for. Then each round gives a node the least label among its own and
    its neighbours', then the label of that label, so that paths shrink by about
    half, until all neighbours have one label. A round is
    written to the shared folder and the next one reads it: lineage stays short
    and a lost executor costs one round at most. Only whether labels differ
    comes to the driver. Hubs, and labels that many nodes have, are counted
    and looked up by broadcast (``join_counted``); minima are taken before the shuffle.

    Self loops and repeated edges do no harm; an edge with a null end is left
    out; no edges give no rows.
    """
    find_package(edges.sparkSession)
    edges = stage(edges.select("a", "b").filter("a is not null and b is not null"), "links")
    count = edges.count()
    stars = few_tasks(edges, count).mapInArrow(_united, "a long, node long").distinct()
    both = stage(few_tasks(stars, 2 * count), "edges")
    count = both.count()
    least = F.least("a", F.min("node")).alias("root")
    labels = both.groupBy("a").agg(least, F.count(F.lit(1)).alias("n")).withColumnRenamed("a", "node")
    labels = stage(few_tasks(labels, count), "labels")
    while True:
        near = join_counted(both, labels, ["node"], "n").groupBy("a").agg(F.min("root").alias("least"), F.max("root").alias("most"))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", "n", "root", F.least("root", "least").alias("mid"), F.greatest("root", "most").alias("most")
        )
        lower = stage(few_tasks(lower, count), "lower")
        if not lower.filter("mid <> most").limit(1).count():
            return labels.select("node", "root")
        mids = lower.groupBy("mid").agg(F.count(F.lit(1)).alias("nodes"))
        of_label = mids.join(labels.select(F.col("node").alias("mid"), F.col("root").alias("far")), "mid")
        of_label = stage(few_tasks(of_label, count), "mids")
        jumped = join_counted(lower.select("node", "n", "mid"), of_label, ["mid"], "nodes")
        labels = stage(few_tasks(jumped.select("node", F.least("mid", "far").alias("root"), "n"), count), "labels")
