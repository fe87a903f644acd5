"""Connected components over a table of links.

Links are first contracted: each task unites at most about TASK_LINKS of them in memory and hands on one link per node, to
the least node that it reaches there. If all links fit one task, that is the result. Otherwise alternating large-star and
small-star steps go on until nothing changes; each is an aggregation (with map-side combine) and a join on the
node, written to the shared folder. So no task holds more than a bounded number of links, and only a few numbers per round
reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import discard, materialize

TASK_LINKS = 500_000


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least position of each position's component under the links."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        now = root.copy()
        np.minimum.at(now, i, least)
        np.minimum.at(now, j, least)
        now = now[now]
        if np.array_equal(now, root):
            return root
        # links of roots that met go on at the roots
        root = now
        i, j = root[i], root[j]


def _contract(batches):
    parts = [(np.asarray(b.column("u")), np.asarray(b.column("v"))) for b in batches]
    if parts:
        u, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        nodes, where = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = nodes[roots(len(nodes), where[: len(u)], where[len(u) :])]
        other = nodes != root
        yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(root[other])], ["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v) with u > v. large: links each larger neighbour of a node to the least of its neighbourhood;
    else: links the smaller neighbours of a node, and itself, to the least of them."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Links (a, b) of long nodes -> (node, component) for every node that has a link; component is the least node.

    The result reads a written table; discard(result) deletes it once the result has been written elsewhere.
    """
    links = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), name)
    tasks = max(1, -(-links.count() // TASK_LINKS))
    now = materialize(links.repartition(tasks).mapInArrow(_contract, "u long, v long"), name)
    discard(links)
    seen = None
    while tasks > 1:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen, before = state, now
        now = materialize(_star(_star(now, True), False), name)
        discard(before)
    roots_ = now.select(F.col("v").alias("node")).distinct()
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots_.select("node", F.col("node").alias("component")))
    out._quern_path = now._quern_path
    return out
