"""Connected components of link tables, and spanning forests inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (a[i], b[i]) with the smallest node it reaches, for
    the nodes that are not that node: as many rows as nodes, not as links."""
    if not len(a):
        return a[:0], b[:0]
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[:len(a)], inverse[len(a):]
    label = np.arange(len(nodes))
    while True:
        lx, ly = label[x], label[y]
        live = lx != ly
        if not live.any():
            break
        x, y, lx, ly = x[live], y[live], lx[live], ly[live]
        low = np.minimum(lx, ly)
        np.minimum.at(label, np.maximum(lx, ly), low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node reached.

    Each round maps every node towards its smallest neighbour (a few pointer
    jumps), replaces the ends of the links by it and drops what became a loop,
    so the links shrink geometrically.  Hot nodes are plain equi-join keys whose
    partitions AQE splits; minima are combined before they are shuffled."""
    links = stored(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter(F.col("a") != F.col("b")).distinct())
    rounds = []
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("near")))
        up = stored(both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root")))
        one = up
        for _ in range(2):
            jump = up.withColumnsRenamed({"node": "via", "root": "root2"})
            up = up.join(jump, up["root"] == jump["via"]).select("node", F.col("root2").alias("root"))
        up = stored(up, one)
        rounds.append(up)
        before = links
        for end in ("a", "b"):
            m = up.withColumnsRenamed({"node": "node2", "root": "root2"})
            links = links.join(m, links[end] == m["node2"]).withColumn(end, F.col("root2")).drop("node2", "root2")
        links = stored(links.filter(F.col("a") != F.col("b")).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), before)
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0]
    for later in rounds[1:]:
        m = later.withColumnsRenamed({"node": "node2", "root": "root2"})
        out = out.join(m, out["root"] == m["node2"], "left").select("node", F.coalesce("root2", "root").alias("root"))
    return stored(out, *rounds) if len(rounds) > 1 else out
