"""Connected components of a link table.

First each batch of links is joined by itself (union-find over the batch
only).  Each round then contracts: every node points to its smallest
neighbour, pointers are jumped to the end, links are renamed and made distinct.
The number of links at least halves with every round.  Tables are cut from
their lineage in the shared folder; both sides of every join are plain tables
there, so adaptive execution can split a hot root.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from webloom.llm.common import Scratch

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its tree) of the links a-b, roots left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, high, low)
        while (nxt := root[root]).tolist() != root.tolist():
            root = nxt
        open_ = root[x] != root[y]
        x, y = x[open_], y[open_]
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _joined(batches):
    for batch in batches:
        node, root = forest(batch.column("a").to_numpy(), batch.column("b").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])


def _flat(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """Parents replaced by the ends of their chains."""
    while True:
        jumped = Observation()
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        new = scratch.save(
            parents.join(up, "parent", "left").observe(jumped, F.count("up").alias("n"))
            .select("node", F.coalesce("up", "parent").alias("parent")))
        scratch.drop(parents)
        parents = new
        if not jumped.get["n"]:
            return parents


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of
    ``links`` (a long, b long; self links and repeats allowed, nulls are not
    links) that is not its component's smallest."""
    edges = scratch.save(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
                         .filter("a <> b").mapInArrow(_joined, "a long, b long"))
    maps = []
    while edges.take(1):
        smaller = (edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent"))
                   .groupBy("node").agg(F.min("parent").alias("parent")))
        parents = _flat(scratch.save(smaller), scratch)
        maps.append(parents)
        for end in ("a", "b"):
            edges = edges.join(parents.select(F.col("node").alias(end), "parent"), end, "left") \
                .withColumn(end, F.coalesce("parent", end)).drop("parent")
        edges = scratch.save(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = maps[0]
    for later in maps[1:]:
        old, out = out, scratch.save(
            out.join(later.select(F.col("node").alias("parent"), F.col("parent").alias("up")), "parent", "left")
            .select("node", F.coalesce("up", "parent").alias("parent")).unionByName(later))
        scratch.drop(old)
    return out.withColumnRenamed("parent", "component")
