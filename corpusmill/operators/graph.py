"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.scratch import cut


#: Up to so many edges, which take a few dozen megabytes, one task finds the components.
SMALL = 1_000_000


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, root of all edges (u, v) of one task: least labels spread along the edges, and labels of labels at once."""
    held = list(batches)
    if not held:
        return
    ends = [pa.chunked_array([b.column(i) for b in held]).to_numpy() for i in (0, 1)]
    nodes, place = np.unique(np.concatenate(ends), return_inverse=True)
    u, v = place[: len(ends[0])], place[len(ends[0]) :]
    label = np.arange(len(nodes))
    while (label[u] != label[v]).any():
        low = np.minimum(label[u], label[v])
        for side in (u, v):
            np.minimum.at(label, label[side], low)
        while (label[label] != label).any():
            label = label[label]
    kind = held[0].schema.field(0).type
    yield pa.record_batch([pa.array(nodes, kind), pa.array(nodes[label], kind)], names=["node", "root"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: each node of edges (u, v) with its component's least node.

    Large-star and small-star steps in turn, each a join and an aggregation; they end in stars around the roots, after about
    log2(nodes) rounds.  Up to SMALL edges go through one task instead.  Lineage is cut by checkpoint().  Null ends are
    ignored.  Raises if the rounds don't suffice."""
    here = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    if here.count() <= SMALL:
        kind = dict(here.dtypes)["u"]
        return cut(here.coalesce(1).mapInArrow(stars, f"node {kind}, root {kind}"))
    seen = None
    for _ in range(most_rounds):
        mark = here.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF))).first()
        if mark == seen or not mark[0]:
            ends = here.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return here.select(F.col("u").alias("node"), F.col("v").alias("root")).union(ends)
        seen = mark
        sides = here.union(here.select("v", "u"))
        low = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        here = cut(large.join(low, "u").select(F.explode(ends).alias("e")).select("e.u", "e.v").filter("u <> v").distinct())
    raise RuntimeError("components: more rounds are needed")
