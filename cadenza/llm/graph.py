"""Connected components as Spark joins (alternating large and small stars)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import BROADCAST_ROWS, in_batches, stored

# Links that a task joins to stars at a time; bounds its dictionary of nodes.
# Fewer links are no work for several tasks.
LOCAL_LINKS = 1 << 16


def _stars(links: list[tuple[int, int]]) -> pa.RecordBatch:
    """Every node of ``links`` but the smallest of its part with that smallest one."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    out = [(x, root(x)) for x in list(up)]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out if x[0] != x[1]], pa.int64()) for i in range(2)], ["a", "b"])


def _local(batches):
    links: list[tuple[int, int]] = []
    for batch in batches:
        links += zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
        if len(links) >= LOCAL_LINKS:
            yield _stars(links)
            links = []
    if links:
        yield _stars(links)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; component is the
    smallest node reachable.

    Tasks of some ``LOCAL_LINKS`` first join their links to stars. Each round then hooks
    every node's larger neighbours to its smallest one and its smaller ones
    too, until the edges form stars: no node has two larger or smaller ends, and
    none is both. Minima are partially aggregated, so a node with very many
    links is folded inside each task; a few of them are broadcast, more are
    shuffled, and every round is written to the shared folder.
    """
    few = links.where("a <> b").select("a", "b").coalesce(1 + links.count() // LOCAL_LINKS)
    edges = stored(few.transform(in_batches, _local, "a long, b long").distinct(), name)
    while True:
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_, n = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).agg(F.count_if(F.expr("up + down > 1 AND up > 0")), F.count("*")).first()
        if not open_:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        near = F.broadcast if n <= BROADCAST_ROWS else lambda x: x
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(near(low), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(near(low), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), name)
