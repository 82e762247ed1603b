"""Connected components of a link table by alternating star contraction, in DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gives_back, shared_table


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's links, as far as they join what earlier ones left apart, each as (node, smallest of its tree).
    Works on bounded blocks, so memory does not follow the partition."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    def out() -> pa.RecordBatch:
        rows = [(x, root(x)) for x in parent]
        rows = [(x, r) for x, r in rows if x != r]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:
            yield out()
            parent.clear()
    yield out()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link to another one.

    Each round links all larger neighbours of a node to its smallest one, then all smaller ones; the number of rounds
    follows the logarithm of the longest path. A round has no more links than the one before, and links is a written
    table, so that it is read twice but made once. Links with nulls and from a node to itself are left out.
    """
    n = links.count()
    rows = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    rows = rows.mapInArrow(gives_back(_forest), "a long, b long").distinct()
    edges = shared_table(rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", n)
    seen = None

    def with_least(rows: DataFrame) -> DataFrame:
        """rows (a, b) with m, the least b of each a. Joined back rather than windowed, so that a large a can be split."""
        return rows.join(rows.groupBy("a").agg(F.min("b").alias("m")), "a")

    while True:
        both = edges.union(edges.select("b", "a"))
        large = with_least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        small = with_least(large).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        edges = shared_table(small.select("x.*").where("a > b").distinct(), "links", n)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
