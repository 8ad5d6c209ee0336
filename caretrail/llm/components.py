"""Connected components of links between ids, by contraction in the tasks and star rounds between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.llm.stored import Scratch

EDGES = "a long, b long"


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the edges of a task, each node linked to the least of its tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
                parent.setdefault(min(a, b), min(a, b))
    pairs = [(x, r) for x in parent if (r := root(x)) != x]
    for at in range(0, len(pairs), 100_000):
        some = np.array(pairs[at : at + 100_000], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(some[:, 0]), pa.array(some[:, 1])], names=["a", "b"])


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(id, component) of every id that is linked to a lesser one; component is the least id of its component.

    Edges run from the greater id to the lesser. A round moves each edge to what its lesser end points at (large star), then
    links all that an id points at to the least of them (small star); both are an aggregate with a map-side combine and
    a join. The aggregates are stored, so that both sides of a join are dealt anew and Spark splits hot ids. Rounds are logarithmic in the number of ids, and none holds a component in one place.
    """
    edge = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edge = scratch.store(edge.mapInArrow(forest, EDGES).distinct(), f"{name}-0")
    for turn in range(1, 100):
        least = scratch.store(edge.groupBy("a").agg(F.min("b").alias("m")), f"{name}-{turn}-up")
        up = edge.join(least.select(F.col("a").alias("b"), "m"), "b", "left")
        large = up.select("a", F.coalesce("m", "b").alias("b")).distinct()
        large = scratch.store(large, f"{name}-{turn}-large")
        least = scratch.store(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-{turn}-down")
        both = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        moved = scratch.store(both.select("e.a", "e.b").where("a <> b").mapInArrow(forest, EDGES).distinct(), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        edge = moved
        # Done when every id points at one other, which points nowhere.
        rows, ids = edge.agg(F.count("*"), F.count_distinct("a")).first()
        if rows == ids and edge.join(edge.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return edge.select(F.col("a").alias("id"), F.col("b").alias("component"))
    raise RuntimeError("components did not settle")
