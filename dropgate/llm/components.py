"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _contract(batches):
    """The edges of one task as stars around the smallest node of each part."""
    up: dict[int, int] = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    nodes = [x for x in up if root(x) != x]
    for at in range(0, len(nodes), 65536):
        part = nodes[at : at + 65536]
        yield pa.RecordBatch.from_arrays([pa.array([root(x) for x in part], pa.int64()), pa.array(part, pa.int64())], schema=_EDGES)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); comp is the smallest node of the component.

    Each task first contracts its own edges to stars.  Then every round sends labels along edges in both directions
    and replaces each label by its own label, so the number of rounds grows with the logarithm of the diameter.
    Messages are minimised before the shuffle.
    """
    stars = edges.select("a", "b").where("a <> b").distinct().mapInArrow(_contract, "a long, b long")
    both = store(stars.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*"), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "comp", F.lit(None).cast("long").alias("old"))
        near = labels.select("node", "comp", F.col("comp").alias("old")).unionByName(heard).groupBy("node").agg(F.min("comp").alias("comp"), F.max("old").alias("old"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = store(near.join(jump, "comp", "left").select("node", F.least("comp", "up").alias("comp"), "old"), "labels")
        discard(labels)
        labels = new
        if new.where("comp <> old").isEmpty():
            discard(both)
            return labels.select("node", "comp")
