"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.session import drop_stored

from .common import stored

#: Links that one task reduces to a spanning forest at a time.
HELD = 1_000_000


def forest(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links that span the same components, towards each component's least name."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in parent if root(x) != x]


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of a task's links; fewer links, the same components."""
    def reduced(held: list) -> pa.RecordBatch:
        found = forest(held)
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    held: list[tuple[int, int]] = []
    for batch in batches:
        held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        if len(held) >= HELD:
            yield reduced(held)
            held = []
    yield reduced(held)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id linked to another in ``links`` (columns ``a``, ``b``; no nulls): the smallest id reachable.

    First each task reduces its links to a spanning forest, so a dense component is not carried with all its links.
    Each round every node takes the least label among its own and its neighbours', then the label of
    that label; the number of rounds grows with the logarithm of a component's diameter. Rounds are
    written to the shared checkpoint folder, so the plan does not grow and nothing is kept in memory."""
    tasks = max(4, int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    links = links.where("a <> b").select("a", "b").repartition(tasks).mapInArrow(_spanning, "a bigint, b bigint")
    links = spanning = stored(links, "links-spanning")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "links")
    drop_stored(spanning)
    labels = held = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("other")), "b")
        least = seen.groupBy("a").agg(F.min("other").alias("other"))
        nearer = labels.join(least, "a").select("a", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        jump = labels.select(F.col("a").alias("label"), F.col("label").alias("beyond"))
        new = nearer.join(jump, "label", "left").select("a", "old", F.least("label", "beyond").alias("label"))
        before, held = held, stored(new, "labels")
        drop_stored(before)
        new = held
        if new.where("label <> old").isEmpty():
            drop_stored(both)
            return new.select(F.col("a").alias("id"), F.col("label").alias("component"))
        labels = new.select("a", "label")
