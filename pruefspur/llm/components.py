"""Connected components of links: union-find within tasks, then shared labels between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..hadoop import reliable


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links, cut to one row per node: the smallest node it is tied to here."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = list(parent)
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([find(n) for n in part], pa.int64())], names=["a", "b"]
        )


#: Links that one task takes in: about 100 MB of its memory.
LINKS_A_TASK = 400_000


def components(links: DataFrame, links_a_task: int = LINKS_A_TASK) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links(a, b)``.

    The links are dealt to as many tasks as their number asks for, and each task ties its own share;
    the driver holds counts.  Where there is more than one task, their trees are tied by passes: each takes
    the smallest label among a node's neighbours and then the label of that label, and is written to
    the checkpoint folder, so a lost executor costs no more than one pass.
    """
    links = reliable(links.select("a", "b"))
    tasks = max(1, -(-links.count() // links_a_task))
    tied = links.coalesce(tasks).mapInArrow(_forest, "a bigint, b bigint")
    if tasks == 1:
        return tied.select(F.col("a").alias("node"), F.col("b").alias("component"))
    both = reliable(tied.unionByName(tied.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = reliable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("l")), "b")
            .groupBy("a")
            .agg(F.min("l").alias("l"))
        )
        lower = labels.join(near, "a").select(
            "a", F.col("label").alias("old"), F.least("label", "l").alias("label")
        )
        jump = lower.select(F.col("a").alias("label"), F.col("label").alias("up"))
        new = reliable(lower.join(jump, "label", "left").select("a", "old", F.coalesce("up", "label").alias("label")))
        changed = new.filter(F.col("old") != F.col("label")).limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
