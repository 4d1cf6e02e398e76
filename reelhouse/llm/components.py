"""Connected components of a table of links, by alternating stars.

Large star hangs every larger neighbour of a node on the node's smallest
neighbour, small star does the same for smaller neighbours; repeated until
nothing changes, every node hangs on the smallest of its component. Both are a
minimum per node and a join, so a node with very many links is pre-aggregated in
the scanning tasks and its join is one AQE can split.

Before each round every task joins what its own links, ``CHUNK`` of them, say about
components, which moves nothing and leaves fewer links and fewer rounds. Links that are
no more than one task's share are done with that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.text import Scratch

#: Links a task joins at a time.
CHUNK = 1_000_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links but the smallest of its component, and that smallest one."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    one, two = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        a, b = root[one], root[two]
        if (a == b).all():
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hung], nodes[root[hung]]


def _within_tasks(edges: DataFrame) -> DataFrame:
    """Links with the same components: stars of what each task has of them."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> pa.RecordBatch:
            ends = [np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in contracted(*ends)], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                yield stars()
                held.clear()
        if held:
            yield stars()

    return edges.select("u", "v").mapInArrow(joined, "u long, v long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.unionByName(turned) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = both.join(least, "u")
    if large:
        return hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def smallest_reachable(links: DataFrame, keep: Scratch | None = None) -> DataFrame:
    """(row, class) of every end of ``links`` (a, b): the smallest row it reaches.

    The result is a table of ``keep``; those of the rounds are deleted.
    """
    def told(edges: DataFrame):
        return edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    rounds = Scratch()
    greater, least = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = rounds.stored(_within_tasks(links.where("a != b").select(greater, least)), "links")
    while n := edges.count():
        tasks = -(-n // CHUNK)
        edges = rounds.stored(_within_tasks(edges.coalesce(tasks)), "links")
        rounds.drop(edges)
        if tasks == 1:  # which has seen all links
            break
        state = told(edges)
        # repeated edges between the two stars do no harm
        after = _star(_star(edges, True).where("u != v"), False).where("u != v").distinct()
        edges = rounds.stored(after, "links")
        rounds.drop(edges)
        if told(edges) == state:
            break
    heads = edges.select(F.col("v").alias("row")).distinct().withColumn("class", F.col("row"))
    found = edges.select(F.col("u").alias("row"), F.col("v").alias("class")).unionByName(heads)
    found = (keep or Scratch()).stored(found, "classes")
    rounds.drop()
    return found
