"""Connected components of a table of links, by thinning links to forests and following parents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.tables import written


class Forest:
    """Union-find whose roots are the smallest ids."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.find(x)) for x in self.parent if self.find(x) != x]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition, as a forest: at most one a vertex, before anything is shuffled."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
    links = forest.links()
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])


#: Links that one task finishes; with more, rounds go on.
FEW_LINKS = 100_000


def components(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(u, v): each vertex u of the links (two long columns) that isn't the smallest of its component, and v, which is.

    In a round, links are dealt by their larger end and thinned to a forest in each partition; then each vertex
    moves to the parent of its parent. What hangs on a vertex is never gathered: parents are looked up by a join.
    Once at most `few` links are left, a last task thins them to the result.
    """
    a, b = links.columns
    edges = written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct().mapInArrow(_thinned, "u bigint, v bigint"), "links")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges
        if now[0] <= few:
            return written(edges.repartition(1).mapInArrow(_thinned, "u bigint, v bigint"), "links")
        state = now
        forest = written(edges.repartition("u").mapInArrow(_thinned, "u bigint, v bigint").distinct(), "links")
        parents = forest.groupBy(F.col("u").alias("p")).agg(F.min("v").alias("g"))
        moved = forest.join(parents, F.col("v") == F.col("p"), "left").select("u", F.coalesce("g", "v").alias("v"))
        edges = written(moved.distinct(), "links")
