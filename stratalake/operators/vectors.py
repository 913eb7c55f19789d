"""A stored index of vectors by cells of a coarse quantiser: searches read the cells near a query only and rank what they hold exactly.

The folder of an index holds `vectors`, partitioned by cell, `cells` (centre, widest angle and size of each) and `probes`, how many cells a search reads by
default. The centres come from spherical k-means over a sample of SAMPLE_PER_CELL vectors a cell, drawn by a hash of their key; every vector is assigned. The number of probes is measured: the
exact neighbours of sampled queries are looked up in the index, and as many cells are probed as hold the asked share of them.
An exact search reads the cells about each query's own one, and then those that could hold something better, by the angle between query and centre less the cell's widest angle.
Queries and cells meet in blocks: a query is sent once to each part of the index, a run of cells, in which it has some to read, not once a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.search import BLOCK_FLOATS, FEW_BLOCKS, TILE, Best, Block, _first, _tiles, nearest, nonzero, undirected
from stratalake.plans.storage import small, written

#: The k-means sample, in vectors a cell, and its rounds.
SAMPLE_PER_CELL, ROUNDS = 64, 12
#: Cells of an index unless asked for: the root of its vectors, this at most; larger indexes name their own number.
MOST_CELLS = 1024
#: Queries whose exact neighbours are compared when probes are chosen.
TUNING_QUERIES = 200
#: Rows of a query and a part of the index that a task makes at a time, each with its vector.
PROBE_ROWS = 65_536
#: Angles are compared with this slack, far above rounding.
SLACK = 1e-7


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of length 1."""
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def fit_centres(vectors: DataFrame, key: str, emb: str, cells: int) -> np.ndarray:
    """Centres (cells x dims, of length 1) of spherical k-means over the sample; fewer if there are fewer vectors."""
    total, want = vectors.count(), cells * SAMPLE_PER_CELL
    draw = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30))
    sample = vectors.filter(draw < int(min(1.0, 1.2 * want / max(total, 1)) * (1 << 30))).select(F.col(emb).alias("e"), draw.alias("draw"), F.col(key).alias("id"))
    x = _matrix(sample.orderBy("draw", "id").limit(want).select("e").toArrow()["e"].combine_chunks())
    centres = x[: min(cells, len(x))].copy()
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        for c in np.unique(own):
            middle = x[own == c].sum(0)
            length = np.sqrt((middle * middle).sum())
            if length > 0:
                centres[c] = middle / length
    return centres


def write_index(vectors: DataFrame, key: str, emb: str, path: str, cells: int | None = None, k: int = 20, recall: float = 0.95) -> None:
    """Write an index of `vectors` to `path`; vectors that are null or of length zero are left out. `recall` is what probing has to reach for k neighbours."""
    spark = vectors.sparkSession
    rows = vectors.filter(nonzero(emb)).select(F.col(key).cast("long").alias("id"), F.col(emb).cast("array<float>").alias("e"))
    cells = cells or min(MOST_CELLS, int(np.ceil(np.sqrt(rows.count()))))
    centres = fit_centres(rows, "id", "e", cells)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _matrix(batch.column(1)) @ centres.T
                own = near.argmax(1)
                angle = np.arccos(np.clip(near[np.arange(len(own)), own], -1, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(angle), pa.array(own.astype(np.int32))], names=["id", "e", "angle", "cell"])

    placed = rows.mapInArrow(assign, "id bigint, e array<float>, angle double, cell int")
    # Ranges of cell and hash: a large cell is split over tasks, small ones share a task.
    placed.repartitionByRange("cell", F.xxhash64("id")).write.partitionBy("cell").parquet(f"{path}/vectors")
    stored = _vectors(spark, path)
    sizes = stored.groupBy("cell").agg(F.max("angle").alias("angle"), F.count(F.lit(1)).alias("n"))
    middles = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    middles.join(F.broadcast(sizes), "cell").coalesce(1).write.parquet(f"{path}/cells")  # a row a cell
    spark.createDataFrame([_measured(spark, path, k, recall)], "probes int, recall double").coalesce(1).write.parquet(f"{path}/probes")


def _vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id bigint, e array<float>, angle double, cell int").parquet(f"{path}/vectors")


class Cells:
    """The centres of an index and what is known of their cells; its size is that of the quantiser."""

    def __init__(self, spark: SparkSession, path: str):
        rows = spark.read.parquet(f"{path}/cells").orderBy("cell").toArrow()
        self.ids, self.widest = rows["cell"].to_numpy(), rows["angle"].to_numpy()
        self.sizes = dict(zip(self.ids.tolist(), rows["n"].to_pylist()))
        self.centres = _matrix(rows["centre"].combine_chunks()) if len(self.ids) else np.zeros((0, 1))

    def order(self, e: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cells by their nearness to each vector, and the angles in the order of the cells."""
        return self.order_of(_matrix(e))

    def order_of(self, unit: np.ndarray, first: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The same of vectors of length 1; of the cells by nearness the first one only, if that is enough."""
        near = unit @ self.centres.T
        order = near.argmax(1)[:, None] if first else np.argsort(-near, axis=1, kind="stable")
        return order, np.arccos(np.clip(near, -1, 1))


def _packed(sizes: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, blocks) of each item: items that follow each other share a block of at most `most`, a larger item has several of its own."""
    first, blocks, at, held = [], [], 0, 0
    for n in sizes:
        if held and held + n > most:
            at, held = at + 1, 0
        first.append(at)
        blocks.append(max(1, -(-n // most)))
        held += n
        if n > most:
            at, held = at + blocks[-1], 0
    return np.array(first, np.int32), np.array(blocks, np.int32)


class Parts:
    """Runs of cells that a task holds together, with `ids` from 0. Cells that follow each other along the widest axis of the centres share a part; a large one has several."""

    def __init__(self, cells: Cells, most: int, first: bool):
        self.cells, self.nearest_only = cells, first
        middle = cells.centres - cells.centres.mean(0)
        along = np.argsort(middle @ np.linalg.svd(middle, full_matrices=False)[2][0], kind="stable")
        self.first, self.blocks = np.empty((2, len(along)), np.int32)
        self.first[along], self.blocks[along] = _packed([cells.sizes[cells.ids[x]] for x in along], most)
        held = sorted((int(self.first[x]) + y, x) for x in range(len(along)) for y in range(self.blocks[x]))
        part, self.held = np.array([p for p, _ in held]), np.array([x for _, x in held])
        self.ids, self.starts = np.unique(part, return_index=True)

    def order(self, e: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.cells.order_of(_matrix(e), self.nearest_only)

    def own(self, order: np.ndarray) -> np.ndarray:
        """The cells that share a part with the nearest one of each query."""
        return self.first[order[:, 0]][:, None] == self.first[None, :]

    def with_any(self, cells: np.ndarray) -> np.ndarray:
        """A mask of parts from one of cells."""
        return np.logical_or.reduceat(cells[:, self.held], self.starts, axis=1)


def _prober(parts: Parts, choose: Callable):
    """Queries (id, e, least, ...), each once for each part that `choose` (order, angles, least similarity) gives a mask of, in batches of PROBE_ROWS at most."""
    step = max(1, min(TILE, PROBE_ROWS // max(1, len(parts.ids))))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                some = batch.slice(low, step)
                order, angles = parts.order(some.column(1))
                row, at = np.nonzero(choose(order, angles, some.column(2).to_numpy(zero_copy_only=False)))
                taken = [c.take(pa.array(row)) for c in some.columns]
                yield pa.RecordBatch.from_arrays([*taken, pa.array(parts.ids[at].astype(np.int32))], names=[*some.schema.names, "part"])

    return probe


def _met(parts: Parts, choose: Callable):
    """(i, part, cell) of queries (id, e, least, i): the cells that some query of a block probes, and their parts."""
    pairs = np.repeat(parts.ids, np.diff(parts.starts, append=len(parts.held)))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, seen = batch.column(3).to_numpy(), {}
            for x in _tiles(batch.num_rows):
                mask = choose(*parts.order(batch.column(1).slice(x.start, x.stop - x.start)), batch.column(2).to_numpy()[x])
                for i in np.unique(block[x]).tolist():
                    seen[i] = seen.get(i, False) | mask[block[x] == i].any(0)
            for i, mask in seen.items():
                at = np.flatnonzero(mask[parts.held])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(pairs[at].astype(np.int32)), pa.array(parts.cells.ids[parts.held[at]].astype(np.int32))], names=["i", "part", "cell"])

    return met


def _part_best(parts: Parts, choose: Callable, k: int):
    """For queries (id, e, least) and vectors (id, e, cell) of a part: the k best of each query in the cells that it probes, as (q, v, s)."""

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
        left, right = left.sort_by("id"), right.sort_by("cell")
        a, least = Block(left.column("id"), left.column("e"), k), left.column("least").to_numpy()
        cell = right.column("cell").to_numpy()
        bounds = [*np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)).tolist(), len(cell)]
        held = []
        for x, y in zip(bounds, bounds[1:]):
            some = right.slice(x, y - x)
            held.append((int(np.searchsorted(parts.cells.ids, cell[x])), Block(some.column("id"), some.column("e"), k)))
        kept = Best(a, k, np.where(least < -1, -np.inf, least))
        for x in _tiles(len(a.ids)):
            mask = choose(*parts.cells.order_of(a.unit[x], parts.nearest_only), least[x])
            for at, b in held:
                rows = np.flatnonzero(mask[:, at])
                for y in _tiles(len(b.ids)) if len(rows) else ():
                    kept.offer(rows + x.start, b, y, a.near[x][rows] @ b.near[y].T)
        return kept.table()

    return best


def _ranked(asked: DataFrame, spark: SparkSession, path: str, parts: Parts, choose: Callable, k: int) -> DataFrame:
    """(q, v, s): the k best of each query (id, e, least, i) in the cells that it probes; only these cells are read."""
    met = written(asked.mapInArrow(_met(parts, choose), "i int, part int, cell int").distinct(), "met")  # rows of a block and a cell
    probed = [r["cell"] for r in met.select("cell").distinct().collect()]  # a row a cell
    at = np.searchsorted(parts.cells.ids, probed)
    places = spark.createDataFrame([(c, int(parts.first[x]), int(parts.blocks[x])) for c, x in zip(probed, at)], "cell int, first int, blocks int")
    held = _vectors(spark, path).filter(F.col("cell").isin(probed)).select("id", "e", "cell").join(F.broadcast(places), "cell")
    held = held.select("id", "e", "cell", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int").alias("part"))
    held = held.join(small(met), ["part", "cell"])
    cells = lambda order, angles, least: parts.with_any(choose(order, angles, least))
    sent = asked.mapInArrow(_prober(parts, cells), "id bigint, e array<float>, least double, i int, part int")
    return sent.groupBy("i", "part").cogroup(held.groupBy("i", "part")).applyInArrow(_part_best(parts, choose, k), "q bigint, v bigint, s double")


def _asked(queries: DataFrame, key: str, emb: str, parts: Parts, most: int) -> DataFrame:
    """(id, e, i): the queries in blocks of at most `most`, about, near ones together."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = _matrix(batch.column(1))
                first = np.concatenate([parts.first[parts.cells.order_of(unit[x], True)[0][:, 0]] for x in _tiles(len(unit))])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], names=["id", "e", "own"])

    rows = queries.filter(nonzero(emb)).select(F.col(key).cast("long").alias("id"), F.col(emb).cast("array<float>").alias("e"))
    rows = written(rows.mapInArrow(own, "id bigint, e array<float>, own int"), "queries")
    sizes = sorted(rows.groupBy("own").count().collect())  # a row a part
    first, blocks = _packed([n for _, n in sizes], most)
    places = rows.sparkSession.createDataFrame([(p, int(f), int(b)) for (p, _), f, b in zip(sizes, first, blocks)], "own int, first int, blocks int")
    return rows.join(F.broadcast(places), "own").select("id", "e", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int").alias("i"))


def search_index(spark: SparkSession, path: str, queries: DataFrame, key: str, emb: str, k: int, probes: int | None = None, exact: bool = False, block: int | None = None) -> DataFrame:
    """(q, v, s): for each query its k most similar other vectors of the index, s rounded to 12 places; ties go to the smaller key.

    Without `exact`, neighbours outside the probed cells are missed; with it, the result is that of `search.nearest`. A task holds `block` queries and vectors, or about BLOCK_FLOATS numbers of each.
    """
    cells = Cells(spark, path)
    probes = probes or spark.read.parquet(f"{path}/probes").first()["probes"]
    if not cells.sizes:
        return spark.createDataFrame([], "q bigint, v bigint, s double")
    most, total = block or max(1, BLOCK_FLOATS // cells.centres.shape[1]), sum(cells.sizes.values())
    n = queries.count()
    blocks = max(-(-n // most), 1 if block else min(FEW_BLOCKS, -(-n // TILE)), 1)
    few = max(-(-total // most), 1 if block else min(FEW_BLOCKS**2 // blocks, -(-total // TILE)), 1)
    parts = Parts(cells, -(-total // few), exact)
    asked = _asked(queries, key, emb, parts, max(1, -(-n // blocks))).select("id", "e", F.lit(-2.0).alias("least"), "i")

    def nearest_cells(order, angles, least):
        mask = np.zeros(angles.shape, bool)
        np.put_along_axis(mask, order[:, :probes], True, 1)
        return mask

    if not exact:
        return _first(_ranked(asked, spark, path, parts, nearest_cells, k), k)
    found = _first(_ranked(asked, spark, path, parts, lambda order, angles, least: parts.own(order), k), k)
    found = written(found, "probed")
    # What a query without k neighbours could still find is anywhere.
    least = found.groupBy("q").agg(F.when(F.count(F.lit(1)) >= k, F.min("s")).alias("s"))
    again = asked.drop("least").join(least, F.col("id") == F.col("q"), "left").select("id", "e", F.coalesce("s", F.lit(-2.0)).alias("least"), "i")

    def could_be_better(order, angles, least):
        best = np.cos(np.clip(angles - cells.widest[None, :], 0, None))
        return ~parts.own(order) & (best + SLACK >= least[:, None])

    return _first(found.union(_ranked(written(again, "again"), spark, path, parts, could_be_better, k)), k)


def _measured(spark: SparkSession, path: str, k: int, recall: float) -> tuple[int, float]:
    """How many cells hold the asked share of the exact neighbours of sampled queries, and the share that they hold."""
    cells = Cells(spark, path)
    if not cells.sizes:
        return 1, 1.0
    stored = _vectors(spark, path)
    some = stored.select("id", "e").orderBy(F.xxhash64("id", F.lit(7)), "id").limit(TUNING_QUERIES)
    truth = nearest(some, stored, "id", "e", k)
    orders = some.mapInArrow(_orders(cells), "q bigint, cells array<int>")
    place = truth.join(stored.select(F.col("id").alias("v"), "cell"), "v").join(F.broadcast(orders), "q").select(F.array_position("cells", F.col("cell")).alias("p"))
    counts = sorted(place.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect())  # a row a cell
    total, held = sum(n for _, n in counts), 0
    for p, n in counts:
        held += n
        if held >= recall * total:
            return int(p), held / total
    return 1, 1.0


def _orders(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = cells.ids[cells.order(batch.column(1))[0]].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(order.tolist(), pa.list_(pa.int32()))], names=["q", "cells"])

    return run


def index_edges(spark: SparkSession, path: str, k: int, probes: int | None = None, exact: bool = False) -> DataFrame:
    """(src, dst, weight): each indexed vector's k nearest others, each pair once, cell by cell."""
    return undirected(search_index(spark, path, _vectors(spark, path), "id", "e", k, probes, exact))


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(neighbours, found, recall): how many of the exact neighbours (q, v) were found."""
    both = exact.select("q", "v").join(found.select("q", "v", F.lit(1).alias("hit")), ["q", "v"], "left")
    return both.agg(F.count(F.lit(1)).alias("neighbours"), F.count("hit").alias("found")).withColumn("recall", F.try_divide("found", "neighbours"))
