"""A sorted copy of a table with a directory of its blocks, so that a page at any depth, or a row's place, reads one block and the counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 100_000
#: Ranges that a table is sorted in at most; a range holds many blocks, so that what is sampled for its bounds doesn't grow with them.
RANGES = 256


def _sorting(order: list[tuple[str, bool]]) -> list[Column]:
    return [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in order]


def _ahead(order: list[tuple[str, bool]], of: dict[str, Column], prefix: str = "") -> Column:
    """Whether a row sorts before the values of `of`; nulls come last either way."""
    before, tied = F.lit(False), F.lit(True)
    for c, up in order:
        here, there = F.col(prefix + c), of[c]
        less = (here < there) if up else (here > there)
        before = before | (tied & F.coalesce(less, here.isNotNull() & there.isNull()))
        tied = tied & here.eqNullSafe(there)
    return before


def write_pages(df: DataFrame, order: list[tuple[str, bool]], path: str, block_rows: int = BLOCK_ROWS) -> None:
    """Write `df` in the order of (column, ascending), which should tell all rows apart, with nulls last, as `path`/rows, a file a block, and `path`/blocks.

    Blocks are stretches of ranges of the order, of `block_rows` at most; a row keeps its place in its block. Blocks are numbered in order, with gaps.
    """
    rows = df.count()
    ranges = min(RANGES, max(1, -(-rows // block_rows)))
    ranged = df.repartitionByRange(ranges, *_sorting(order)).sortWithinPartitions(*_sorting(order))
    placed = ranged.withColumns({"_row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1), "_range": F.spark_partition_id().cast("long")})
    number = F.col("_range") * (rows // block_rows + 1) + F.expr(f"_row div {block_rows}")
    placed = placed.withColumns({"_place": F.col("_row") % block_rows, "_block": number}).drop("_row", "_range")
    placed.write.partitionBy("_block").parquet(f"{path}/rows")
    stored = df.sparkSession.read.parquet(f"{path}/rows")
    first = F.min_by(F.struct(*[c for c, _ in order]), "_place").alias("first")
    counts = stored.groupBy("_block").agg(F.count(F.lit(1)).alias("rows"), first)
    before = F.coalesce(F.sum("rows").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a block
    counts.select("_block", "rows", before.alias("before"), "first").coalesce(1).write.parquet(f"{path}/blocks")


def _directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/blocks")


def read_page(spark: SparkSession, path: str, limit: int, offset: int = 0) -> DataFrame:
    """The rows from `offset` on, in order; only the blocks that hold them are read."""
    held = _directory(spark, path).filter((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)).select("_block", "before").collect()
    rows = spark.read.parquet(f"{path}/rows")
    place = F.lit(None).cast("long")
    for r in held:  # the blocks of a page
        place = F.when(F.col("_block") == r["_block"], F.col("_place") + r["before"]).otherwise(place)
    page = rows.filter(F.col("_block").isin([r["_block"] for r in held])).withColumn("_at", place)
    return page.filter((F.col("_at") >= offset) & (F.col("_at") < offset + limit)).orderBy("_at").drop("_at", "_place", "_block")


def total(spark: SparkSession, path: str) -> int:
    return _directory(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def place_of(spark: SparkSession, path: str, order: list[tuple[str, bool]], values: dict) -> int:
    """How many rows sort before one with these values of the order's columns; one block is read."""
    types = dict(spark.read.parquet(f"{path}/rows").dtypes)
    of = {c: F.lit(values[c]).cast(types[c]) for c, _ in order}
    block = _directory(spark, path).select("_block", "before", "first.*").filter(_ahead(order, of)).orderBy(F.desc("_block")).limit(1).first()
    if block is None:
        return 0
    inside = spark.read.parquet(f"{path}/rows").filter((F.col("_block") == block["_block"]) & _ahead(order, of))
    return block["before"] + inside.count()
