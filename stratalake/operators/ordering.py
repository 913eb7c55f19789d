"""Ranks, pages and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.plans.storage import small, written


def numbered(df: DataFrame, order: list, name: str = "feature_id") -> DataFrame:
    """`df` with 1..N in the given total order.

    Rows are range-partitioned and sorted once and written; a row's number is its place in its partition plus
    the rows of the partitions before, so no task sees more than its own range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranked")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")


def numbered_within(df: DataFrame, group: list[str], order: list, name: str) -> DataFrame:
    """`df` with 1..n within each group: numbers of the whole order less those before the group, so a large group is no hot key."""
    all_ = written(numbered(df, [*group, *order], "_number"), "numbered")
    first = all_.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(F.min("_number").alias("_first"))
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = all_.join(small(written(first, "firsts")), same)
    return out.withColumn(name, F.col("_number") - F.col("_first") + 1).drop("_number", "_first", *[f"_g{i}" for i in range(len(group))])


def page(df: DataFrame, sort: Column | None, tiebreak: str, limit: int, offset: int = 0) -> DataFrame:
    """One page in the order of `sort` (nulls last is the caller's choice of sort), then of `tiebreak`."""
    ordered = df.orderBy(sort, tiebreak) if sort is not None else df.orderBy(tiebreak)
    return ordered.offset(offset).limit(limit)


def ordinal(df: DataFrame, order: list[tuple[str, bool]], key: str, value) -> DataFrame:
    """The 0-based position of one row: the number of rows that sort before it. No sort of the table is needed."""
    row = F.broadcast(df.filter(F.col(key) == value).select(*[F.col(c).alias(f"_{c}") for c, _ in order], F.col(key).alias("_key")).limit(1))
    before, tied = F.lit(False), F.lit(True)
    for column, up in [*order, (key, True)]:
        mine, other = F.col(column), F.col("_key" if column == key else f"_{column}")
        ahead = (mine < other) if up else (mine > other)
        first = F.coalesce(ahead, mine.isNotNull() & other.isNull())  # nulls last
        before = before | (tied & first)
        tied = tied & mine.eqNullSafe(other)
    return df.crossJoin(row).agg(F.count_if(before).alias("ordinal"))


def best_per_group(df: DataFrame, group: str, score: Column, tiebreak: str, k: int | None = None) -> DataFrame:
    """The row of the least `score` of each group, and of those the first k."""
    order = F.struct(score.alias("_s"), F.col(tiebreak).alias("_t"))
    best = df.groupBy(F.col(group).alias("_g")).agg(F.min_by(F.struct(*df.columns), order).alias("_row"), F.min(order).alias("_o"))
    best = best.orderBy("_o").limit(k) if k else best
    return best.select("_row.*")


def shard(key: Column, n: int) -> Column:
    """A stable shard of a key, whatever its case."""
    return F.pmod(F.crc32(F.upper(key.cast("string")).cast("binary")), F.lit(n))


def edition_graph(df: DataFrame, group: list[str], year: str, key: str) -> DataFrame:
    """Per group in order of year: version (the year), predecessor, successor, latest (null for the latest itself) and deprecated.

    Rows without a four-digit year and rows whose year is shared within the group are left out; `left_out` names them.
    """
    dated = df.withColumn("_y", F.trim(F.col(year).cast("string"))).filter(F.col("_y").rlike("^[0-9]{4}$"))
    alone = dated.groupBy(*group, "_y").agg(F.count(F.lit(1)).alias("_c"), F.first(key).alias("_k")).filter("_c = 1")
    w = Window.partitionBy(*group).orderBy("_y")  # one row a year at most
    last = F.last("_k").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    linked = alone.withColumns({"version": F.col("_y"), "predecessor": F.lag("_k").over(w), "successor": F.lead("_k").over(w), "latest": F.when(last != F.col("_k"), last)})
    linked = linked.select(F.col("_k").alias(key), "version", "predecessor", "successor", "latest", F.col("successor").isNotNull().alias("deprecated"))
    return df.join(linked, key)


def left_out(df: DataFrame, group: list[str], year: str, key: str) -> DataFrame:
    """(key, reason) of the rows that have no place in the edition graph."""
    y = F.trim(F.col(year).cast("string"))
    good = F.coalesce(y.rlike("^[0-9]{4}$"), F.lit(False))
    ties = df.filter(good).groupBy(*group, y.alias("_y")).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    ties = ties.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_y")
    same = y == F.col("_y")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return df.filter(~good).select(key, F.lit("no year").alias("reason")).unionAll(df.filter(good).join(ties, same).select(key, F.lit("year is shared").alias("reason")))


def work_order(items: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    """Items that were never tried first, then retries by number of tries; settled ones are left out."""
    log = attempts.groupBy(key).agg(F.count(F.lit(1)).alias("tries"), F.bool_or("settled").alias("settled"))
    return items.join(log, key, "left").filter(~F.coalesce("settled", F.lit(False))).withColumns({"tries": F.coalesce("tries", F.lit(0))}).drop("settled")
