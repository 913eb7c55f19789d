"""Fingerprints, facets, roll-ups and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.plans.storage import written


def fingerprint(df: DataFrame, signature: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, rows, hash_sum, signature): equal for equal rows in any order. Nulls count by their place."""
    columns = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    total = F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), total.alias("hash_sum")).withColumn("signature", F.lit(signature))


def digest_of(values: Column) -> Column:
    """A digest of a group's values in any order, as an aggregate of fixed size: their number and the sums of two parts of their hashes."""
    part = lambda at: F.sum(F.conv(F.substring(F.md5(values.cast("binary")), at, 12), 16, 10).cast("decimal(20,0)"))
    return F.sha2(F.concat_ws(":", F.count(values), part(1), part(13)).cast("binary"), 256)


def facet_counts(df: DataFrame, facets: dict[str, Column], multi: tuple[str, ...] = ()) -> DataFrame:
    """(facet, value, n) of all facets in one pass; a facet in `multi` is an array, each element counted."""
    values = [F.when(F.lit(True), c) if f in multi else F.array(c) for f, c in facets.items()]
    tag = lambda f: lambda x: F.struct(F.lit(f).alias("facet"), x.alias("value"))
    tagged = [F.transform(v.cast("array<string>"), tag(f)) for f, v in zip(facets, values)]
    pairs = F.explode(F.concat(*tagged))
    return df.select(pairs.alias("p")).select("p.*").filter("value is not null").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n")).orderBy("facet", F.desc("n"), "value")


def keep_selected(counts: DataFrame, selected: DataFrame) -> DataFrame:
    """Counts of the selected (facet, value), 0 where nothing matched."""
    return selected.join(counts, ["facet", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def histogram(df: DataFrame, value: Column, width: int) -> DataFrame:
    """(bin, n) from the least to the largest value in steps of `width`, empty bins included."""
    found = df.select(value.alias("v")).filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    span = found.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    bins = span.filter("low is not null").select("low", F.explode(F.sequence(F.lit(0), F.floor((F.col("high") - F.col("low")) / width).cast("int"))).alias("b"))
    counted = found.crossJoin(F.broadcast(span)).groupBy(F.floor((F.col("v") - F.col("low")) / width).cast("int").alias("b")).agg(F.sum("n").alias("n"))
    return bins.join(counted, "b", "left").select((F.col("low") + F.col("b") * width).alias("bin"), F.coalesce("n", F.lit(0)).alias("n"))


def relief(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """(filter, gain): the rows that come back if a filter alone is dropped, in one pass; only gains, most first."""
    hits = {name: F.coalesce(f, F.lit(False)) for name, f in filters.items()}
    alone = []
    for name in hits:
        others = F.lit(True)
        for other, f in hits.items():
            others = others & (~f if other == name else f)
        alone.append(F.count_if(others).alias(name))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("filter"), F.col(n).alias("gain")) for n in hits]))
    return df.agg(*alone).select(pairs.alias("p")).select("p.*").filter("gain > 0").orderBy(F.desc("gain"), "filter")


def rollup(df: DataFrame, levels: list[str], sums: dict[str, Column]) -> DataFrame:
    """Counts, named sums and the box at every level, from the root (level 0) down."""
    box = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    out = df.rollup(*levels).agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(k) for k, c in sums.items()], *box)
    return out.withColumn("level", len(levels) - F.length(F.replace(F.bin("_g"), F.lit("0"), F.lit("")))).drop("_g")


def split_shared(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows without their verbatim repeats: those with a path of their own, and those that differ but share one."""
    rows = written(df.distinct(), "distinct-rows")
    # Counts meet the rows in a join, whose hot paths Spark can split.
    counts = written(rows.groupBy(F.col(path).alias("_p")).agg((F.count(F.lit(1)) == 1).alias("_own")), "paths")
    counted = rows.join(counts, F.col(path).eqNullSafe(F.col("_p"))).drop("_p")
    return counted.filter("_own").drop("_own"), counted.filter("not _own").drop("_own")


def text_widths(df: DataFrame) -> DataFrame:
    """(column, longest, average) bytes of each text column, in one pass."""
    columns = [c for c, t in df.dtypes if t == "string"]
    stats = df.agg(*[F.struct(F.lit(c).alias("column"), F.max(F.octet_length(c)).alias("longest"), F.avg(F.octet_length(c)).alias("average")).alias(c) for c in columns])
    return stats.select(F.explode(F.array(*columns)).alias("s")).select("s.*")


def short_names(names: DataFrame, column: str, width: int = 10) -> DataFrame:
    """(short, names, n): names that would meet when cut to `width` characters."""
    return names.groupBy(F.lower(F.substring(column, 1, width)).alias("short")).agg(F.array_sort(F.collect_set(column)).alias("names")).withColumn("n", F.size("names")).filter("n > 1")
