"""Keyed merges and version diffs."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_hash(df: DataFrame, *leave_out: str) -> Column:
    """A hash of a row's columns in which nulls count by their place."""
    columns = [c for c in df.columns if c not in leave_out]
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def guard_keys(source: DataFrame, key: str) -> None:
    """Refuse a source with a null key."""
    if not source.filter(F.col(key).isNull()).isEmpty():
        raise ValueError(f"a source row has no {key}")


def delta_keys(target: DataFrame, source: DataFrame, key: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """The keys that are new or changed. Only keys and hashes are joined."""
    ours = target.select(F.col(key).alias("_k"), row_hash(target.select(source.columns), key, *leave_out).alias("_h"))
    theirs = source.select(F.col(key), row_hash(source, key, *leave_out).alias("_new"))
    return theirs.join(ours, F.col(key) == F.col("_k"), "left").filter(~F.col("_h").eqNullSafe(F.col("_new"))).select(key)


def upsert(target: DataFrame, source: DataFrame, key: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """`target` with the delta rows of `source`; rows that haven't changed stay as they are."""
    delta = delta_keys(target, source, key, leave_out)
    return target.join(delta, key, "left_anti").unionByName(source.join(delta, key, "left_semi"))


def merge(target: DataFrame, source: DataFrame, key: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """An upsert that also drops the rows whose key the source no longer has."""
    guard_keys(source, key)
    return upsert(target, source, key, leave_out).join(source.select(key), key, "left_semi")


def publish(df: DataFrame, path: str) -> str:
    """Write a version and then a pointer to it, in a folder of its own: no pointer is ever overwritten, and a version without one isn't seen."""
    version = f"{time.time_ns():020}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/v-{version}")
    df.sparkSession.createDataFrame([(version,)], "version string").coalesce(1).write.json(f"{path}/pointers/{version}")
    return version


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version whose pointer is whole."""
    pointers = spark.read.schema("version string").json(f"{path}/pointers/*")
    return spark.read.parquet(f"{path}/v-{pointers.agg(F.max('version')).first()[0]}")


def lake_mode(target: DataFrame | None, source: DataFrame, key: str | None) -> tuple[str, list[str]]:
    """How to write: merge when keyed and of the same schema, else replace; with warnings about a lost key."""
    if target is None:
        return "replace", []
    lost = bool(key) and key in target.columns and key not in source.columns
    same = sorted(target.dtypes) == sorted(source.dtypes)
    return ("merge" if key and key in source.columns and same else "replace"), [f"the source has no {key}"] if lost else []


def _sides(old: DataFrame, new: DataFrame, match: Column, attributes: list[str]) -> DataFrame:
    digest = F.md5(F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}))
    each = lambda df, side: df.groupBy(match.alias(f"{side}_k")).agg(F.min(F.struct(digest.alias("d"), F.struct(*attributes).alias("row"))).alias(side), F.count(F.lit(1)).alias(f"{side}_n")).select("*")
    return each(old, "o").join(each(new, "n"), F.col("o_k") == F.col("n_k"), "full_outer")


def diff_summary(old: DataFrame, new: DataFrame, match: Column, attributes: list[str]) -> DataFrame:
    """Counts of added, removed, modified and unchanged rows, matched by `match`; equal ones count once, null ones never match."""
    s = _sides(old, new, match, attributes)
    both = F.col("o_k").isNotNull() & F.col("n_k").isNotNull()
    return s.agg(
        F.count_if(F.col("o").isNull()).alias("added"), F.count_if(F.col("n").isNull()).alias("removed"), F.count_if(both & (F.col("o.d") != F.col("n.d"))).alias("modified"),
        F.count_if(both & (F.col("o.d") == F.col("n.d"))).alias("unchanged"), F.sum("o_n").alias("old_rows"), F.sum("n_n").alias("new_rows"),
    )


def diff_rows(old: DataFrame, new: DataFrame, match: Column, attributes: list[str]) -> DataFrame:
    """(key, change, fields): each changed row, with the old and new text of each modified field."""
    s = _sides(old, new, match, attributes)
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o.d") != F.col("n.d"), "modified")
    text = lambda side, c: F.col(f"{side}.row.{c}").cast("string")
    fields = F.filter(F.array(*[F.struct(F.lit(c).alias("col"), text("o", c).alias("old"), text("n", c).alias("new")) for c in attributes]), lambda x: ~x["old"].eqNullSafe(x["new"]))
    return s.select(F.coalesce("o_k", "n_k").alias("key"), change.alias("change"), F.when(change == "modified", fields).alias("fields")).filter("change is not null")
