"""Tables that refer to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.plans.storage import written


def related_rows(parents: DataFrame, parent_key: str, children: DataFrame, child_key: str) -> DataFrame:
    """Parents with their child rows and `total`, how many there are of a parent; keys are compared as text, as their types may differ.

    Children are counted by key before the join, so that a parent of very many is an ordinary skewed key, which Spark splits. A null key refers to nothing.
    """
    key = F.col(child_key).cast("string")
    totals = written(children.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("total")).filter("_k is not null"), "totals")
    counted = parents.join(totals, F.col(parent_key).cast("string") == F.col("_k"))
    return counted.join(children.withColumn("_c", key), F.col("_k") == F.col("_c")).drop("_k", "_c")


def outgoing_links(relations: DataFrame, tables: DataFrame) -> DataFrame:
    """(origin, target, kind, keys): for each origin and target of the declared relations, a link if the target is spatial, else a related table.

    `relations` has (origin, target, source_columns, target_columns), `tables` (name, spatial); a target that isn't known is a table. Several relations to one target are the keys
    of one entry, each with its columns from and to: of a table, which is filtered by a clicked row of the origin, they run from the table's columns to the origin's.
    """
    known = relations.join(tables.select(F.col("name").alias("target"), "spatial"), "target", "left").withColumn("link", F.coalesce("spatial", F.lit(False)))
    one, other = F.when(F.col("link"), F.col("source_columns")).otherwise(F.col("target_columns")), F.when(F.col("link"), F.col("target_columns")).otherwise(F.col("source_columns"))
    keys = F.array_sort(F.collect_set(F.struct(one.alias("columns"), other.alias("to"))))  # the declared keys of two tables
    return known.groupBy("origin", "target", "link").agg(keys.alias("keys")).select("origin", "target", F.when(F.col("link"), "link").otherwise("table").alias("kind"), "keys")


def incoming_links(relations: DataFrame, target: str | int) -> DataFrame:
    """(origin, keys): the tables whose declared relations point at `target`, with their own columns first."""
    keys = F.array_sort(F.collect_set(F.struct(F.col("source_columns").alias("columns"), F.col("target_columns").alias("to"))))
    return relations.filter(F.col("target") == target).groupBy("origin").agg(keys.alias("keys"))
