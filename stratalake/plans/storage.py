"""Tables that are written once and read back, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark `df` for a broadcast if it has at most `limit` rows; otherwise leave the join to Spark."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def row_bytes(df: DataFrame) -> Column:
    """The bytes of a row's values, large ones included: text and binary by their length, nested ones by their JSON, the rest 8 each."""

    def size(c: str, t: str) -> Column:
        if t in ("string", "binary"):
            return F.coalesce(F.octet_length(f"`{c}`"), F.lit(0))
        return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`").alias("v")))), F.lit(0)) if t.startswith(("array", "map", "struct")) else F.lit(8)

    total = F.lit(0).cast("long")
    for c, t in df.dtypes:
        total = total + size(c, t).cast("long")
    return total
