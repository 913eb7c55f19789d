"""What the query modules share: a register, and the tables that stand in for layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Register:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def add(f):
            self.queries[name] = f
            if sql:
                self.oracles[name] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Points of the customers and boxes of the parts, in expressions that Spark and DuckDB share.
POINTS = "select c_custkey as id, c_name as name, c_mktsegment as kind, -114 + (c_custkey * 37 % 5000) / 1000.0e0 as x, 37 + (c_custkey * 53 % 5000) / 1000.0e0 as y from customer"
BOXES = """select p_partkey as id, p_name as name, p_brand as kind, p_size as size,
    -114 + (p_partkey * 91 % 5000) / 1000.0e0 as xmin, 37 + (p_partkey * 17 % 5000) / 1000.0e0 as ymin,
    -114 + (p_partkey * 91 % 5000) / 1000.0e0 + (p_partkey % 40) / 200.0e0 as xmax, 37 + (p_partkey * 17 % 5000) / 1000.0e0 + (p_partkey % 7) / 50.0e0 as ymax from part"""
#: A second version of the orders: some keys are gone, some rows edited, some keys new.
ORDERS2 = """select o_orderkey, o_custkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as o_orderstatus, o_totalprice, o_orderpriority
    from orders where o_orderkey % 11 <> 0
    union all select o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderkey % 13 = 0"""


def sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    """`text` over the named tables, bound as DataFrames rather than as views of the session."""
    import re

    frames = {t: table(spark, sf_dir, t) for t in tables}
    for t in tables:
        text = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **frames)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, POINTS, "customer")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, BOXES, "part")
