"""All registered queries of the library's own operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.queries import aggregates, filters, functions, geo, grid, ingest, joins, maintenance, merge, ordering, relate, search

MODULES = (geo, merge, filters, ordering, joins, relate, aggregates, search, grid, functions, ingest, maintenance)
QUERIES = {name: f for m in MODULES for name, f in m.Q.queries.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.Q.oracles.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points are gated, ordered along a Hilbert curve, numbered, written as an archive and read back by a box."""
    return QUERIES["sc7_feature_query"](spark, sf_dir)
