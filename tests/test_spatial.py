"""Points, boxes and shapes that touch or repeat, against SQL and brute force."""

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalake import registry
from stratalake.operators import spatial


def against_sql(spark, folder, name, **tables):
    """The rows of a query over small tables, and those of its SQL."""
    con = duckdb.connect()
    for t, query in tables.items():
        con.sql(f"copy ({query}) to '{folder}/{t}.parquet' (format parquet)")
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    found, want = registry.QUERIES[name](spark, str(folder)), con.sql(registry.ORACLES[name])
    return sorted(map(tuple, found.select(*want.columns).collect()), key=str), sorted(want.fetchall(), key=str)


def parts(ids):
    return f"select i::bigint as p_partkey, 'n' as p_name, 'Brand#' || (i * 7 % 5) as p_brand, 't' as p_type, (1 + i * 3 % 50)::int as p_size, 1.0::double as p_retailprice from range({ids}) r(i)"


def test_diamonds_that_touch_the_view(spark, tmp_path):
    got, want = against_sql(spark, tmp_path, "pf8_exact_clip", part=parts("15900, 31000, 20"))
    assert got == want and len(want) >= 20


CUSTOMERS = "select (i %% 1000 + 5000 * (i // 1000))::bigint as c_custkey, 'n' as c_name, 'k' as c_mktsegment from range(%d) r(i)"


@pytest.mark.parametrize("name", ["jn4_spatial_containment_join", "jn4_polygon_containment", "jn4_region_containment", "jn5_bbox_overlap_join", "jn6_top_rank_at_point", "jn7_near_contact_check", "jn23_near_point_features", "jn23_near_features"])
def test_equal_places_and_boxes(spark, tmp_path, monkeypatch, name):
    """Many points a place and many parts a box, so that gathered rows have several parts, are joined once and written out in full."""
    monkeypatch.setattr(spatial, "MEMBERS", 4)
    monkeypatch.setattr(spatial, "TASK_PAIRS", 500)
    shifted = parts("600").replace("select i::bigint as p_partkey", "select (i % 60 + 35000 * (i // 60))::bigint as p_partkey")
    got, want = against_sql(spark, tmp_path, name, customer=CUSTOMERS % 5000, part=shifted)
    assert got == want and len(want) >= 20


def test_a_hot_place_is_split(spark):
    rows = spark.range(5000).select("id", F.lit(1.0).alias("x"), F.when(F.col("id") > 4, 2.0).alias("y"))
    sizes = [(r["y"], len(r["m"])) for r in spatial.gathered(rows, ["x", "y"], "m").collect()]
    assert sum(n for _, n in sizes) == 5000 and max(n for _, n in sizes) < 2 * spatial.MEMBERS and (None, 5) in sizes


def test_a_township_is_read_once(spark):
    """The places of township and range are looked for once each, however often they are used."""
    from stratalake.functions import text

    assert str(text.township(F.col("t"))).count("{1,3}") == 2
