"""What an export is told beforehand."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators import preflight


def test_names_that_meet_when_cut():
    cut, clashes, many = preflight.name_checks(["formation_a", "Formation_B", "id", "FORMATION_c", "formation_"])
    assert cut == ["formation_a", "Formation_B", "FORMATION_c"] and not many
    assert clashes == [("formation_a", "Formation_B"), ("formation_a", "FORMATION_c"), ("formation_a", "formation_")]
    assert preflight.name_checks([f"f{i}" for i in range(256)])[2] and preflight.name_checks([]) == ([], [], False)


def test_groups_that_a_clip_reads(spark):
    groups = spark.createDataFrame([(10, 0.0, 0.0, 1.0, 1.0), (30, 5.0, 5.0, 6.0, 6.0), (7, None, None, None, None)], "bytes long, xmin double, ymin double, xmax double, ymax double")
    got = lambda *a: tuple(preflight.read_bytes(groups, *a).first())
    assert got() == (47, 30) and got((0.5, 0.5, 2, 2)) == (17, 30) and got((8, 8, 9, 9)) == (7, 30)
    assert tuple(preflight.read_bytes(groups.limit(0)).first()) == (0, 0)


ROWS = [(1, "é", 1.5, True, 0.0, 0.0, bytearray(21), "Point Z"), (2, "abc", None, None, 1.0, 1.0, bytearray(41), "MultiLineString"), (3, None, 2.5, False, 9.0, 9.0, None, "Polygon")]


def layer(spark):
    df = spark.createDataFrame(ROWS, "id long, name string, `a.depth` double, used boolean, xmin double, ymin double, geom binary, kind string")
    return df.withColumns({"xmax": F.col("xmin"), "ymax": F.col("ymin")})


def test_sizes_of_a_shapefile(spark):
    r = preflight.preflight(layer(spark), "shp", "geom", "kind").first()
    shape, table = 100 + 62 + 3 * 40, 33 + 4 * 32 + 3 * (20 + 3 + 24 + 1 + 1)
    text = round(62 * 2.5 + 3 * (40 + 60 + (2 + 20 + 6) + (4 + 3 + 6) + (7 + 24 + 6) + (4 + 1 + 6)))
    assert (r["rows"], r["shape_bytes"], r["table_bytes"], r["json_bytes"], r["peak_bytes"]) == (3, shape, table, text, text + 2 * (shape + table))
    assert r["mixed"] == ["LINESTRING", "POINT"] and not r["over_format"] and not r["over_memory"]  # the polygon has no geometry


def test_a_clip_and_other_formats(spark):
    r = preflight.preflight(layer(spark), "geojson", "geom", "kind", (0, 0, 0.5, 0.5)).first()
    assert (r["rows"], r["peak_bytes"], r["mixed"], r["cut_names"]) == (1, 2 * r["json_bytes"], [], [])
    assert preflight.preflight(layer(spark), "csv", "geom").first()["peak_bytes"] == 0
    empty = preflight.preflight(layer(spark).limit(0), "gdb", "geom", "kind").first()
    assert (empty["rows"], empty["json_bytes"], empty["shape_bytes"], empty["mixed"]) == (0, 0, 100, [])
    with pytest.raises(ValueError):
        preflight.preflight(layer(spark), "dxf", "geom")


def test_large_exports_are_told(spark):
    big = spark.range(60000).select("id", F.lit(bytearray(40000)).alias("geom"), F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(0.0).alias("xmax"), F.lit(0.0).alias("ymax"))
    r = preflight.preflight(big, "shp", "geom").first()
    assert r["over_format"] and r["over_memory"] and not preflight.preflight(big, "gpkg", "geom").first()["over_format"]
