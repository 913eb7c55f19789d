"""Index entries and reports of a catalogue."""

from pyspark.sql import functions as F

from stratalake.operators import entries

ITEM = "id string, collection string, geometry string, bbox array<double>, properties map<string,string>, assets map<string,struct<href:string,type:string,roles:array<string>,size:long>>, links array<struct<rel:string,href:string,title:string>>"
BOX = [0.0, 0.0, 1.0, 1.0]
ROWS = [
    ("a", "c", "g", BOX, {"title": "A", "secret": "x", "keywords": "[]", "topic": ""}, {"data": ("a.cog.tif", None, None, 5)}, [("parent", "..", None), ("cog", "a", "t")]),
    ("b", None, "g", BOX, {"footprint_source": "utah-bbox"}, {"data": ("b", "image/tiff; profile=cloud-optimized", None, 1)}, None),
    ("d", "c", "g", BOX, {"layer_kind": "table"}, None, [("pmtiles", "d", None)]), ("e", "c", None, BOX, None, None, [("pmtiles", "e", None)]),
    ("f", "c", "g", BOX, None, {"data": ("f.tif", "image/tiff", ["data"], 1)}, [(None, "f", None)]), ("g", "c", "g", BOX, {}, {"x": ("g", None, ["cloud-optimized"], 1)}, []),
]


def test_entries_keep_what_a_list_shows(spark):
    got = {r["id"]: r for r in entries.index_entries(spark.createDataFrame(ROWS, ITEM)).collect()}
    assert [i for i, r in got.items() if r["bbox"] is None] == ["b", "d", "e"]
    assert got["a"]["properties"] == {"title": "A"} and got["a"]["assets"]["data"].asDict() == {"href": "a.cog.tif", "type": None, "roles": None}
    assert [tuple(x) for x in got["a"]["links"]] == [("self", "./c/a/a.json"), ("cog", "a")] and [tuple(x) for x in got["b"]["links"]] == [("self", "./b/b.json")]


def test_what_can_be_drawn(spark):
    of = lambda k: F.try_element_at("properties", F.lit(k))
    df = spark.createDataFrame(ROWS, ITEM).filter(entries.mappable(F.col("assets"), F.col("links"), F.col("geometry"), of("footprint_source"), of("layer_kind")))
    assert [r["id"] for r in df.collect()] == ["a", "g"]
    labels = spark.createDataFrame([("T_1_LineErrors",), ("top/T_22_Errors",), ("T_x_Errors",), ("T_1_Lines",), (None,)], "l string")
    assert [r[0] for r in labels.select(entries.is_error_layer(F.col("l"))).collect()] == [True, True, False, False, False]


def test_a_series_switches_as_a_whole(spark):
    pubs = spark.createDataFrame([("g", "A", "A-1", True, True), ("g", "A", "A-2", True, None), ("g", "B", "B-1", True, True), ("g", "B", "B-2", False, False)], "group string, series string, id string, moved boolean, raster boolean")
    items = spark.createDataFrame([("A-1", "x", True), ("A-2", "y", False), ("B-1", "z", True), ("?", "w", True)], "publication string, id string, raster boolean")
    covered = entries.coverage(pubs, items)
    assert sorted(map(tuple, covered.collect())) == [("g", "A", 2, True, 0, 3), ("g", "B", 0, False, 1, 0)]
    assert sorted(map(tuple, entries.coverage_rasters(pubs, items, covered).collect())) == [("g", "A", "A-1"), ("g", "A", "x")]


def test_doubles_and_pictures(spark):
    items = spark.createDataFrame([("c", "1", "2001", "p"), ("d", "1", None, "p"), ("c", "2", "2001", "p"), ("c", "3", "2009", ""), ("e", "4", None, "p"), ("e", "4", None, None), ("f", None, None, None), ("g", None, None, None)], "collection string, id string, datetime string, thumbnail string")
    got = {r["id"]: [tuple(p) for p in r["paths"]] for r in entries.duplicate_ids(items).collect()}
    assert got == {"1": [("c/1", 1), ("d/1", 1)], "4": [("e/4", 2)]}
    assert sorted((r["collection"], r["id"]) for r in entries.representative(items).collect()) == [("c", "2"), ("d", "1"), ("e", "4")]


def test_outcomes(spark):
    runs = spark.createDataFrame([("ok",), ("okay",), ("skip:none",), ("skip:too_large:9",), ("fail:x",), (None,)], "code string")
    assert sorted(map(tuple, entries.tally(runs, "code").collect())) == [("attention", 4), ("expected", 1), ("ok", 1)]


def test_each_target_is_copied_once(spark):
    pubs = spark.createDataFrame([(" m-2 ", "h/b.pdf"), ("M-1", "h/a.pdf"), ("M-3", None), ("", "h/q.pdf"), (None, "h/r.pdf")], "id string, url string")
    more = spark.createDataFrame([("m-1", "h/b.pdf"), ("M-2", "h/c.pdf"), ("X", "h/d.pdf"), ("M-3", "h/e.pdf")], "id string, url string")
    target = F.concat(F.lit("files/"), F.element_at(F.split("url", "/"), -1))
    plan = lambda **k: sorted(map(tuple, entries.mirror_plan(pubs, more, target, **k).collect()))
    assert plan() == [("M-1", "h/a.pdf", "files/a.pdf"), ("M-1", "h/b.pdf", "files/b.pdf"), ("M-2", "h/c.pdf", "files/c.pdf"), ("M-3", "h/e.pdf", "files/e.pdf")]
    assert plan(selected=spark.createDataFrame([("m-2",)], "id string"), present=spark.createDataFrame([("files/c.pdf",)], "target string")) == [("M-2", "h/b.pdf", "files/b.pdf")]


def test_untouched_collections_are_not_stale(spark):
    published = spark.createDataFrame([("c", 1), ("c", 2), ("d", 3)], "collection string, id int")
    built = spark.createDataFrame([("c", 1), ("c", 5)], "collection string, id int")
    assert list(map(tuple, entries.stale(published, built).collect())) == [("c", 2)]
