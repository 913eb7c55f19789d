"""Laws of the operators that one query can't show."""

import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalake.functions import text as fx
from stratalake.operators import filters, geo, merge, ordering, search, spatial
from stratalake.plans import upkeep
from stratalake.queries.search import TOPIC_CASE
from stratalake.sources import archive, readers


def test_feature_id_is_a_permutation_and_reproducible(spark):
    df = spark.range(1000).select("id", (F.col("id") * 37 % 101).alias("x"), (F.col("id") * 53 % 97).alias("y"))
    a = {r["id"]: r["feature_id"] for r in ordering.numbered(geo.with_hilbert(df), ["h", "id"]).collect()}
    b = {r["id"]: r["feature_id"] for r in ordering.numbered(geo.with_hilbert(df.repartition(7)), ["h", "id"]).collect()}
    assert sorted(a.values()) == list(range(1, 1001)) and a == b


def test_hilbert_neighbours_are_one_step_apart(spark):
    cells = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    rows = sorted((r["d"], r["x"], r["y"]) for r in cells.withColumn("d", geo.hilbert_key(F.col("x"), F.col("y"), 3)).collect())
    assert [r[0] for r in rows] == list(range(64))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(rows, rows[1:]))


def test_merge_is_idempotent_and_leaves_ids_alone(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "k int, v string, feature_id int")
    source = spark.createDataFrame([(1, "a", 11), (2, "c", 21), (4, "d", 41)], "k int, v string, feature_id int")
    once = merge.merge(target, source, "k", ("feature_id",))
    assert sorted(map(tuple, once.collect())) == [(1, "a", 10), (2, "c", 21), (4, "d", 41)]
    assert sorted(map(tuple, merge.merge(once, source, "k", ("feature_id",)).collect())) == sorted(map(tuple, once.collect()))
    with pytest.raises(ValueError):
        merge.merge(target, source.withColumn("k", F.lit(None).cast("int")), "k")


def test_null_geometry_never_matches(spark):
    old = spark.createDataFrame([(None, 1), ("g", 1)], "g string, a int")
    row = merge.diff_summary(old, old, F.md5("g"), ["a"]).first()
    assert (row["unchanged"], row["added"], row["removed"]) == (1, 1, 1)


def test_simplify_keeps_ends_and_corners(spark):
    lines = spark.createDataFrame([(1, [0.0, 1.0, 2.0, 3.0], [0.0, 0.001, 1.0, 0.0])], "id long, xs array<double>, ys array<double>")
    row = geo.simplify(lines, 0.1).first()
    assert row["xs"] == [0.0, 1.0, 2.0, 3.0] and geo.simplify(lines, 5.0).first()["n"] == 2


def test_ring_test(spark):
    square = ([0.0, 4.0, 4.0, 0.0, 0.0], [0.0, 0.0, 4.0, 4.0, 0.0])
    df = spark.createDataFrame([(1.0, 1.0, *square), (5.0, 1.0, *square)], "x double, y double, xs array<double>, ys array<double>")
    assert [r[0] for r in df.select(spatial.in_ring(*map(F.col, ("x", "y", "xs", "ys")))).collect()] == [True, False]


def test_names():
    assert filters.unique_names(["a", "A", "a_2", "a"]) == ["a", "A_3", "a_2", "a_4"]
    assert filters.point_columns(["Well Long", "LATITUDE"]) == ("Well Long", "LATITUDE")


def test_orphan_sweep_refuses_what_it_cannot_see(spark):
    listing = spark.createDataFrame([("a", 1), ("b", 9)], "path string, modified int")
    assert [r["path"] for r in upkeep.orphans(listing, spark.createDataFrame([("b",)], "path string"), F.lit(5)).collect()] == ["a"]
    with pytest.raises(ValueError):
        upkeep.orphans(listing, spark.createDataFrame([("c",)], "path string"), F.lit(5))


def test_header_and_ranges(spark):
    grid = spark.createDataFrame([(0, ["Title", ""]), (1, ["a", "b"]), (2, ["1", "2"])], "row_no int, cells array<string>")
    sheets = grid.withColumn("sheet", F.lit("a")).union(spark.createDataFrame([(0, ["1", "2"], "b")], "row_no int, cells array<string>, sheet string"))
    assert [(r["sheet"], r["row_no"], r["cells"]) for r in readers.header_rows(sheets).collect()] == [("a", 0, ["Title", ""])]  # half as wide as the widest
    assert readers.ranges("k", 0, 10, 1) == ["1 = 1"] and len(readers.ranges("k", 0, 100, 4)) == 4


def test_chunks_cover_the_words(spark):
    text = " ".join(f"word{i}" for i in range(1000))
    pieces = search.chunked(spark.createDataFrame([(1, text), (2, None)], "k long, t string"), "k", "t").orderBy("pos").collect()
    assert " ".join(p["chunk"] for p in pieces) == text and max(len(p["chunk"]) for p in pieces) <= search.CHUNK_CHARS


def test_filters_reach_the_scan(spark, tmp_path):
    archive.write_archive(spark.range(100).select("id", F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y")), f"file://{tmp_path}/a", "id")
    plan = archive.feature_query(archive.read_latest(spark, f"file://{tmp_path}/a"), (1, 0, 5, 2))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[\w", plan)


def test_shards_are_stable(spark):
    df = spark.createDataFrame([("ab-1",), ("AB-1",), ("x",)], "k string")
    got = [r[0] for r in df.select(ordering.shard(F.col("k"), 16)).collect()]
    assert got == [zlib.crc32(k.upper().encode()) % 16 for k in ("ab-1", "AB-1", "x")]


def test_overlap_counts_all_values(spark):
    from stratalake.operators import relate

    tables = {"customer": spark.range(7600).toDF("customer_id"), "orders": spark.range(8000).toDF("customer_id")}
    values = relate.unpivoted(tables)
    layers = spark.createDataFrame([("customer", "g", False), ("orders", "g", False)], "tab string, grp string, spatial boolean")
    found = {(r["origin"], r["destination"]): r["overlap"] for r in relate.relationships(values, relate.profiles(values), layers).collect()}
    # The keys of orders number its rows and aren't named after it.
    assert found == {("orders", "customer"): 95.0}
    spatial = layers.withColumn("spatial", F.col("tab") == "customer")
    assert relate.relationships(values, relate.profiles(values), spatial).isEmpty()


def test_name_scores(spark):
    from stratalake.operators import relate

    cases = [
        ("MapUnit", "MapUnit", "DescriptionOfMapUnits", 40), ("DataSourceID", "DataSources_ID", "DataSources", 30), ("DataSourcesID", "DataSource_ID", "DataSource", 30), ("CategoriesID", "Category_ID", "Category", 30),
        ("UnitID", "Code", "geo_unit", 28), ("StationID", "Code", "FieldStations", 22), ("LocationSourceID", "DataSources_ID", "DataSources", 10), ("Notes", "MapUnit", "DescriptionOfMapUnits", 0),
    ]
    df = spark.createDataFrame(cases, "c string, k string, t string, want int")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", relate.name_score(F.col("c"), F.col("k"), F.col("t"))).collect())
    assert spark.range(1).select(relate.words(F.lit("DefinitionSourcesID"))).first()[0] == ["definition", "source"]


def test_scales(spark):
    from stratalake.functions import text

    cases = {
        "1:24,000": 24000, "1:24000": 24000, "1 : 24,000": 24000, "1:24 000": 24000, "1:62.500": 62500, "1:2,950,000": 2950000, "500000": 500000, "100k": 100000, "1 inch = 200 feet": 2400, "1 inch = 2,000 feet": 24000,
        "1 inch = 8,000 feet": 96000, "1 inch = 1 mile": 63360, "2 inches = 1 mile": 31680, "1 inch = 2.500 miles": 158400, "1 inch = 12.500 miles": 792000, "1\" = 20'": 240, "1\" =  40'": 480, "1\" = 3200'": 38400, "1/4 inch = 1 foot": 48,
        "1 inch = 24,000 feet": 24000, "1 inch = 62,500 feet": 62500, "1:24,000 & 1:48,000": 24000, "": None, "not a scale": None, "0.18": None, "1 inch = some feet": None, "1:": None, "k": None, "1/0 inch = 2 feet": None,
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want long")
    bad = [(r["t"], r["got"], r["want"]) for r in df.withColumn("got", text.scale_denominator(F.col("t"))).collect() if r["got"] != r["want"]]
    assert not bad


def test_editions(spark):
    rows = [("M-100", "Alta", "1980"), ("M-100DM", "Alta", " 2005 "), ("OFR-9", "Provo", "1999"), ("M-1", "Esc", "1990"), ("OFR-1", "Esc", ""), ("T-1", "Tie", "2000"), ("T-2", "Tie", "2000"), ("R", "Alta", "1997 (rev 2017)"), ("N", "Alta", None)]
    df = spark.createDataFrame(rows, "id string, quad string, year string")
    got = {r["id"]: (r["version"], r["predecessor"], r["successor"], r["latest"], r["deprecated"]) for r in ordering.edition_graph(df, ["quad"], "year", "id").collect()}
    assert got == {"M-100": ("1980", None, "M-100DM", "M-100DM", True), "M-100DM": ("2005", "M-100", None, None, False), "OFR-9": ("1999", None, None, None, False), "M-1": ("1990", None, None, None, False)}
    out = {r["id"]: r["reason"] for r in ordering.left_out(df, ["quad"], "year", "id").collect()}
    assert out == {"OFR-1": "no year", "R": "no year", "N": "no year", "T-1": "year is shared", "T-2": "year is shared"}


def test_chunks_are_cut_like_windows(spark):
    """A slow walk: windows of 40 characters, cut at their last space, or through a longer word."""
    import random

    rng = random.Random(8)
    texts = [" ".join("w" * rng.choice([1, 3, 8, 12, 39, 40, 41, 95]) for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["a" * 40, "b" * 41, "  c\n\td  ", "é" * 90]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {}
    for r in search.chunked(df, "k", "t", 40).collect():
        got.setdefault(r["k"], []).append((r["pos"], r["chunk"]))
    for k, text in enumerate(texts):
        text, want, at = " ".join(text.split()), [], 0
        while at < len(text):
            stop = len(text) if len(text) - at <= 40 else max([j for j in range(at + 1, at + 40) if text[j] == " "], default=at + 40)
            want.append(text[at:stop].strip())
            at = stop
        assert [c for _, c in sorted(got.get(k, []))] == [c for c in want if len(c) > search.LEAST_CHARS]


def test_nearest_over_several_blocks(spark):
    import numpy as np

    m = np.round(np.random.default_rng(5).normal(size=(130, 6)), 3)
    m[7], m[11] = m[3], 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(900, None)], "id long, e array<float>")
    got = sorted(map(tuple, search.nearest(df.filter("id % 10 = 0"), df, "id", "e", 4, 32).collect()))
    unit = m.astype(np.float32).astype(float)
    unit = unit / np.maximum(np.sqrt((unit**2).sum(1, keepdims=True)), 1e-300)
    want = []
    for q in range(0, 130, 10):
        s = sorted((-round(float(unit[q] @ unit[v]), 12), v) for v in range(130) if v not in (q, 11))
        want += [(q, v, -x) for x, v in s[:4]]
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=lambda w: (w[0], w[1]))] and [g[2] for g in got] == pytest.approx([w[2] for w in sorted(want, key=lambda w: (w[0], w[1]))])


def test_quantiles_by_histograms(spark, monkeypatch):
    import numpy as np

    from stratalake.operators import grid

    monkeypatch.setattr(grid, "FEW_VALUES", 5)
    monkeypatch.setattr(grid, "QUANTILE_BINS", 4)
    values = [*np.random.default_rng(2).exponential(size=300).tolist(), *[0.5] * 40]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    row = grid.quantiles(df, "v", [0.0, 0.02, 0.5, 0.8, 1.0]).first()
    assert row["q"] == pytest.approx(np.quantile(values, [0.0, 0.02, 0.5, 0.8, 1.0]).tolist()) and (row["least"], row["most"]) == (min(values), max(values))
    assert grid.quantiles(df.filter("v > 1e9"), "v", [0.5]).first()["q"] == [None]


def test_overviews(spark):
    square = ([0.0, 4.0, 4.0, 0.0, 0.0], [0.0, 0.0, 4.0, 4.0, 0.0])
    strip = ([0.0, 10.0, 10.0, 5.0, 0.0, 0.0], [0.0, 0.0, 0.05, 0.09, 0.05, 0.0])
    rows = [(1, *square), (2, *strip), (3, [20.0, 20.01], [0.0, 0.0]), (4, [20.02, 20.05], [0.01, 0.01]), (5, [30.0], [0.0]), (6, [], []), (7, [0.0, 5.0, 10.0], [0.0, 0.06, 0.0]), (8, [0.0, 5.0, 10.0], [0.0, 0.2, 0.0])]
    df = spark.createDataFrame(rows, "id long, xs array<double>, ys array<double>")
    got = {r["id"]: r["n"] for r in geo.overview(df, 0.1).collect()}
    assert got == {1: 5, 2: got[2], 4: 2, 5: 1, 7: 2, 8: 3} and got[2] >= 4
    gate = geo.overview_gate(df, F.size("xs"), F.size("xs") == 1, [], 10).first()
    assert (gate["vertices"], gate["build"]) == (22, True)
    assert not geo.overview_gate(df, F.size("xs"), F.lit(True), [], 10).first()["build"] and not geo.overview_gate(df, F.size("xs"), F.lit(False)).first()["build"]
    levels = spark.createDataFrame([([100, 69, 49, 48],), ([100, 70, 69, 1],)], "s array<long>")
    assert [r[0] for r in levels.select(geo.kept_levels(F.col("s"))).collect()] == [[True, False, True], [False, True, True]]


def test_topics_are_those_of_sql(spark):
    """Also where a word stands beside a letter that isn't ASCII, or a dot meets a line's end."""
    texts = ["éore", "springé", "debris\rflow", "debris\u2028flow", "ice\x85age animal", "THE ORE", "core", "geologic map of a coal field", "coal of the seismic belt", "a\nsurficial\nunit", "", " "]
    want = [duckdb.execute(f"select {TOPIC_CASE} from (select ? as x) t", [t]).fetchall()[0][0] for t in texts]
    df = spark.createDataFrame([*enumerate(texts), (len(texts), None)], "i int, t string").repartition(3)
    assert [r["v"] for r in df.select("i", fx.topic(F.lit(None).cast("string"), F.col("t")).alias("v")).orderBy("i").collect()] == [*want, "other"]
    assert df.select(fx.first_rule(F.col("t"), []).alias("v")).distinct().collect()[0]["v"] == "other"
