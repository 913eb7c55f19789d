"""What styles bind to, whether items drifted from them, and their classes."""

import json

from stratalake.operators import styles


def test_an_item_takes_its_own_style_before_its_base(spark):
    items = spark.createDataFrame([("a", None, ["cog"]), ("b-1", "b", ["pmtiles"]), ("c", "b", ["cog"]), ("d", "x", None), (None, "b", ["cog"]), ("b", "b", [])], "id string, base string, assets array<string>")
    manifest = spark.createDataFrame([("a", ["pmtiles"]), ("a", ["cog"]), ("b", ["pmtiles"]), ("c", ["pmtiles"]), ("e", None), (None, ["cog"])], "style string, assets array<string>")
    got = sorted(map(tuple, styles.binding_report(items, manifest).collect()))
    assert got == [("asset miss", "b"), ("asset miss", "c"), ("matched", "a"), ("matched", "b-1"), ("no style", "d"), ("unused style", "e")]
    assert styles.binding_report(items.limit(0), manifest.limit(0)).count() == 0


def test_drift_is_a_legend_that_differs(spark):
    items = spark.createDataFrame([(1, {"map": "red", "grey": "x"}), (2, {"map": "blue"}), (3, {"other": "red"}), (4, None), (5, {"map": None})], "id int, renders map<string,string>")
    manifest = spark.createDataFrame([(1, "map", "red"), (2, "map", "red"), (3, "map", "red"), (4, "map", "red"), (5, "map", "red"), (1, "grey", "")], "id int, render string, legend string")
    assert sorted(map(tuple, styles.drifted(items, manifest).collect())) == [(2, "map"), (5, "map")]


def classes(spark, layers):
    df = spark.createDataFrame([(1, json.dumps(layers) if layers is not None else None)], "k int, layers string")
    return [(r["title"], r["hint"]) for r in styles.style_classes(df, "k", "layers").orderBy("value").collect()]


def test_classes_of_colours_that_depend_on_a_value(spark):
    match = ["match", ["get", "unit"], "Qal", "#aabbcc", ["Tv", "Tb"], "#112233", "#000000"]
    assert classes(spark, [{"paint": {"fill-color": match}}]) == [("Qal", "AABBCC"), ("Tv, Tb", "112233"), ("Other", "000000")]
    assert classes(spark, [{"paint": {"fill-color": match[:-1]}}]) == [("Qal", "AABBCC"), ("Tv, Tb", "112233")]
    step = ["step", ["get", "depth"], "#000001", 10, "#000002", 20.5, "rgb(1,2,3)"]
    assert classes(spark, [{"paint": {"line-width": 2}}, {"paint": {"line-color": step}}]) == [("< 10", "000001"), ("≥ 10", "000002"), ("≥ 20.5", None)]
    assert classes(spark, [{"paint": {"fill-color": "#ffffff"}}]) == [] and classes(spark, []) == [] and classes(spark, None) == []


def test_classes_of_layers_with_filters(spark):
    def layer(f, colour="#123456"):
        return {"paint": {"circle-color": colour}, "filter": f}

    kind = ["get", "kind"]
    layers = [
        layer(["==", kind, "fault"]), layer(["in", "kind", "a", "b"]), layer(["in", kind, ["literal", ["c", "d"]]]), layer(["match", kind, ["e", "f"], True, False]), layer([">=", kind, 5]),
        layer(["all", [">=", kind, 0.2], ["<", kind, 0.4]]), layer(["all", ["<", kind, 3]]), layer(["any", [">", kind, 1], ["==", kind, "q"]]), layer(["has", "kind"]), layer(None), layer(["==", kind, "x"], ["get", "colour"]),
    ]
    assert [t for t, _ in classes(spark, layers)] == ["fault", "a, b", "c, d", "e, f", "≥ 5", "0.2 – 0.4", "< 3", "q"]


def test_names_for_machines(spark):
    df = spark.createDataFrame([(1, json.dumps([{"paint": {"fill-color": ["match", "u", "A b/c ", "#00000a", "é", "#0000FF"]}}]))], "k int, layers string")
    assert [(r["name"], r["hint"]) for r in styles.style_classes(df, "k", "layers").orderBy("value").collect()] == [("A_b_c", "00000A"), ("class_1", "0000FF")]
