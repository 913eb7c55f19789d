"""Map styles: what they bind to, whether items still show them, and the classes that they draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import bound

#: How a comparison is shown, and the label of what matches nothing.
SIGNS, OTHER, BETWEEN = {"<": "<", "<=": "≤", ">": ">", ">=": "≥"}, "Other", " – "

#: Layers of a style, as JSON: paint properties and a filter, both kept as text until they are looked at.
LAYERS = "array<struct<paint: map<string, string>, filter: string>>"


def binding_report(items: DataFrame, styles: DataFrame) -> DataFrame:
    """(status, id) of each item in scope, and of each style that none of them asks for.

    `items` has (id, base, assets), `styles` (style, assets). An item takes the style of its own id, else of its base, the publication that it is a plate of. It is `matched`
    if an asset of it is one that the style draws, an `asset miss` if none is, and has `no style` otherwise; a style is an `unused style` if it is neither id nor base of an item.
    Several rows of a style are one with the assets of all. Rows without an id are left out.
    """
    named = styles.filter("style is not null").select("style", F.explode_outer("assets").alias("a")).groupBy("style").agg(F.collect_set("a").alias("drawn"))
    known = items.filter("id is not null").select("id", "base", F.coalesce("assets", F.array().cast("array<string>")).alias("assets"))
    wants = known.select("id", "assets", F.explode(F.array_compact(F.array(F.struct(F.lit(0).alias("rank"), F.col("id").alias("ask")), F.when(F.col("base") != F.col("id"), F.struct(F.lit(1).alias("rank"), F.col("base").alias("ask")))))).alias("w"))
    found = wants.select("id", "assets", "w.*").join(named, F.col("ask") == F.col("style"), "left")
    hit = F.struct(F.when(F.col("style").isNull(), 2).otherwise(F.col("rank")).alias("rank"), F.arrays_overlap("assets", F.coalesce("drawn", F.array().cast("array<string>"))).alias("hit"))
    best = found.groupBy("id").agg(F.min(hit).alias("b"))
    status = F.when(F.col("b.rank") == 2, "no style").when(F.col("b.hit"), "matched").otherwise("asset miss")
    unused = named.join(found.select("ask").filter("ask is not null").distinct(), F.col("style") == F.col("ask"), "left_anti")
    return best.select(status.alias("status"), "id").unionAll(unused.select(F.lit("unused style").alias("status"), F.col("style").alias("id")))


def drifted(items: DataFrame, manifest: DataFrame) -> DataFrame:
    """(id, render) of items whose stored legend isn't the manifest's. A style without a legend says nothing, and an item without that render isn't looked at.

    `items` has (id, renders), a map of legends by render, `manifest` (id, render, legend).
    """
    now = manifest.filter(F.coalesce("legend", F.lit("")) != "").select("id", "render", F.col("legend").alias("_now"))
    stored = items.select("id", F.explode("renders").alias("render", "_stored"))
    return stored.join(now, ["id", "render"]).filter(~F.col("_stored").eqNullSafe(F.col("_now"))).select("id", "render")


def parts(raw: Column) -> Column:
    """The elements of a JSON array, each as JSON text; null for anything else."""
    return F.when(F.startswith(F.ltrim(raw), F.lit("[")), F.from_json(F.regexp_replace(raw, r"^\s+", ""), "array<string>"))


def _paint_classes(expression: Column) -> Column:
    """The classes of a `match` or `step` expression over one value; null for others."""
    return bound(parts(expression), _expression_classes)


def _expression_classes(e: Column) -> Column:
    n = F.size(e)
    at = lambda i: F.get(e, i)
    struct = lambda label, colour: F.struct(label.alias("label"), colour.alias("colour"))
    of_label = lambda raw: F.when(F.startswith(raw, F.lit("[")), F.array_join(parts(raw), ", ")).otherwise(raw)
    rest = n - 2
    pairs = F.transform(F.sequence(F.lit(0), F.floor(rest / 2).cast("int") - 1), lambda k: struct(of_label(at(2 * k + 2)), at(2 * k + 3)))
    others = F.when(rest % 2 == 1, F.array(struct(F.lit(OTHER), at(n - 1))))
    none = F.array().cast("array<struct<label: string, colour: string>>")
    match = F.concat(F.when(rest >= 2, pairs).otherwise(none), F.coalesce(others, none))
    steps = F.transform(F.sequence(F.lit(1), F.floor((n - 3) / 2).cast("int")), lambda k: struct(F.concat(F.lit(f"{SIGNS['>=']} "), at(2 * k + 1)), at(2 * k + 2)))
    step = F.concat(F.array(struct(F.concat(F.lit("< "), at(F.lit(3))), at(F.lit(2)))), steps)
    return F.when((at(F.lit(0)) == "match") & (F.size(match) > 0), match).when((at(F.lit(0)) == "step") & (n >= 5), step).when((at(F.lit(0)) == "step") & (n == 4), F.slice(step, 1, 1))


def _bound(raw: Column) -> Column:
    """(sign, value) of a comparison of a property with a value; null for others."""
    e = parts(raw)
    value = F.get(e, F.lit(2))
    return F.when(F.get(e, F.lit(0)).isin(*SIGNS) & value.isNotNull() & ~F.startswith(value, F.lit("[")), F.struct(F.get(e, F.lit(0)).alias("sign"), value.alias("value")))


def _shown(bound: Column) -> Column:
    sign = F.create_map(*[F.lit(x) for pair in SIGNS.items() for x in pair])
    return F.concat(F.try_element_at(sign, bound["sign"]), F.lit(" "), bound["value"])


def _one_label(raw: Column) -> Column:
    """The label of a filter that isn't made of others: the value of ==, the values of in and match, a comparison."""
    e = parts(raw)
    head, third = F.get(e, F.lit(0)), F.get(e, F.lit(2))
    flat = F.array_join(F.filter(F.slice(e, 3, F.greatest(F.size(e) - 2, F.lit(0))), lambda v: ~F.startswith(v, F.lit("["))), ", ")
    listed = F.array_join(parts(F.regexp_replace(third, r'^\["literal",\s*(\[.*\])\]$', "$1")), ", ")
    values = F.when(F.startswith(third, F.lit("[")), listed).otherwise(flat)
    equal = F.when(~F.startswith(third, F.lit("[")), third)
    return F.when(head == "==", equal).when(head == "in", F.nullif(values, F.lit(""))).when(head == "match", F.when(F.startswith(third, F.lit("[")), listed).otherwise(third)).otherwise(_shown(_bound(raw)))


def filter_label(raw: Column) -> Column:
    """The class that a layer's filter stands for, null if it doesn't tell.

    Of `all` and `any` the first equality or list decides, else the comparisons: a lower and an upper one are a range. Filters are looked at two levels deep.
    """
    e = parts(raw)
    subs = F.slice(e, 2, F.greatest(F.size(e) - 1, F.lit(0)))
    plain = F.array_compact(F.transform(F.filter(subs, lambda s: _bound(s).isNull()), _one_label))
    bounds = F.array_compact(F.transform(subs, _bound))
    low = F.get(F.filter(bounds, lambda b: b["sign"].isin(">", ">=")), F.lit(0))
    high = F.get(F.filter(bounds, lambda b: b["sign"].isin("<", "<=")), F.lit(0))
    folded = F.when(low.isNotNull() & high.isNotNull(), F.concat(low["value"], F.lit(BETWEEN), high["value"])).otherwise(_shown(F.get(bounds, F.lit(0))))
    return F.when(F.get(e, F.lit(0)).isin("all", "any"), F.coalesce(F.get(plain, F.lit(0)), folded)).otherwise(_one_label(raw))


def classes(layers: Column) -> Column:
    """(label, colour) of each class that a style's layers draw, in their order; empty for a style that draws all alike.

    The first colour that depends on a value, by `match` or `step`, gives the classes; else each layer with a filter and one colour is one.
    """
    coloured = lambda l: F.filter(F.map_entries(l["paint"]), lambda p: F.endswith(p["key"], F.lit("-color")))
    driven = F.flatten(F.transform(layers, lambda l: F.array_compact(F.transform(coloured(l), lambda p: _paint_classes(p["value"])))))
    flat = lambda l: F.get(F.filter(F.transform(coloured(l), lambda p: p["value"]), lambda v: ~F.startswith(v, F.lit("["))), F.lit(0))
    each = F.filter(F.transform(layers, lambda l: F.struct(filter_label(l["filter"]).alias("label"), flat(l).alias("colour"))), lambda c: c["label"].isNotNull() & c["colour"].isNotNull())
    first = F.get(driven, F.lit(0))
    none = F.array().cast("array<struct<label: string, colour: string>>")
    return F.coalesce(F.when(first.isNotNull(), first).otherwise(each), none)


def style_classes(styles: DataFrame, key: str, layers: str) -> DataFrame:
    """(key, value, name, title, hint): a row a class of each style, its layers given as a JSON array.

    `value` counts the classes from 0, `name` is a word for machines, `class_` and the number where the label has none, `hint` the colour's six hex digits, null for other notations.
    """
    each = styles.select(key, F.posexplode(classes(F.from_json(layers, LAYERS))).alias("value", "c"))
    name = F.regexp_replace(F.regexp_replace("c.label", "[^0-9A-Za-z_-]+", "_"), "^_+|_+$", "")
    hint = F.upper(F.nullif(F.regexp_extract("c.colour", "^#*([0-9a-fA-F]{6})$", 1), F.lit("")))
    return each.select(key, "value", F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("class_"), "value")).alias("name"), F.col("c.label").alias("title"), hint.alias("hint"))
