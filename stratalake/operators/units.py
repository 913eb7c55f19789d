"""Map units: which layer of a bundle holds them, and its rows in one common form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Attribute schemas in order of preference, each with the ending of the layer's name in lower case, and the columns that hold each field in order of
#: preference. Columns are matched whatever their case and underscores.
_OLDER = {"code": ["UnitSymbol", "MapUnit"], "name": ["UnitName"], "age": ["Age_Strat", "Age"], "description": ["Descriptio", "Description"]}
SCHEMAS = [
    ("gems", r"mapunitpolys$", {"code": ["MapUnit"], "name": ["Name"], "age": ["Age"], "description": ["Description"]}),
    ("template", r"geologicunits?(_nad[0-9]{2}|_[0-9]{8})?$", _OLDER),
    ("coverage", r"(^|[_-])(geounits?|units?|geology_?polys?)$", _OLDER),
]
#: The table that describes units by their code, the longer name it may have, and where shapefiles cut a column's name.
DESCRIPTIONS, FULL_NAME, CUT_AT = "descriptionofmapunits", "FullName", 10


def _folded(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit("_"), F.lit("")))


def column_for(columns: Column, wanted: list[str]) -> Column:
    """A layer's own spelling of the first of the wanted columns that it has."""
    return F.coalesce(*[_own(columns, name) for name in wanted])


def _own(columns: Column, name: str) -> Column:
    return F.get(F.filter(columns, lambda c: _folded(c) == name.replace("_", "").lower()), F.lit(0))


def unit_layers(layers: DataFrame, schemas: list = SCHEMAS) -> DataFrame:
    """(bundle, label, schema, code, name, age, description, others, unusable): each bundle's unit layer, and the columns of its fields.

    `layers` has (bundle, label, spatial, rows, geometry_types, columns). A layer counts if it has polygons and rows, a name of one of the schemas and that schema's code column. The schema's rank
    decides, then the most rows, then the fewest names cut by a shapefile, then the label. `others` are further candidates that differ in schema or rows, an ambiguity;
    `unusable` are layers named like one without a code column, told only where nothing qualifies (the label is null then).
    """
    name = F.lower(F.element_at(F.split("label", "/"), -1))
    polygons = F.col("spatial") & (F.col("rows") > 0) & F.exists("geometry_types", lambda g: F.contains(g, F.lit("Polygon")))
    rank = F.coalesce(*[F.when(name.rlike(pattern), i) for i, (_, pattern, _) in enumerate(schemas)])
    named = layers.filter(polygons).withColumn("rank", rank).filter("rank is not null")
    pick = lambda f: F.coalesce(*[F.when(F.col("rank") == i, column_for(F.col("columns"), fields[f])) for i, (_, _, fields) in enumerate(schemas)])
    schema = F.coalesce(*[F.when(F.col("rank") == i, F.lit(s)) for i, (s, _, _) in enumerate(schemas)])
    cut = F.size(F.filter("columns", lambda c: F.length(c) == CUT_AT))
    fields = F.struct((-F.col("rows")).alias("rows"), cut.alias("cut"), "label", schema.alias("schema"), *[pick(f).alias(f) for f in ("code", "name", "age", "description")])
    known = named.select("bundle", F.struct("rank", fields.alias("f")).alias("c"))
    usable = known.filter("c.f.code is not null").groupBy("bundle").agg(F.array_sort(F.collect_list("c")).alias("all"))  # the layers of a bundle
    unusable = known.filter("c.f.code is null").groupBy("bundle").agg(F.array_sort(F.collect_set("c.f.label")).alias("unusable"))
    best = F.get("all", F.lit(0))
    differs = F.exists("all", lambda x: (x["rank"] != best["rank"]) | (x["f"]["rows"] != best["f"]["rows"]))
    others = F.when(differs, F.transform(F.slice("all", F.lit(2), F.size("all")), lambda x: x["f"]["label"])).otherwise(F.array().cast("array<string>"))
    chosen = usable.join(unusable, "bundle", "full_outer")
    none = F.array().cast("array<string>")
    field = lambda f: best["f"][f].alias(f)
    return chosen.select("bundle", *map(field, ("label", "schema", "code", "name", "age", "description")), F.coalesce(others, none).alias("others"), F.when(best.isNull(), F.col("unusable")).otherwise(none).alias("unusable"))


def cleaned(c: Column) -> Column:
    """Text without the spaces around it; blank is null."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def unit_rows(layer: DataFrame, series_id: str, label: str, columns: dict[str, str | None], geometry: str, described: DataFrame | None = None, keys: tuple[str, str] | None = None) -> DataFrame:
    """(series_id, unit_code, unit_name, age, description, source_label, geom) of a unit layer's rows that have a geometry.

    `columns` names the layer's code, name, age and description columns, of those that it has. With `described`, a table of descriptions, and `keys`, the code columns of layer and table, the
    last three come from there, the name's longer form standing in for a missing one; a code that is described more than once counts once.
    """
    rows = layer.filter(F.col(geometry).isNotNull())
    of = lambda f: cleaned(F.col(f"`{columns[f]}`")) if columns.get(f) else F.lit(None).cast("string")
    if described is not None and keys:
        full = next((c for c in described.columns if c.replace("_", "").lower() == FULL_NAME.lower()), None)
        names = F.coalesce(of("name"), cleaned(F.col(f"`{full}`"))) if full else of("name")
        facts = described.select(cleaned(F.col(f"`{keys[1]}`")).alias("_k"), names.alias("unit_name"), of("age").alias("age"), of("description").alias("description"))
        one = facts.filter("_k is not null").groupBy("_k").agg(F.min(F.struct("unit_name", "age", "description")).alias("_f"))
        rows = rows.select(cleaned(F.col(f"`{columns['code']}`")).alias("unit_code"), cleaned(F.col(f"`{keys[0]}`")).alias("_j"), F.col(geometry).alias("geom"))
        rows = rows.join(one, F.col("_j") == F.col("_k"), "left").select("unit_code", "_f.*", "geom")
    else:
        rows = rows.select(of("code").alias("unit_code"), of("name").alias("unit_name"), of("age").alias("age"), of("description").alias("description"), F.col(geometry).alias("geom"))
    return rows.select(F.lit(series_id).alias("series_id"), "unit_code", "unit_name", "age", "description", F.lit(label).alias("source_label"), "geom")
