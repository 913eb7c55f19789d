"""What an export would read and write, and what its format can't hold, told before it is made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The formats; those that are zipped; those that hold one kind of geometry.
FORMATS, ZIPPED, ONE_KIND = ("csv", "geojson", "gpkg", "fgb", "shp", "gdb"), ("shp", "gdb"), ("shp", "gdb")
#: Fixed values of the shapefile format: characters of a name, fields, bytes of a file and of a text; a header's and a record's bytes, a table's header's and a field's.
NAME_CHARS, MOST_FIELDS, FILE_BYTES, TEXT_BYTES = 10, 255, 2 * 1024**3, 254
SHAPE_HEADER, SHAPE_RECORD, TABLE_HEADER, TABLE_FIELD = 100, 40, 33, 32
#: Fixed values of text features: characters a byte of geometry, bytes around a feature and around a value; and the memory that a converter has.
TEXT_PER_BYTE, FEATURE_BYTES, VALUE_BYTES, MEMORY_BYTES = 2.5, 60, 6, int(1.5 * 1024**3)
#: The widths of fields that don't depend on their values, by Spark's type.
WIDTHS = {"boolean": 1, "bigint": 20, "int": 11, "smallint": 11, "tinyint": 11, "double": 24, "float": 24, "decimal": 24, "date": 8, "timestamp": 24, "timestamp_ntz": 24}


def fixed_width(kind: str) -> int | None:
    """The width of a field by its type, None where the longest value decides."""
    return WIDTHS.get(kind.split("(")[0])


def name_checks(columns: list[str]) -> tuple[list[str], list[tuple[str, str]], bool]:
    """(names that are cut, pairs that meet when they are, too many fields): each name that meets an earlier one is told with the first of them."""
    first: dict[str, str] = {}
    pairs = [(first[k], c) for c in columns if first.setdefault(k := c[:NAME_CHARS].lower(), c) is not c]
    return [c for c in columns if len(c) > NAME_CHARS], pairs, len(columns) > MOST_FIELDS


def base_kinds(types: Column) -> Column:
    """The kinds of geometry in a list of types, without multi, Z and M, each once and in order."""
    return F.array_sort(F.array_distinct(F.transform(types, lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.upper(t), "^ST_", ""), "^MULTI", ""), r"[\sZM]+$", ""))))


def read_bytes(groups: DataFrame, clip: tuple[float, float, float, float] | None = None) -> DataFrame:
    """(read_bytes, least_bytes): bytes of the row groups (bytes, xmin, ymin, xmax, ymax) that a clip admits, and of the largest group, below which no clip gets.

    A group without a box can't be left out.
    """
    inside = F.lit(True)
    if clip:
        w, s, e, n = clip
        inside = F.coalesce((F.col("xmin") <= e) & (F.col("xmax") >= w) & (F.col("ymin") <= n) & (F.col("ymax") >= s), F.lit(True))
    return groups.agg(F.coalesce(F.sum(F.when(inside, F.col("bytes"))), F.lit(0)).alias("read_bytes"), F.coalesce(F.max("bytes"), F.lit(0)).alias("least_bytes"))


def preflight(df: DataFrame, fmt: str, geometry: str, kind: str | None = None, clip: tuple[float, float, float, float] | None = None, box: tuple[str, ...] = ("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """One row of what an export of the rows in `clip` comes to: rows, shape_bytes, table_bytes, json_bytes, peak_bytes, over_format, over_memory, cut_names, clashes, too_many_fields, mixed.

    `geometry` is a column of WKB, `kind` one of its types. Names, fields and file sizes matter to shapefiles only, mixed kinds to formats that hold one. All is
    taken in one pass; a text's width is its longest value's bytes, other values are as long as their type's field.
    """
    if fmt not in FORMATS:
        raise ValueError(f"{fmt} is none of {', '.join(FORMATS)}")
    if clip:
        w, s, e, n = clip
        df = df.filter((F.col(box[0]) <= e) & (F.col(box[2]) >= w) & (F.col(box[1]) <= n) & (F.col(box[3]) >= s))
    fields = [(c, t) for c, t in df.dtypes if c not in (geometry, kind, *box)]
    text = [c for c, t in fields if fixed_width(t) is None]
    length = lambda c: F.octet_length(F.col(f"`{c}`").cast("string"))
    sums = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(geometry)), F.lit(0)).alias("_geometry")]
    sums += [F.coalesce(F.max(length(c)), F.lit(0)).alias(f"_max{i}") for i, c in enumerate(text)] + [F.coalesce(F.avg(length(c)), F.lit(0.0)).alias(f"_avg{i}") for i, c in enumerate(text)]
    sums += [F.collect_set(F.when(F.col(geometry).isNotNull(), F.col(kind))).alias("_kinds")] if kind else []  # as many as there are types
    width = lambda c, t: F.lit(fixed_width(t)) if c not in text else F.least(F.lit(TEXT_BYTES), F.greatest(F.lit(1), F.col(f"_max{text.index(c)}")))
    shown = lambda c, t: F.lit(fixed_width(t)) if c not in text else F.ceil(f"_avg{text.index(c)}")
    total = lambda f: sum((f(c, t) for c, t in fields), F.lit(0))
    row = df.agg(*sums).withColumns({
        "shape_bytes": F.lit(SHAPE_HEADER) + F.col("_geometry") + F.col("rows") * SHAPE_RECORD,
        "table_bytes": F.lit(TABLE_HEADER + TABLE_FIELD * len(fields)) + F.col("rows") * (total(width) + 1),
        "json_bytes": F.round(F.col("_geometry") * TEXT_PER_BYTE + F.col("rows") * (total(shown) + SHAPE_RECORD + FEATURE_BYTES + sum(len(c) + VALUE_BYTES for c, _ in fields))).cast("long"),
    })
    written = F.col("shape_bytes") + F.col("table_bytes") if fmt == "shp" else F.col("_geometry") + F.col("rows") * SHAPE_RECORD
    peak = F.lit(0) if fmt == "csv" else F.col("json_bytes") * 2 if fmt == "geojson" else F.col("json_bytes") + written * (2 if fmt in ZIPPED else 1)
    cut, clashes, many = name_checks([c for c, _ in fields]) if fmt == "shp" else ([], [], False)
    kinds = base_kinds(F.col("_kinds")) if kind and fmt in ONE_KIND else F.array().cast("array<string>")
    over = (F.col("shape_bytes") > FILE_BYTES) | (F.col("table_bytes") > FILE_BYTES) if fmt == "shp" else F.lit(False)
    words = lambda names: F.array(*map(F.lit, names)).cast("array<string>")
    return row.select(
        "rows", "shape_bytes", "table_bytes", "json_bytes", peak.cast("long").alias("peak_bytes"), over.alias("over_format"), (peak > MEMORY_BYTES).alias("over_memory"), words(cut).alias("cut_names"),
        words([f"{a} / {b}" for a, b in clashes]).alias("clashes"), F.lit(many).alias("too_many_fields"), F.when(F.size(kinds) > 1, kinds).otherwise(words([])).alias("mixed"),
    )
