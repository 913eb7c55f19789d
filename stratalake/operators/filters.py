"""Predicates and projections for table pages, facets and searches."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def all_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def any_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _like(term: str) -> str:
    return "%" + re.sub(r"([\\%_])", r"\\\1", term) + "%"


def column_filters(df: DataFrame, rules: dict[str, dict]) -> Column:
    """Rules a column: min and max, contains (in any case), equals (as text). Unknown columns are passed over."""
    out = []
    for name, rule in rules.items():
        if name in df.columns:
            c = F.col(f"`{name}`")
            out += [c >= rule["min"]] if "min" in rule else []
            out += [c <= rule["max"]] if "max" in rule else []
            out += [c.cast("string").ilike(_like(rule["contains"]))] if "contains" in rule else []
            out += [c.cast("string") == str(rule["equals"])] if "equals" in rule else []
    return all_of(out)


def free_text(df: DataFrame, term: str, columns: list[str] | None = None) -> Column:
    """The term in any of the columns, in any case."""
    return F.coalesce(any_of([F.coalesce(F.col(f"`{c}`").cast("string").ilike(_like(term)), F.lit(False)) for c in columns or df.columns]), F.lit(False))


def shown_columns(df: DataFrame, hidden: tuple[str, ...] = ("geom", "geometry", "bbox", "xmin", "ymin", "xmax", "ymax", "feature_id")) -> list[tuple[str, str]]:
    """(name, number or text) of the columns that a page shows."""
    return [(n, "number" if t.split("(")[0] in NUMBERS else "text") for n, t in df.dtypes if n not in hidden]


def clean(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def unique_names(names: list[str], reserved: tuple[str, ...] = ()) -> list[str]:
    """Names that repeat in any case get _2, _3, ..., and never meet another or a reserved one."""
    taken, later, out = {r.lower() for r in reserved}, [n.lower() for n in names], []
    for i, name in enumerate(names):
        new, k = name, 1
        while new.lower() in taken or (k > 1 and new.lower() in later[i + 1 :]):
            k += 1
            new = f"{name}_{k}"
        taken.add(new.lower())
        out.append(new)
    return out


def with_unique_names(df: DataFrame, reserved: tuple[str, ...] = ()) -> DataFrame:
    """`df` with names that repeat in any case told apart."""
    return df.toDF(*unique_names(df.columns, reserved))


def mixed_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, kinds): the text columns whose values are of more than one kind (number, date, text)."""
    kind = lambda c: F.when(F.expr(f"try_cast(`{c}` as double)").isNotNull(), "number").when(F.expr(f"try_cast(`{c}` as date)").isNotNull(), "date").when(clean(F.col(f"`{c}`")).isNotNull(), "text")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), kind(c).alias("kind")) for c in columns]))
    found = df.select(pairs.alias("p")).select("p.*").filter("kind is not null")
    return found.groupBy("column").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).filter(F.size("kinds") > 1)


def drop_blank(df: DataFrame, unnamed: tuple[str, ...] = ()) -> DataFrame:
    """Rows with any value, without the unnamed columns that have none."""
    full = df.filter(any_of([clean(F.col(f"`{c}`")).isNotNull() for c in df.columns]))
    counts = full.agg(*[F.count(clean(F.col(f"`{c}`"))).alias(c) for c in unnamed]).first() if unnamed else {}
    return full.drop(*[c for c in unnamed if not counts[c]])


def facet_filter(groups: dict[str, list], multi: tuple[str, ...] = ()) -> Column:
    """All groups, any value of a group; columns in `multi` are arrays that need one common element."""
    each = [F.arrays_overlap(F.col(c), F.array(*map(F.lit, v))) if c in multi else F.col(c).isin(v) for c, v in groups.items() if v]
    return all_of([F.coalesce(e, F.lit(False)) for e in each])


def year_range(year: Column, low: int | None, high: int | None) -> Column:
    parts = [year.isNotNull()] + ([year >= low] if low is not None else []) + ([year <= high] if high is not None else [])
    return all_of(parts)


_TOKEN = re.compile(r'(-?)(?:(\w+):)?(?:"([^"]*)"|(\S+))')


def parsed_query(text: str, fields: dict[str, str]) -> tuple[list[str], str]:
    """The plain terms of a search box's text, in lower case and each once, and the rest of it: phrases, exclusions and fields."""
    plain, rest = [], []
    for m in _TOKEN.finditer(text):
        minus, field, phrase, word = m.groups()
        if minus or phrase is not None or field in fields:
            rest.append(m.group())
        else:
            plain.append((f"{field}:{word}" if field else word).lower())
    return list(dict.fromkeys(plain)), " ".join(rest)


def query_predicate(text: str, search: list[str], fields: dict[str, str]) -> Column:
    """A search box's text: terms and "phrases" in any searched column, -exclusions, and field:value.

    `fields` names the fields that can be asked for, each "exact" or "contains".
    """
    parts = []
    for minus, field, phrase, word in _TOKEN.findall(text):
        value = (phrase or word).lower()
        if field and field in fields:
            c = F.lower(F.col(field).cast("string"))
            hit = c == value if fields[field] == "exact" else c.contains(value)
        else:
            value = f"{field}:{value}" if field else value
            hit = any_of([F.coalesce(F.lower(F.col(c)).contains(value), F.lit(False)) for c in search])
        hit = F.coalesce(hit, F.lit(False))
        parts.append(~hit if minus else hit)
    return all_of(parts)


def routed(value: Column, layers: dict[str, str], middle: str) -> Column:
    """The layer of a scale; one that isn't expected, or null, goes to the middle layer."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in layers.items() for x in kv]), value.cast("string")), F.lit(middle))


def point_columns(names: list[str]) -> tuple[str, str] | None:
    """The longitude and latitude columns of a table, by their names' words."""
    words = {n: re.findall(r"[a-z]+", n.lower()) for n in names}
    lon = next((n for n, w in words.items() if {"lon", "long", "longitude", "lng"} & set(w)), None)
    lat = next((n for n, w in words.items() if {"lat", "latitude"} & set(w)), None)
    return (lon, lat) if lon and lat else None


def point_rows(df: DataFrame, box: tuple[float, float, float, float], west_positive: bool = False) -> DataFrame:
    """`df` with x and y, and status: inside, outside, blank or swapped."""
    found = point_columns(df.columns)
    if not found:
        raise ValueError("no longitude and latitude columns")
    x, y = (F.expr(f"try_cast(`{c}` as double)") for c in found)
    x = F.when(x > 0, -x).otherwise(x) if west_positive else x
    meets = lambda a, b: a.between(box[0], box[2]) & b.between(box[1], box[3])
    status = F.when(x.isNull() | y.isNull(), "blank").when(meets(x, y), "inside").when(meets(y, x), "swapped").otherwise("outside")
    return df.withColumns({"x": x, "y": y, "status": status})
