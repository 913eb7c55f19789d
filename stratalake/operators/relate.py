"""Schema and relationship inference between tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sizes of a column that can be a key.
LEAST_KEYS, MOST_KEYS = 3, 100_000
#: Fixed values of the score of two names.
SAME, STEM_IN_KEY, TABLE_ENDS, STEM_IN_TABLE, GENERIC = 40, 30, 28, 22, 10
#: The two bars, and how many values a match by the lower one has at least.
NAME_BAR, OVERLAP_BAR, SUM_BAR, LOW_NAME_BAR, MIN_SHARED = 25, 90, 80, 10, 3
#: The endings of a column that points at a key, and columns that every layer has.
KEY_ENDINGS = "(_id|_oid|_pk|_fk|id|oid)$"
ROW_NUMBERS = "(?i)^(objectid|objectid_[0-9]+|fid|fid_.*|id|shape_.*)$"
TYPES = {"string": "string", "double": "number", "float": "number", "boolean": "boolean", "date": "date", "timestamp": "datetime", "binary": "geometry", "bigint": "integer", "int": "integer", "smallint": "integer", "tinyint": "integer"}


def unpivoted(tables: dict[str, DataFrame]) -> DataFrame:
    """(tab, col, value) of the text and whole-number columns of all tables, values as text."""
    out = None
    for name, df in tables.items():
        columns = [c for c, t in df.dtypes if t in ("string", "int", "bigint", "smallint") and not re.match(ROW_NUMBERS, c)]
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
        part = df.select(F.lit(name).alias("tab"), pairs.alias("p")).select("tab", "p.*").filter("value is not null")
        out = part if out is None else out.unionAll(part)
    return out


def value_counts(values: DataFrame) -> DataFrame:
    """(tab, col, value, n): what profiles and relationships need of the values; a common value is counted before it is shuffled."""
    return values.groupBy("tab", "col", "value").agg(F.count(F.lit(1)).alias("n"))


def profiles(values: DataFrame) -> DataFrame:
    """(tab, col, rows, distinct, unique, is_key, dense) of values, or of their counts."""
    counts = values if "n" in values.columns else value_counts(values)
    number = F.expr("try_cast(value as bigint)")
    p = counts.groupBy("tab", "col").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct"), F.min(number).alias("low"), F.max(number).alias("high"), F.count(number).alias("numbers"))
    unique = F.col("rows") == F.col("distinct")
    dense = (F.col("numbers") == F.col("distinct")) & F.col("low").isin(0, 1) & (F.col("high") - F.col("low") + 1 == F.col("distinct"))
    return p.select("tab", "col", "rows", "distinct", unique.alias("unique"), (unique & F.col("distinct").between(LEAST_KEYS, MOST_KEYS)).alias("is_key"), F.coalesce(dense, F.lit(False)).alias("dense"))


def stem(name: Column) -> Column:
    """A name without the ending of a key."""
    return F.coalesce(F.nullif(F.regexp_extract(name, f"(?i)^(.+?){KEY_ENDINGS}", 1), F.lit("")), name)


def forms(word: Column) -> Column:
    """A word with its singular or plurals."""
    cut = lambda n: F.substring(word, F.lit(1), F.length(word) - n)
    return (
        F.when(F.endswith(word, F.lit("ies")), F.array(word, F.concat(cut(3), F.lit("y")))).when(F.endswith(word, F.lit("s")), F.array(word, cut(1)))
        .when(F.endswith(word, F.lit("y")), F.array(word, F.concat(cut(1), F.lit("ies")), F.concat(word, F.lit("s")))).otherwise(F.array(word, F.concat(word, F.lit("s"))))
    )


def words(name: Column) -> Column:
    """The words of four letters or more of a name without its ending, in lower case and singular."""
    spaced = F.regexp_replace(F.regexp_replace(stem(name), "([A-Z]+)([A-Z][a-z])", "$1 $2"), "([a-z])([A-Z])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", "$1 $2")
    each = F.filter(F.transform(F.split(spaced, "[^A-Za-z0-9]+"), F.lower), lambda w: F.length(w) >= 4)
    cut = lambda w, n: F.substring(w, F.lit(1), F.length(w) - n)
    return F.transform(each, lambda w: F.when(F.endswith(w, F.lit("ies")), F.concat(cut(w, 3), F.lit("y"))).when(F.endswith(w, F.lit("s")), cut(w, 1)).otherwise(w))


def _any(word: Column, least: int, test) -> Column:
    return F.exists(forms(word), lambda f: (F.length(f) >= least) & test(f))


def name_score(column: Column, key: Column, tab: Column) -> Column:
    """How well a column's name points at a key column of a table; a stem counts in its singular and plural."""
    c, k, t = F.lower(column), F.lower(key), F.lower(tab)
    s = stem(c)
    return (
        F.when(c == k, SAME).when(_any(s, 3, lambda f: F.contains(k, f)), STEM_IN_KEY).when(_any(s, 3, lambda f: F.endswith(t, F.concat(F.lit("_"), f))), TABLE_ENDS)
        .when(_any(s, 4, lambda f: F.contains(t, f)), STEM_IN_TABLE).when(s != c, GENERIC).otherwise(0)
    )


def affinity(key: Column, tab: Column) -> Column:
    """Is a key column named after its table?"""
    return _any(stem(F.lower(key)), 3, lambda f: F.contains(F.lower(tab), f))


def relationships(values: DataFrame, profile: DataFrame, layers: DataFrame) -> DataFrame:
    """(origin, origin_col, destination, destination_col, score, overlap, confidence, affinity, keys) of the pairs that pass a bar.

    `layers` has (tab, grp, spatial): both tables are of one group, and the keyed one isn't spatial. A key that numbers rows
    counts only if it is named after its table. The distinct values of all columns are joined to those of key columns on the value; `values` is
    read once and written by the caller.
    """
    distinct = values.select("tab", "col", "value") if "n" in values.columns else values.select("tab", "col", "value").distinct()
    sizes = profile.select("tab", "col", F.col("distinct").alias("size"))
    named = affinity(F.col("col"), F.col("tab"))
    keys = profile.filter("is_key").join(layers, "tab").filter(~F.col("spatial") & (~F.col("dense") | named)).select(F.col("tab").alias("k_tab"), F.col("col").alias("k_col"), named.alias("affinity"), F.col("grp").alias("k_grp"), F.col("distinct").alias("keys"))
    key_values = distinct.join(keys, (F.col("tab") == F.col("k_tab")) & (F.col("col") == F.col("k_col"))).select("k_tab", "k_col", "affinity", "k_grp", "keys", F.col("value").alias("k_value"))
    shared = distinct.join(layers.select("tab", "grp"), "tab").join(key_values, (F.col("value") == F.col("k_value")) & (F.col("grp") == F.col("k_grp"))).filter("tab <> k_tab")
    shared = shared.groupBy("tab", "col", "k_tab", "k_col", "affinity", "keys").agg(F.count(F.lit(1)).alias("both"))
    scored = shared.join(sizes, ["tab", "col"]).withColumns({"overlap": F.col("both") * 100 / F.col("size"), "score": name_score(F.col("col"), F.col("k_col"), F.col("k_tab"))})
    total = F.col("score") + 0.6 * F.col("overlap")
    main = (F.col("score") >= NAME_BAR) & (F.col("overlap") >= OVERLAP_BAR) & (total >= SUM_BAR)
    common = F.arrays_overlap(words(F.col("col")), F.concat(words(F.col("k_tab")), words(F.col("k_col"))))
    low = (F.col("score") >= LOW_NAME_BAR) & (F.col("both") == F.col("size")) & (F.col("both") >= MIN_SHARED) & F.col("k_col").rlike("(?i)id$") & common
    passed = scored.filter(main | low)
    return passed.select(F.col("tab").alias("origin"), F.col("col").alias("origin_col"), F.col("k_tab").alias("destination"), F.col("k_col").alias("destination_col"), "score", F.round("overlap", 1).alias("overlap"), total.alias("confidence"), "affinity", "keys")


def best_pairs(rels: DataFrame, profile: DataFrame) -> DataFrame:
    """The best relationship of two tables, in the direction of the larger key, with its cardinality."""
    unique = profile.select(F.col("tab").alias("origin"), F.col("col").alias("origin_col"), "unique")
    best = rels.groupBy("origin", "destination").agg(F.max(F.struct("confidence", "overlap", "affinity", "keys", "origin_col", "destination_col")).alias("r")).select("origin", "destination", "r.*")
    pair = F.array_sort(F.array("origin", "destination"))
    one = best.groupBy(pair.alias("pair")).agg(F.max(F.struct("keys", "destination", "origin", "origin_col", "destination_col", "confidence", "overlap")).alias("r")).select("r.*").drop("keys")
    shown = one.withColumn("confidence", F.floor(F.col("confidence") + 0.5).cast("int"))
    return shown.join(unique, ["origin", "origin_col"]).withColumn("cardinality", F.when(F.col("unique"), "one_to_one").otherwise("many_to_one")).drop("unique")


def merged(declared: DataFrame, inferred: DataFrame) -> DataFrame:
    """Declared relationships, and inferred ones of tables that no declared one joins, whatever its direction."""
    pair = F.array_sort(F.array("origin", "destination"))
    known = declared.select(pair.alias("pair")).distinct()
    rest = inferred.withColumn("pair", pair).join(known, "pair", "left_anti").drop("pair")
    return declared.withColumn("detected_by", F.lit("declared")).unionByName(rest.select(declared.columns).withColumn("detected_by", F.lit("inferred")))


def layer_kinds(layers: DataFrame, rels: DataFrame) -> DataFrame:
    """layer if spatial, table if in a relationship, else supporting."""
    joined = rels.select(F.explode(F.array("origin", "destination")).alias("name")).distinct().withColumn("related", F.lit(True))
    kind = F.when(F.col("spatial"), "layer").when(F.col("related"), "table").otherwise("supporting")
    return layers.join(joined, "name", "left").select("name", kind.alias("kind"))


def reference_tables(rels: DataFrame, layers: int) -> DataFrame:
    """Tables that at least three, and half of the layers, point at."""
    return rels.groupBy("destination").agg(F.count_distinct("origin").alias("n")).filter((F.col("n") >= 3) & (2 * F.col("n") >= layers))


def common_type(kind: str) -> str:
    """The catalogue's name of a Spark type."""
    return "number" if kind.startswith("decimal") else TYPES.get(kind, kind)

