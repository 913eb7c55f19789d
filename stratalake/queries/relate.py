"""Queries over relationships between the tables, with column prefixes stripped."""

from pyspark.sql import functions as F

from stratalake.operators import relate, styles, units
from stratalake.plans.storage import written
from stratalake.queries.base import Register, sql, table

Q = Register()
TABLES = {"region": "r_", "nation": "n_", "customer": "c_", "supplier": "s_", "part": "p_"}
#: Customers are a map layer, and parts are of another dataset.
LAYERS_SQL = "l as (select * from (values ('region', 'trade', false), ('nation', 'trade', false), ('customer', 'trade', true), ('supplier', 'trade', false), ('part', 'goods', false)) x(tab, grp, spatial))"


def _layers(spark):
    rows = [(t, "goods" if t == "part" else "trade", t == "customer") for t in TABLES]
    return spark.createDataFrame(rows, "tab string, grp string, spatial boolean")


def _tables(spark, d):
    """The tables as a geodatabase would name them: no prefixes, keys end in _id."""
    named = lambda c, prefix: c.removeprefix(prefix).replace("key", "_id")
    return {name: (t := table(spark, d, name)).toDF(*[named(c, prefix) for c in t.columns]) for name, prefix in TABLES.items()}


def _values(spark, d):
    return written(relate.value_counts(relate.unpivoted(_tables(spark, d))), "values")


_COLUMNS = {
    "region": ("regionkey", "name"), "nation": ("nationkey", "name", "regionkey"), "customer": ("custkey", "name", "nationkey", "mktsegment"),
    "supplier": ("suppkey", "name", "nationkey"), "part": ("partkey", "name", "brand", "type", "size"),
}
V = "v as (" + " union all ".join(f"select '{t}' as tab, '{c.replace('key', '_id')}' as col, {TABLES[t]}{c}::varchar as value from {t}" for t, cs in _COLUMNS.items() for c in cs) + ")"
PROFILE = """p as (select tab, col, sum(n)::bigint as rows, count(*) as "distinct", min(try_cast(value as bigint)) as low, max(try_cast(value as bigint)) as high, count(try_cast(value as bigint)) as numbers
    from (select tab, col, value, count(*) as n from v group by 1, 2, 3) group by 1, 2),
f as (select tab, col, rows, "distinct", rows = "distinct" as "unique", rows = "distinct" and "distinct" between 3 and 100000 as is_key, coalesce(numbers = "distinct" and low in (0, 1) and high - low + 1 = "distinct", false) as dense from p)"""
STEM = "coalesce(nullif(regexp_extract(lower({0}), '^(.+?)(_id|_oid|_pk|_fk|id|oid)$', 1), ''), lower({0}))"
FORMS = f"(case when {STEM} like '%ies' then [{STEM}, {STEM}[:-4] || 'y'] when {STEM} like '%s' then [{STEM}, {STEM}[:-2]] when {STEM} like '%y' then [{STEM}, {STEM}[:-2] || 'ies', {STEM} || 's'] else [{STEM}, {STEM} || 's'] end)"
ANY = "len(list_filter(" + FORMS.replace("{", "{{").replace("}", "}}").replace("{{0}}", "{0}") + ", lambda f: length(f) >= {1} and {2})) > 0"
SCORE = (
    "case when lower({c}) = lower({k}) then 40 when " + ANY.format("{c}", 3, "contains(lower({k}), f)") + " then 30 when " + ANY.format("{c}", 3, "ends_with(lower({t}), '_' || f)") + " then 28 when "
    + ANY.format("{c}", 4, "contains(lower({t}), f)") + " then 22 when " + STEM.format("{c}") + " <> lower({c}) then 10 else 0 end"
)
CASES = "('MapUnit', 'MapUnit', 'DescriptionOfMapUnits'), ('DataSourceID', 'DataSources_ID', 'DataSources'), ('CategoriesID', 'Category_ID', 'Category'), ('UnitID', 'Code', 'geo_unit'), ('StationID', 'Code', 'FieldStations'), ('LocationSourceID', 'DataSources_ID', 'DataSources'), ('Notes', 'MapUnit', 'DescriptionOfMapUnits')"
NAMES = f"select p_brand || case when p_size % 2 = 0 then '_id' else '' end as c, p_type as k, p_name || '_' || lower(p_brand) as t from part union all select * from (values {CASES}) x(c, k, t)"
WORDS = "list_transform(list_filter(string_split_regex(" + STEM + ", '[^a-z0-9]+'), lambda w: length(w) >= 4), lambda w: case when w like '%ies' then w[:-4] || 'y' when w like '%s' then w[:-2] else w end)"
RELS = f"""with {V}, {PROFILE}, {LAYERS_SQL},
u as (select distinct tab, col, value, grp from v join l using (tab)),
k as (select f.tab, f.col, grp, "distinct" as keys, {ANY.format('f.col', 3, 'contains(lower(f.tab), f)')} as affinity, dense from f join l on f.tab = l.tab where is_key and not spatial),
s as (select a.tab, a.col, b.tab as k_tab, b.col as k_col, k.affinity, k.keys, count(*) as n from u a join u b on a.value = b.value and a.tab <> b.tab and a.grp = b.grp join k on k.tab = b.tab and k.col = b.col where not k.dense or k.affinity group by all),
o as (select s.tab as origin, s.col as origin_col, k_tab as destination, k_col as destination_col, n, f."distinct" as size, n * 100.0e0 / f."distinct" as overlap, {SCORE.format(c='s.col', k='k_col', t='k_tab')} as score, affinity, keys from s join f on s.tab = f.tab and s.col = f.col),
r as (select origin, origin_col, destination, destination_col, score, round(overlap, 1) as overlap, score + 0.6e0 * overlap as confidence, affinity, keys from o
    where (score >= 25 and overlap >= 90 and score + 0.6e0 * overlap >= 80) or (score >= 10 and n = size and n >= 3 and destination_col ilike '%id'
        and list_has_any({WORDS.format('origin_col')}, {WORDS.format('destination')} || {WORDS.format('destination_col')})))
"""


@Q("ri1_column_profile", f'with {V}, {PROFILE} select tab, col, rows, "distinct", "unique", is_key, dense from f')
def ri1(spark, d):
    return relate.profiles(_values(spark, d))


@Q("ri2_name_score", f"select c, k, t, {SCORE.format(c='c', k='k', t='t')} as score from ({NAMES}) n")
def ri2(spark, d):
    return sql(spark, d, NAMES, "part").withColumn("score", relate.name_score(F.col("c"), F.col("k"), F.col("t")))


def _rels(spark, d):
    v = _values(spark, d)
    p = written(relate.profiles(v), "profiles")
    return written(relate.relationships(v, p, _layers(spark)), "relationships"), p


@Q("ri3_infer_relationships", RELS + "select origin, origin_col, destination, destination_col, score, overlap, confidence, affinity, keys from r")
def ri3(spark, d):
    return _rels(spark, d)[0]


BEST = RELS + """,
x as (select origin, destination, arg_max((origin_col, destination_col, confidence), (confidence, overlap, affinity, keys, origin_col, destination_col)) as v, arg_max(keys, (confidence, overlap, affinity, keys, origin_col, destination_col)) as keys from r group by 1, 2),
c as (select origin, destination, v[1] as origin_col, v[2] as destination_col, floor(v[3] + 0.5)::int as confidence from (select *, row_number() over (partition by least(origin, destination), greatest(origin, destination) order by keys desc, destination desc) as j from x) where j = 1)
"""


@Q("ri4_best_pair_per_tables", BEST + "select c.origin, c.origin_col, c.destination, c.destination_col, c.confidence, case when f.\"unique\" then 'one_to_one' else 'many_to_one' end as cardinality from c join f on f.tab = c.origin and f.col = c.origin_col")
def ri4(spark, d):
    rels, p = _rels(spark, d)
    return relate.best_pairs(rels, p).select("origin", "origin_col", "destination", "destination_col", "confidence", "cardinality")


@Q("ri5_merge_declared_inferred", BEST + "select 'nation' as origin, 'customer' as destination, 'declared' as detected_by union all select origin, destination, 'inferred' from c where not (origin in ('nation', 'customer') and destination in ('nation', 'customer'))")
def ri5(spark, d):
    rels, p = _rels(spark, d)
    declared = spark.createDataFrame([("nation", "customer")], "origin string, destination string")
    return relate.merged(declared, relate.best_pairs(rels, p))


@Q("ri6_layer_kind", BEST + "select t.name, case when t.name in ('customer', 'part') then 'layer' when t.name in (select origin from c union select destination from c) then 'table' else 'supporting' end as kind from (select distinct tab as name from v) t")
def ri6(spark, d):
    rels, p = _rels(spark, d)
    layers = p.select(F.col("tab").alias("name")).distinct().withColumn("spatial", F.col("name").isin("customer", "part"))
    return relate.layer_kinds(layers, relate.best_pairs(rels, p))


@Q("ri7_reference_tables", "select c_nationkey as destination, count(distinct c_mktsegment) as n from customer group by 1 having count(distinct c_mktsegment) >= 3 and 2 * count(distinct c_mktsegment) >= 5")
def ri7(spark, d):
    rels = table(spark, d, "customer").select(F.col("c_nationkey").alias("destination"), F.col("c_mktsegment").alias("origin"))
    return relate.reference_tables(rels, 5)


#: Layers of bundles by brand: unit layers of all schemas with and without a code column, and others.
LAYERS = """select p_brand as bundle, p_partkey as id, case p_partkey % 6 when 0 then 'a/MapUnitPolys' when 1 then 'q_GeologicUnits' when 2 then 'cov_units' when 3 then 'Faults' when 4 then 'x/Geologic_Polys' else 'geologicunit_nad83' end || case when p_size % 5 = 0 then '_old' else '' end as label,
    p_partkey % 7 <> 0 as spatial, p_size // 10 as rows, case when p_partkey % 8 = 0 then 'LineString' else 'MultiPolygon' end as geometry, case when p_size % 3 = 0 then 'map_unit' when p_size % 3 = 1 then 'UNIT_SYMBOL' else 'Label12345' end as code from part"""
_RANK = "case when regexp_matches(n, 'mapunitpolys$') then 0 when regexp_matches(n, 'geologicunits?(_nad[0-9]{2}|_[0-9]{8})?$') then 1 when regexp_matches(n, '(^|[_-])(geounits?|units?|geology_?polys?)$') then 2 end"


@Q("ri8_unit_layer_select", f"""with l as (select *, lower(string_split(label, '/')[-1]) as n from ({LAYERS}) x where spatial and rows > 0 and geometry like '%Polygon%'), r as (select *, {_RANK} as rank from l),
k as (select *, case when code = 'map_unit' or (code = 'UNIT_SYMBOL' and rank > 0) then code end as own, case when code = 'Label12345' then 1 else 0 end as cut from r where rank is not null),
c as (select *, row_number() over (partition by bundle order by rank, -rows, cut, label, own) as place, count(*) over (partition by bundle) as n_all, (min(rank) over w <> max(rank) over w or min(rows) over w <> max(rows) over w) as differs from k where own is not null window w as (partition by bundle)),
b as (select distinct bundle from k)
select b.bundle, c.label, ['gems', 'template', 'coverage'][rank + 1] as schema, own as code, case when differs then n_all - 1 else 0 end::int as others, case when c.bundle is null then (select count(distinct label) from k where k.bundle = b.bundle) else 0 end::int as unusable
from b left join c on c.bundle = b.bundle and place = 1""")
def ri8(spark, d):
    layers = sql(spark, d, LAYERS.replace("//", "div"), "part").withColumns({"geometry_types": F.array("geometry"), "columns": F.array(F.lit("OBJECTID"), "code")})
    return units.unit_layers(layers).select("bundle", "label", "schema", "code", F.size("others").alias("others"), F.size("unusable").alias("unusable"))


@Q("ri9_unit_polys_normalise", """select 'M-1' as series_id, p_brand as unit_code, nullif(trim(case when p_size % 2 = 0 then null else p_name end), '') as unit_name, p_type as age, 'layer' as source_label, p_partkey as geom from part where p_partkey % 9 <> 0
union all select 'M-2', p_brand, s.name, null, 'polys', p_partkey from part left join (select 'Brand#' || (s_suppkey % 60) as k, min(s_name) as name from supplier group by 1) s on s.k = p_brand""")
def ri9(spark, d):
    """A layer that has its own attributes, and one that is described by a table in which codes repeat."""
    p = table(spark, d, "part")
    own = p.select(F.col("p_brand").alias("UnitSymbol"), F.when(F.col("p_size") % 2 == 0, "  ").otherwise(F.col("p_name")).alias("UnitName"), F.col("p_type").alias("Age"), F.when(F.col("p_partkey") % 9 != 0, F.col("p_partkey")).alias("geom"))
    first = units.unit_rows(own, "M-1", "layer", {"code": "UnitSymbol", "name": "UnitName", "age": "Age"}, "geom")
    described = table(spark, d, "supplier").select(F.concat(F.lit(" Brand#"), F.col("s_suppkey") % 60).alias("MapUnit"), F.lit("").alias("Name"), F.col("s_name").alias("Full_Name"))
    second = units.unit_rows(p.select(F.col("p_brand").alias("MapUnit"), F.col("p_partkey").alias("geom")), "M-2", "polys", {"code": "MapUnit", "name": "Name"}, "geom", described, ("MapUnit", "MapUnit"))
    return first.union(second).drop("description")


@Q("ri10_table_columns", "select 'orders' as tab, * from (values ('o_orderkey', 'integer'), ('o_custkey', 'integer'), ('o_orderstatus', 'string'), ('o_totalprice', 'number'), ('o_orderdate', 'datetime'), ('o_orderpriority', 'string')) x(name, kind) where exists (select 1 from orders)")
def ri10(spark, d):
    o = table(spark, d, "orders")
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(relate.common_type(t.replace("timestamp_ntz", "timestamp"))).alias("kind")) for n, t in o.dtypes])
    return o.limit(1).select(F.lit("orders").alias("tab"), F.explode(rows).alias("c")).select("tab", "c.*")


@Q("ri11_style_classes", """with p as (select p_partkey, p_size, p_brand, p_type, '#' || lpad(p_size::varchar, 6, '0') as c from part),
k as (select p_partkey, 0 as value, p_brand as title, c as colour from p where p_partkey % 3 = 0 union all select p_partkey, 1, p_type, '#ABCDEF' from p where p_partkey % 3 = 0 union all select p_partkey, 2, 'Other', '#000000' from p where p_partkey % 3 = 0
    union all select p_partkey, 0, '< ' || p_size, '#000000' from p where p_partkey % 3 = 1 union all select p_partkey, 1, '≥ ' || p_size, c from p where p_partkey % 3 = 1
    union all select p_partkey, 0, p_brand, c from p where p_partkey % 3 = 2 union all select p_partkey, 1, p_size || ' – ' || (p_size + 1), '#ABCDEF' from p where p_partkey % 3 = 2)
select p_partkey, value, trim(regexp_replace(title, '[^0-9A-Za-z_-]+', '_', 'g'), '_') as name, title, upper(substr(colour, 2)) as hint from k""")
def ri11(spark, d):
    """Styles by turns: a colour that matches brand or type, one that steps at the size, and layers with filters."""
    p = table(spark, d, "part").withColumn("c", F.concat(F.lit("#"), F.lpad(F.col("p_size").cast("string"), 6, "0")))
    fill = '[{"paint":{"fill-opacity":1,"fill-color":["match",["get","u"],"%s","%s",["%s"],"#ABCDEF","#000000"]}}]'
    line = '[{"paint":{"line-color":["step",["get","u"],"#000000",%d,"%s"]}}]'
    spots = '[{"paint":{"circle-color":"%s"},"filter":["==",["get","u"],"%s"]},{"paint":{"circle-color":"#ABCDEF"},"filter":["all",[">=","u",%d],["<","u",%d]]}]'
    turn = F.col("p_partkey") % 3
    layers = F.when(turn == 0, F.format_string(fill, "p_brand", "c", "p_type")).when(turn == 1, F.format_string(line, "p_size", "c")).otherwise(F.format_string(spots, "c", "p_brand", "p_size", F.col("p_size") + 1))
    return styles.style_classes(p.select("p_partkey", layers.alias("layers")), "p_partkey", "layers")


@Q("ri12_inference_scope", "select p_partkey, case when p_size % 2 = 0 then p_brand else 'bundle' end as scope from part where p_size % 5 <> 0")
def ri12(spark, d):
    p = table(spark, d, "part")
    label = F.when(p.p_size % 2 == 0, F.concat("p_brand", F.lit("__"), "p_name")).otherwise(F.col("p_name"))
    folder = F.regexp_extract("label", "^(.*)__[^_]", 1)
    scoped = p.withColumn("label", label).withColumn("scope", F.coalesce(F.nullif(folder, F.lit("")), F.lit("bundle")))
    known = p.filter("p_size % 5 <> 0").select("p_partkey")
    return scoped.join(known, "p_partkey", "left_semi").select("p_partkey", "scope")
