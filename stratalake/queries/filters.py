"""Queries over pages of tables."""

from pyspark.sql import functions as F

from stratalake.operators import entries, filters
from stratalake.queries.base import POINTS, Register, points, table

Q = Register()


@Q("pf9_column_filters", "select l_orderkey, l_linenumber from lineitem where l_quantity between 10 and 20 and lower(l_returnflag) like '%r%' and l_linenumber::varchar = '2'")
def pf9(spark, d):
    t = table(spark, d, "lineitem")
    rules = {"l_quantity": {"min": 10, "max": 20}, "l_returnflag": {"contains": "R"}, "l_linenumber": {"equals": 2}, "nowhere": {"equals": 1}}
    return t.filter(filters.column_filters(t, rules)).select("l_orderkey", "l_linenumber")


@Q("pf10_free_text_filter", "select c_custkey from customer where c_name ilike '%01%' or c_mktsegment ilike '%01%' or c_custkey::varchar ilike '%01%'")
def pf10(spark, d):
    t = table(spark, d, "customer")
    return t.filter(filters.free_text(t, "01", ["c_name", "c_mktsegment", "c_custkey"])).select("c_custkey")


@Q("pf11_hidden_columns", "select * from (values ('id', 'number'), ('name', 'text'), ('kind', 'text'), ('x', 'number'), ('y', 'number')) t(name, kind) where exists (select 1 from customer)")
def pf11(spark, d):
    p = points(spark, d).withColumn("bbox", F.struct("x", "y"))
    shown = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind")) for n, k in filters.shown_columns(p)])
    return p.limit(1).select(F.explode(shown).alias("c")).select("c.*")


@Q("pf12_select_except_replace", "select * exclude (p_retailprice) replace (upper(p_brand) as p_brand) from part")
def pf12(spark, d):
    return table(spark, d, "part").drop("p_retailprice").withColumn("p_brand", F.upper("p_brand"))


@Q("pf13_clean_text", "select doc_id, nullif(trim(case when doc_id % 3 = 0 then '  ' else source || ' ' end), '') as source from documents")
def pf13(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", filters.clean(F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.concat("source", F.lit(" ")))).alias("source"))


@Q("pf14_point_rows_from_table", f"select case when id % 10 = 0 then 'blank' when x between -113 and -110 and y between 38 and 41 then case when id % 10 = 1 then 'swapped' else 'inside' end else 'outside' end as status, count(*) as n from {'(' + POINTS + ') p'} group by 1")
def pf14(spark, d):
    p = points(spark, d)
    lon = F.when(p.id % 10 == 0, "").when(p.id % 10 == 1, p.y.cast("string")).otherwise((-p.x).cast("string"))
    lat = F.when(p.id % 10 == 1, p.x.cast("string")).otherwise(p.y.cast("string"))
    t = p.select(p.id, lon.alias("Well Longitude"), lat.alias("Lat (deg)"))
    west = t.withColumn("Well Longitude", F.when(F.col("id") % 10 != 1, F.concat(F.lit("-"), F.col("Well Longitude"))).otherwise(F.col("Well Longitude")))
    west = west.withColumn("Well Longitude", F.when(F.col("id") % 10 == 0, "").otherwise(F.col("Well Longitude")))
    return filters.point_rows(west, (-113, 38, -110, 41)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@Q("pf15_column_dedupe", "select s_suppkey as suppkey, s_name as name, s_nationkey as nationkey, n_nationkey as nationkey_2, n_name as name_2, n_regionkey as id_2 from supplier join nation on s_nationkey = n_nationkey")
def pf15(spark, d):
    """Two tables side by side, their names without prefixes; one meets a reserved name."""
    s, n = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("n_id"))
    both = s.join(n, s.s_nationkey == n.n_nationkey)
    return filters.with_unique_names(both.toDF(*[c[2:] for c in both.columns]), ("id",))


@Q("pf16_mixed_type_to_text", "select 'a' as \"column\", ['date', 'number', 'text'] as kinds from part limit 1")
def pf16(spark, d):
    p = table(spark, d, "part")
    a = F.when(p.p_partkey % 3 == 0, "2020-01-05").when(p.p_partkey % 3 == 1, p.p_size.cast("string")).otherwise(p.p_brand)
    return filters.mixed_columns(p.select(a.alias("a"), p.p_size.cast("string").alias("b")), ["a", "b"])


@Q("pf17_drop_blank_rows_columns", "select p_partkey::varchar as k, p_brand as b from part where p_partkey % 4 <> 0")
def pf17(spark, d):
    p = table(spark, d, "part")
    keep = p.p_partkey % 4 != 0
    t = p.select(F.when(keep, p.p_partkey.cast("string")).otherwise(" ").alias("k"), F.when(keep, p.p_brand).alias("b"), F.lit("").alias("column_3"))
    return filters.drop_blank(t, ("column_3",))


@Q("pf18_facet_filter", "select doc_id from documents where lang in ('de', 'fr') and list_has_any([source, lang], ['src1', 'src2', 'fr'])")
def pf18(spark, d):
    t = table(spark, d, "documents").withColumn("formats", F.array("source", "lang"))
    return t.filter(filters.facet_filter({"lang": ["de", "fr"], "formats": ["src1", "src2", "fr"]}, ("formats",))).select("doc_id")


@Q("pf20_year_range_filter", "select o_orderkey from orders where o_orderkey % 5 <> 0 and year(o_orderdate) >= 1995 and year(o_orderdate) <= 1996")
def pf20(spark, d):
    o = table(spark, d, "orders")
    year = F.when(F.col("o_orderkey") % 5 != 0, F.year("o_orderdate"))
    return o.filter(filters.year_range(year, 1995, 1996)).select("o_orderkey")


#: Parts as items: rasters by type or by name, tiles, tables, stand-ins and items without a place.
DRAWN = "(p_size % 4 = 0 or p_size % 4 = 1 or p_partkey % 5 = 0)"


def _items(spark, d):
    p = table(spark, d, "part")
    size, key, none = F.col("p_size") % 4, F.col("p_partkey"), F.lit(None).cast("string")
    href = F.concat(F.lit("f/"), key, F.when(size == 1, ".cog.tif").otherwise(".tif"))
    asset = F.struct(href.alias("href"), F.when(size == 0, "image/tiff; profile=cloud-optimized").otherwise("image/tiff").alias("type"), F.array(F.lit("data")).alias("roles"))
    link = F.struct(F.when(key % 5 == 0, "pmtiles").otherwise("parent").alias("rel"), F.concat(F.lit("t/"), key).alias("href"))
    facts = {"title": F.col("p_name"), "series": F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(""), "secret": F.col("p_type"), "footprint_source": F.when(key % 7 == 0, "utah-bbox"), "layer_kind": F.when(key % 11 == 0, "table").otherwise("points")}
    properties = F.create_map(*[x for k, v in facts.items() for x in (F.lit(k), v)])
    return p.select(
        key.cast("string").alias("id"), F.when(key % 2 == 0, F.col("p_brand")).otherwise(none).alias("collection"), F.when(key % 3 != 0, "geometry").alias("geometry"), F.array(F.lit(-112.0), F.lit(38.0), F.lit(-111.0), F.lit(39.0)).alias("bbox"),
        properties.alias("properties"), F.create_map(F.lit("data"), asset).alias("assets"), F.array(link).alias("links"),
    )


@Q("pf21_mappable_test", f"select p_partkey::varchar as id from part where {DRAWN} and p_partkey % 3 <> 0 and p_partkey % 7 <> 0 and p_partkey % 11 <> 0")
def pf21(spark, d):
    of = lambda k: F.try_element_at("properties", F.lit(k))
    return _items(spark, d).filter(entries.mappable(F.col("assets"), F.col("links"), F.col("geometry"), of("footprint_source"), of("layer_kind"))).select("id")


@Q("pf22_query_predicates", "select doc_id from documents where contains(lower(text), 'the') and contains(lower(text), 'of the') and not contains(lower(text), 'which') and lower(lang) = 'en' and contains(lower(source), '1')")
def pf22(spark, d):
    return table(spark, d, "documents").filter(filters.query_predicate('the "of the" -which lang:en source:1', ["text"], {"lang": "exact", "source": "contains"})).select("doc_id")


@Q("pf23_compact_projection", """select p_partkey::varchar as id, p_partkey % 3 <> 0 and p_partkey % 7 <> 0 and p_partkey % 11 <> 0 as placed, 'title=' || p_name || case when p_size > 25 then ',series=' || p_brand else '' end || ',layer_kind=' || case when p_partkey % 11 = 0 then 'table' else 'points' end as props,
    'f/' || p_partkey || case when p_size % 4 = 1 then '.cog.tif' else '.tif' end as data, './' || case when p_partkey % 2 = 0 then p_brand || '/' else '' end || p_partkey || '/' || p_partkey || '.json' || case when p_partkey % 5 = 0 then ',t/' || p_partkey else '' end as links from part""")
def pf23(spark, d):
    e = entries.index_entries(_items(spark, d))
    props = F.array_join(F.transform(F.map_entries("properties"), lambda p: F.concat(p["key"], F.lit("="), p["value"])), ",")
    return e.select("id", F.col("bbox").isNotNull().alias("placed"), props.alias("props"), F.try_element_at("assets", F.lit("data"))["href"].alias("data"), F.array_join("links.href", ",").alias("links"))


@Q("pf24_validation_layer_filter", "select s_suppkey from supplier where s_suppkey % 3 <> 0")
def pf24(spark, d):
    s = table(spark, d, "supplier")
    label = F.when(s.s_suppkey % 3 == 0, F.concat(F.lit("top/T_"), s.s_suppkey, F.lit("_LineErrors"))).otherwise(s.s_name)
    return s.withColumn("label", label).filter(~entries.is_error_layer(F.col("label"))).select("s_suppkey")


@Q("pf26_scale_layer_split", "select p_partkey, case when p_size % 4 = 1 then 'large' when p_size % 4 = 2 then 'small' else 'middle' end as layer from part")
def pf26(spark, d):
    p = table(spark, d, "part")
    scale = F.when(p.p_size % 4 == 0, None).otherwise(p.p_size % 4)
    return p.select("p_partkey", filters.routed(scale, {"1": "large", "2": "small"}, "middle").alias("layer"))
