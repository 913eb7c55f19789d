"""Queries over fingerprints, facets, roll-ups and reports."""

from pyspark.sql import functions as F

from stratalake.functions.text import series_code
from stratalake.operators import aggregates as agg
from stratalake.operators import catalogue, entries, geo, preflight
from stratalake.operators.ordering import numbered_within
from stratalake.queries.base import BOXES, POINTS, Register, boxes, points, sql, table

Q = Register()
B = f"({BOXES}) b"


@Q("ag1_content_fingerprint", """with e as (select o_custkey % 50 as topic, o_orderkey % 97 = 5 and o_orderstatus is distinct from 'X' as edited from orders)
select topic, count(*) as rows, true as same_in_any_order, bool_or(edited) as changed from e group by 1""")
def ag1(spark, d):
    """A topic's fingerprint against that of its rows in another order, and of its rows after an edit of some topics."""
    o = table(spark, d, "orders").withColumn("topic", F.col("o_custkey") % 50)
    edited = F.when(F.col("o_orderkey") % 97 == 5, "X").otherwise(F.col("o_orderstatus"))
    print_ = lambda df, name: agg.fingerprint(df, "v1", ("topic",)).select("topic", "rows", F.col("hash_sum").alias(name))
    one, two, three = print_(o, "a"), print_(o.repartition(7, "o_custkey"), "b").drop("rows"), print_(o.withColumn("o_orderstatus", edited), "c").drop("rows")
    return one.join(two, "topic").join(three, "topic").select("topic", "rows", (F.col("a") == F.col("b")).alias("same_in_any_order"), (F.col("a") != F.col("c")).alias("changed"))


@Q("ag9_publication_datetime", "select max(case when o_orderkey % 3 <> 0 then o_orderdate end) as newest from orders")
def ag9(spark, d):
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.lit("unknown")).otherwise(F.col("o_orderdate").cast("string"))
    return o.agg(F.max(F.try_to_timestamp(text)).cast("timestamp_ntz").alias("newest"))


FACETS = """select facet, value, count(*) as n from (select 'lang' as facet, lang as value from documents union all select 'source', source from documents
    union all select 'length', case when n_chars < 1000 then 'short' else 'long' end from documents union all select 'formats', unnest(case when doc_id % 2 = 0 then ['text', 'pdf'] else ['text'] end) from documents) t where value is not null group by 1, 2"""


def _facets(spark, d):
    t = table(spark, d, "documents")
    formats = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("text"), F.lit("pdf"))).otherwise(F.array(F.lit("text")))
    return agg.facet_counts(t, {"lang": F.col("lang"), "source": F.col("source"), "length": F.when(F.col("n_chars") < 1000, "short").otherwise("long"), "formats": formats}, ("formats",))


@Q("ag10_facet_counts", FACETS)
def ag10(spark, d):
    return _facets(spark, d)


@Q("ag11_selected_facets_kept", f"select s.facet, s.value, coalesce(c.n, 0)::bigint as n from (values ('lang', 'en'), ('lang', 'xx'), ('formats', 'pdf')) s(facet, value) left join ({FACETS}) c on s.facet = c.facet and s.value = c.value")
def ag11(spark, d):
    selected = spark.createDataFrame([("lang", "en"), ("lang", "xx"), ("formats", "pdf")], "facet string, value string")
    return agg.keep_selected(_facets(spark, d), selected)


@Q("ag12_year_histogram", "with y as (select year(o_orderdate) as y from orders), s as (select min(y) as low, max(y) as high from y) select (low + b * 5)::int as bin, (select count(*) from y where floor((y - low) / 5.0) = b) as n from s, unnest(range(0, (floor((high - low) / 5.0) + 1)::bigint)) t(b)")
def ag12(spark, d):
    return agg.histogram(table(spark, d, "orders"), F.year("o_orderdate"), 5)


@Q("ag13_filter_relief", "select filter, gain from (select 'lang' as filter, count(*) as gain from documents where lang <> 'en' and n_chars > 500 and source in ('src1', 'src2') union all select 'length', count(*) from documents where lang = 'en' and n_chars <= 500 and source in ('src1', 'src2') union all select 'source', count(*) from documents where lang = 'en' and n_chars > 500 and source not in ('src1', 'src2')) t where gain > 0")
def ag13(spark, d):
    return agg.relief(table(spark, d, "documents"), {"lang": F.col("lang") == "en", "length": F.col("n_chars") > 500, "source": F.col("source").isin("src1", "src2")})


@Q("ag14_catalogue_rollup", f"select kind, size, 2 - grouping(size) - grouping(kind) as level, count(*) as n, sum((id % 2)::bigint)::bigint as mappable, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from {B} group by rollup (kind, size)")
def ag14(spark, d):
    out = agg.rollup(boxes(spark, d), ["kind", "size"], {"mappable": F.col("id") % 2})
    return out.withColumn("level", F.col("level").cast("int"))


@Q("ag15_index_build", f"with r as (select *, (row_number() over (partition by kind order by id) - 1) // 100 as page from {B}) select kind, page, count(*) as n, md5(string_agg(id::varchar || ':' || name, ',' order by id)) as digest from r group by 1, 2")
def ag15(spark, d):
    """The index of a kind in pages of 100 entries, so that no row holds a whole kind."""
    b = numbered_within(boxes(spark, d).select("kind", "id", "name"), ["kind"], ["id"], "n")
    entries = F.array_sort(F.collect_list(F.struct("id", "name")))
    index = b.groupBy("kind", F.expr("(n - 1) div 100").alias("page")).agg(entries.alias("entries"))
    text = F.array_join(F.transform("entries", lambda e: F.concat(e["id"].cast("string"), F.lit(":"), e["name"])), ",")
    return index.select("kind", "page", F.size("entries").cast("long").alias("n"), F.md5(text).alias("digest"))


#: Parts as publications in series of their size; lines as their items, every third with a raster.
PUBLICATIONS = "select p_brand as \"group\", p_size % 20 as series, p_partkey as id, p_partkey % 97 <> 5 as moved, case p_partkey % 4 when 0 then true when 1 then false end as raster from part"
HELD = "select l_partkey as publication, l_orderkey * 100 + l_linenumber as id, l_quantity < 16 as raster from lineitem"
COVERED = f"""with p as ({PUBLICATIONS}), i as ({HELD}), n as (select publication, count(*) as n from i group by 1), c as (select "group", series, count(*) as publications, count(*) filter (where not moved) as pending, sum(coalesce(n, 0) + coalesce(raster::int, 0)) as items from p left join n on publication = id group by 1, 2)"""


def _coverage(spark, d):
    p = sql(spark, d, PUBLICATIONS.replace('"', "`"), "part")
    return p, sql(spark, d, HELD, "lineitem")


@Q("ag16_coverage_summary", COVERED + """ select "group", series, case when pending = 0 then publications else 0 end as publications, pending = 0 as migrated, pending, (case when pending = 0 then items else 0 end)::bigint as items from c""")
def ag16(spark, d):
    return entries.coverage(*_coverage(spark, d))


@Q("ag16_coverage_rasters", COVERED + """, m as (select p.* from p join c on p."group" = c."group" and p.series = c.series where pending = 0) select "group", series, id as raster from m where raster union all select m."group", m.series, i.id from m join i on i.publication = m.id where i.raster""")
def ag16_rasters(spark, d):
    """The rasters of the summary's groups, a row each."""
    pubs, items = _coverage(spark, d)
    return entries.coverage_rasters(pubs, items, entries.coverage(pubs, items))


@Q("ag17_duplicate_ids", "select id, string_agg(collection || '/' || id || '*' || n, ',' order by collection) as paths from (select o_custkey as id, o_orderstatus as collection, count(*) as n from orders group by 1, 2) t group by id having sum(n) > 1")
def ag17(spark, d):
    """Customers as ids that the status collections of orders hold."""
    found = entries.duplicate_ids(table(spark, d, "orders").select(F.col("o_orderstatus").alias("collection"), F.col("o_custkey").alias("id")))
    return found.select("id", F.array_join(F.transform("paths", lambda p: F.concat(p["path"], F.lit("*"), p["n"])), ",").alias("paths"))


@Q("ag18_shared_path_split", "with u as (select distinct user_id, event_type from events), c as (select *, count(*) over (partition by user_id) as n from u) select n = 1 as own_path, count(*) as n_rows from c group by 1")
def ag18(spark, d):
    own, shared = agg.split_shared(table(spark, d, "events").select("user_id", "event_type"), "user_id")
    both = own.withColumn("own_path", F.lit(True)).union(shared.withColumn("own_path", F.lit(False)))
    return both.groupBy("own_path").agg(F.count(F.lit(1)).alias("n_rows"))


@Q("ag19_series_counts", "select regexp_extract(upper(p_type || p_partkey), '^([A-Z]+)', 1) as series, count(*) as n from part where p_type <> '' group by 1")
def ag19(spark, d):
    """Series codes are the letters that an id begins with."""
    return entries.series_counts(table(spark, d, "part").filter("p_type <> ''"), series_code(F.concat("p_type", "p_partkey")))


@Q("ag20_newest_thumbnail", "select o_custkey, arg_max(o_orderkey, (o_orderkey % 3 <> 0, case when o_orderkey % 3 <> 0 then o_orderdate else timestamp '1900-01-01' end, o_orderkey)) as o_orderkey from orders where o_orderkey % 5 <> 0 group by 1")
def ag20(spark, d):
    """The newest order of each customer, every third being undated and every fifth without a picture."""
    when, picture = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).otherwise("")
    items = table(spark, d, "orders").select("o_custkey", "o_orderkey", when.alias("datetime"), picture.alias("thumbnail"))
    return entries.representative(items, "o_custkey", key="o_orderkey").select("o_custkey", "o_orderkey")


@Q("ag21_text_width_stats", "select 'c_name' as \"column\", max(strlen(c_name)) as longest, avg(strlen(c_name)) as average from customer union all select 'c_mktsegment', max(strlen(c_mktsegment)), avg(strlen(c_mktsegment)) from customer")
def ag21(spark, d):
    return agg.text_widths(table(spark, d, "customer"))


@Q("ag22_export_preflight", "select short, string_agg(name, ',' order by name) as names, count(*) as n from (select distinct lower(substr(p_type || '_' || p_brand, 1, 10)) as short, p_type || '_' || p_brand as name from part) t group by 1 having count(*) > 1")
def ag22(spark, d):
    """Types with brands as names of fields, which meet when they are cut."""
    names = table(spark, d, "part").select(F.concat("p_type", F.lit("_"), "p_brand").alias("name"))
    return agg.short_names(names, "name").select("short", F.array_join("names", ",").alias("names"), "n")


ESTIMATE = f"""with c as (select p.*, c_acctbal from ({POINTS}) p join customer on c_custkey = p.id where x between -113 and -111 and y between 38 and 41),
n as (select count(*) as rows, 21 * count(*) as g, max(strlen(name)) as m0, max(strlen(kind)) as m1, ceil(avg(strlen(name))) as a0, ceil(avg(strlen(kind))) as a1 from c),
t as (select *, 100 + g + rows * 40 as shape_bytes, 33 + 32 * 4 + rows * (20 + m0 + m1 + 24 + 1) as table_bytes, round(g * 2.5e0 + rows * (20 + a0 + a1 + 24 + 40 + 60 + 2 + length('customers_name') + length('customers_segment') + 7 + 24))::bigint as json_bytes from n)"""


@Q("ag22_export_estimate", ESTIMATE + " select rows, shape_bytes, table_bytes, json_bytes, json_bytes + 2 * (shape_bytes + table_bytes) as peak_bytes, false as over_format, 'customers_name,customers_segment' as cut_names, 'customers_name / customers_segment' as clashes, '' as mixed from t")
def ag22_estimate(spark, d):
    """A shapefile of the customers' points within a box: sizes, names that are cut, and those that meet then."""
    p = points(spark, d).join(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")), "id")
    x, y = F.col("x"), F.col("y")
    layer = p.select("id", F.col("name").alias("customers_name"), F.col("kind").alias("customers_segment"), "balance", geo.point_wkb(x, y).alias("geom"), F.lit("Point").alias("type"), x.alias("xmin"), y.alias("ymin"), x.alias("xmax"), y.alias("ymax"))
    r = preflight.preflight(layer, "shp", "geom", "type", (-113, 38, -111, 41))
    return r.select("rows", "shape_bytes", "table_bytes", "json_bytes", "peak_bytes", "over_format", *[F.array_join(c, ",").alias(c) for c in ("cut_names", "clashes", "mixed")])


@Q("ag23_unit_dictionary", f"select kind, size, min(name) as name, min(xmin) as xmin, max(xmax) as xmax from {B} group by 1, 2")
def ag23(spark, d):
    return boxes(spark, d).groupBy("kind", "size").agg(F.min("name").alias("name"), F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"))


@Q("ag24_lake_report", "select source, count(*) as files, sum(n_chars)::bigint as bytes, avg(n_chars) as average from documents group by 1 order by bytes desc, source limit 20")
def ag24(spark, d):
    out = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.sum("n_chars").alias("bytes"), F.avg("n_chars").alias("average"))
    return out.orderBy(F.desc("bytes"), "source").limit(20)


@Q("ag25_outcome_tally", "select case when event_id % 5 = 0 then 'ok' when event_type like 'c%' and event_id % 7 <> 0 then 'expected' else 'attention' end as outcome, count(*) as n from events group by 1")
def ag25(spark, d):
    """Events as runs: a fifth went well, others of some types were skipped, a seventh of them as too large, and the rest failed."""
    skipped = F.when(F.col("event_id") % 7 == 0, "skip:too_large:9").otherwise("skip:no_data")
    code = F.when(F.col("event_id") % 5 == 0, "ok").when(F.startswith("event_type", F.lit("c")), skipped).otherwise(F.concat(F.lit("fail:"), "event_type"))
    return entries.tally(table(spark, d, "events").withColumn("code", code), "code")


_ENDINGS = "['pdf', 'tif', 'shp', 'dbf', 'mpk', 'txt', 'PDF']"
FOUND = f"select p_brand as bundle, 'd/' || case when p_size % 4 = 0 then 'topo' else 'map' end || p_partkey || '.' || {_ENDINGS}[p_partkey % 7 + 1] as name, case p_size % 3 when 0 then true when 1 then false end as placed, p_partkey from part"
USED = "select bundle, ['source', 'geo-pdf', 'raster'][length(bundle) % 3 + 1] as tier, min(name) as plate, max(case when name like '%.shp' then name end) as shapefile from f group by bundle"


@Q("ag26_bundle_reconcile", f"""with f as ({FOUND}), u as ({USED}), k as (select f.*, u.tier, u.plate, u.shapefile, lower(string_split(name, '.')[-1]) as e from f join u using (bundle))
select bundle, name, reason from (select *, case when tier = 'source' and (e = 'pdf' or (e = 'tif' and name not like '%topo%')) then 'superseded by the source raster' when e = 'pdf' then case when placed then 'could not be rendered' when not placed then 'no coordinate system' else 'not looked at, a plate was chosen' end
    when e = 'tif' and name like '%topo%' then 'a base map, not the map itself' when e = 'tif' then case when tier = 'geo-pdf' then 'superseded by a georeferenced PDF' else 'unused raster' end when e = 'shp' then 'secondary shapefile' when e = 'mpk' then 'unsupported package' end as reason
    from k where name <> plate and not (e = 'shp' and name = shapefile) and e <> 'dbf') r where reason is not null""")
def ag26(spark, d):
    """Files of brands; of each the first by name is the plate that was used, and the last shapefile."""
    ending = F.element_at(F.array(*map(F.lit, ("pdf", "tif", "shp", "dbf", "mpk", "txt", "PDF"))), (F.col("p_partkey") % 7 + 1).cast("int"))
    name = F.concat(F.lit("d/"), F.when(F.col("p_size") % 4 == 0, "topo").otherwise("map"), "p_partkey", F.lit("."), ending)
    found = table(spark, d, "part").select(F.col("p_brand").alias("bundle"), name.alias("name"), F.when(F.col("p_size") % 3 == 0, True).when(F.col("p_size") % 3 == 1, False).alias("georeferenced"))
    tier = F.element_at(F.array(F.lit("source"), F.lit("geo-pdf"), F.lit("raster")), F.length("bundle") % 3 + 1)
    used = found.groupBy("bundle").agg(F.min("name").alias("plate"), F.max(F.when(F.endswith("name", F.lit(".shp")), F.col("name"))).alias("shapefile")).withColumn("tier", tier)
    return catalogue.unused_files(found, used)


PUBS = "select case when doc_id % 50 = 0 then 'ofr-XXXX' || doc_id when doc_id % 3 = 0 then 'M-' || doc_id else 'OFR-' || doc_id end as id, source as title, doc_id from documents"


@Q("ag27_harvest_status", f"select id, title, case when id like '%XXXX%' then 'placeholder' when doc_id in (select doc_id from labels) then 'harvested' when doc_id in (select item_id from benchmark) then 'pending' else 'pdf_only' end as status from ({PUBS}) p where upper(id) like 'OFR%' and (contains(upper(id), 'SRC1') or contains(upper(title), 'SRC1'))")
def ag27(spark, d):
    """Open-file reports of some sources; what is labelled was harvested, and what is an item has an archive."""
    pubs = sql(spark, d, PUBS, "documents")
    of = lambda t, c: pubs.join(table(spark, d, t).select(F.col(c).alias("doc_id")), "doc_id", "left_semi").select(F.lower("id").alias("id"))
    return catalogue.harvest_status(pubs, of("labels", "doc_id"), of("benchmark", "item_id"), series="ofr", text="src1")
