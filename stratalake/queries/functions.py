"""Queries that apply the column functions to texts made from the tables."""

from pyspark.sql import functions as F

from stratalake.functions import contents, people
from stratalake.functions import text as fx
from stratalake.functions.rules import MEDIA, TOPICS
from stratalake.operators import catalogue
from stratalake.operators.reviews import mentions
from stratalake.queries.base import Register, sql, table

Q = Register()


def _pick(values: list[str | None], by: str = "p_partkey") -> str:
    """A SQL case over `by` modulo the number of values."""
    quoted = ["null" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return f"case {by} % {len(values)} " + " ".join(f"when {i} then {v}" for i, v in enumerate(quoted)) + " end"


def _case(spark, d, values, then=None):
    return sql(spark, d, f"select p_partkey, p_size, p_brand, p_name, {_pick(values)} as t from part", "part")


def _sql(results: list, name: str = "v") -> str:
    values = ["null" if r is None else f"'{r}'" if isinstance(r, str) else f"{r}::double" if isinstance(r, float) else str(r) for r in results]
    return f"select p_partkey, case p_partkey % {len(values)} " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + f" end as {name} from part"


SCALES = [
    "1:24,000", "1 : 24,000", "1:24 000", "24000", "100k", "1:62.500", "1:2,950,000", "1 inch = 200 feet", "1 inch = 2,000 feet", "1:62,500 and 1:24,000", "no scale", None, "", "2 inches = 1 mile", "0.18",
    "1 in. = 24,000 feet", "1/4 inch = 1 foot", "1\" = 3200'", "1 inch = 2.500 miles", "1 inch = 20 miles", "1:24,00",
]
DENOMINATORS = [24000, 24000, 24000, 24000, 100000, 62500, 2950000, 2400, 24000, 24000, None, None, None, 31680, None, 24000, 48, 38400, 158400, 1267200, None]


@Q("fn1_scale_denominator", _sql(DENOMINATORS).replace(" end as v", " end::bigint as v"))
def fn1(spark, d):
    return _case(spark, d, SCALES).select("p_partkey", fx.scale_denominator(F.col("t")).alias("v"))


@Q("fn2_scale_tier", _sql([None if n is None else "24k" if n <= 62500 else "250k" if n <= 350000 else "500k" for n in DENOMINATORS]))
def fn2(spark, d):
    return _case(spark, d, SCALES).select("p_partkey", fx.scale_tier(fx.scale_denominator(F.col("t"))).alias("v"))


BUCKETS = "case when v is null then 'other' when v < 24000 then 'lt24k' when v = 24000 then '24k' when v = 62500 then '62k' when v = 100000 then '100k' when v < 100000 then 'mid' when v < 250000 then '100k-250k' else '250k' end"


@Q("fn2_scale_bucket", f"select p_partkey, {BUCKETS} as v from (select p_partkey, case p_partkey % 6 when 0 then 24000 when 1 then 62500 when 2 then 100000 when 3 then null else p_size * 9000 end as v from part) t")
def fn2_bucket(spark, d):
    k = F.col("p_partkey") % 6
    n = F.when(k == 0, 24_000).when(k == 1, 62_500).when(k == 2, 100_000).when(k == 3, F.lit(None)).otherwise(F.col("p_size") * 9000)
    return table(spark, d, "part").select("p_partkey", fx.scale_bucket(n).alias("v"))


@Q("fn3_mosaic_tier", "select o_custkey, case when min(o_orderstatus) = max(o_orderstatus) and min(o_orderstatus) in ('F', 'O') then case min(o_orderstatus) when 'F' then '24k' else '100k' end when count(distinct case when o_orderstatus in ('F', 'O') then o_orderstatus end) = 1 then case min(case when o_orderstatus in ('F', 'O') then o_orderstatus end) when 'F' then '24k' else '100k' end end as v from orders group by 1")
def fn3(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s")).select("o_custkey", fx.single_tier(F.col("s"), {"F": "24k", "O": "100k"}).alias("v"))


@Q("fn4_series_code", "select p_partkey, upper(regexp_extract(p_brand, '^([A-Za-z]+)', 1)) as v from part")
def fn4(spark, d):
    return table(spark, d, "part").select("p_partkey", fx.series_code(F.col("p_brand")).alias("v"))


@Q("fn5_keywords_split", _sql(["a, b|c", "x", ""]))
def fn5(spark, d):
    t = _case(spark, d, ["a, b; c;a, b;", " x \n x", ";"])
    return t.select("p_partkey", F.array_join(fx.keywords(F.col("t")), "|").alias("v"))


TITLES = [
    "Aeromagnetic survey of a basin", "A Landslide map and its ground water", "Uranium and Coal", "Trilobites and their tracks", "Lake Bonneville shorelines", "Groundwater of the valley", "Karst and sinkholes", "For teachers: the rock cycle", "A state park",
    "Pioneer heritage", "Surficial units", "Bedrock of the quadrangle", "Plain title", None, "More than an orchard", "Stonework of the core",
]
TOPIC_CASE = "case " + " ".join(f"when regexp_matches(lower(x), '{p}') then '{n}'" for n, p in TOPICS) + " else 'other' end"


@Q("fn6_topic_classify", f"select p_partkey, {TOPIC_CASE} as v from (select p_partkey, coalesce({_pick(TITLES)}, '') || ' ' || p_type as x from part) t")
def fn6(spark, d):
    return _case(spark, d, TITLES).join(table(spark, d, "part").select("p_partkey", "p_type"), "p_partkey").select("p_partkey", fx.topic(F.col("t"), F.col("p_type")).alias("v"))


MEDIA_CASE = "case lower(regexp_extract(t, '[.]([A-Za-z0-9]+)([?#].*)?$', 1)) " + " ".join(f"when '{k}' then '{v}'" for k, v in MEDIA.items()) + " else '-' end"
HREFS = ["http://own.org/a.PDF", "/x/b.tif?v=1", "undefined", "http://other.org/c.csv", "https://own.org/d.xlsx#s", "e.kmz", " ", "f.unknown"]


@Q("fn7_media_type", f"""select p_partkey, coalesce({MEDIA_CASE}, '-') || ' ' || coalesce(case when trim(t) in ('', 'undefined') then null when starts_with(t, 'http://own.org/') then 'https://' || t[8:] when regexp_matches(t, '^[a-z]+://') then t else 'https://base.org/' || ltrim(t, '/') end, '-') as v
    from (select p_partkey, {_pick(HREFS)} as t from part) x""")
def fn7(spark, d):
    t = _case(spark, d, HREFS)
    return t.select("p_partkey", F.concat(F.coalesce(fx.media_type(F.col("t")), F.lit("-")), F.lit(" "), F.coalesce(fx.href(F.col("t"), "https://base.org/", ["own.org"]), F.lit("-"))).alias("v"))


@Q("fn8_titles", "with t as (select p_partkey, case p_partkey % 3 when 0 then 'Fault Lines' when 1 then 'Map Units' else 'Wells' end as title, p_brand from part) select p_partkey, case when count(*) over (partition by lower(title)) > 1 then title || ' (' || p_brand || ')' else title end as v from t")
def fn8(spark, d):
    t = _case(spark, d, ["fault_lines", "mapUnits", "wells"]).withColumn("title", fx.prettified(F.col("t")))
    # Counted by title first, so that a common one is pre-aggregated.
    again = t.groupBy(F.lower("title").alias("low")).agg((F.count(F.lit(1)) > 1).alias("again"))
    return t.join(again, F.lower("title") == F.col("low")).select("p_partkey", F.when(F.col("again"), F.concat("title", F.lit(" ("), "p_brand", F.lit(")"))).otherwise(F.col("title")).alias("v"))


@Q("fn9_slug", "select p_partkey, trim(regexp_replace(lower(p_name || ' -- ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') as v from part")
def fn9(spark, d):
    return table(spark, d, "part").select("p_partkey", fx.slug(F.concat("p_name", F.lit(" -- "), "p_brand")).alias("v"))


#: Authors of parts: lists in either order of names, firms, suffixes and prose, told from a part's key, brand and size.
CREDIT = "case k when 0 then n || ', Eve ' || l || ', and Di Ng' when 1 then n || ', Jr; Eve ' || l when 2 then l || ', A.B., Ng, C.' when 3 then 'compiled by ' || n when 4 then 'Acme Maps, Inc.; ' || n else l || ', Eve' end"


def _credits(spark, d):
    first = lambda c, *v: F.element_at(F.array(*map(F.lit, v)), (c + 1).cast("int"))
    p = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 6).alias("k"), F.concat(first(F.col("p_partkey") % 3, "Ann", "Bo", "Cy"), F.lit(" Day")).alias("n"), first(F.col("p_size") % 2, "Ewe", "Fox").alias("l"))
    return p.withColumn("t", F.expr(CREDIT))


@Q("fn10_author_split", """with p as (select p_partkey, p_partkey % 6 as k, ['Ann', 'Bo', 'Cy'][p_partkey % 3 + 1] || ' Day' as n, ['Ewe', 'Fox'][p_size % 2 + 1] as l from part)
select p_partkey, case k when 0 then n || '|Eve ' || l || '|Di Ng' when 1 then n || ' Jr|Eve ' || l when 2 then l || ', A.B.|Ng, C.' when 3 then 'compiled by ' || n when 4 then 'Acme Maps, Inc.|' || n else l || ', Eve' end as names, k = 3 as ambiguous,
    case k when 0 then n when 1 then 'Day et al.' when 2 then l when 3 then 'Day' when 4 then 'Acme Maps et al.' else l end as short from p""")
def fn10(spark, d):
    """Names of a citation, and the short form of the first, which reads lists at semicolons only."""
    t = _credits(spark, d).withColumn("a", people.cited_authors(F.col("t")))
    return t.select("p_partkey", F.array_join("a.names", "|").alias("names"), "a.ambiguous", people.short_author(F.col("t")).alias("short"))


@Q("fn11_doi_of", "select p_partkey, lower('10.1/' || p_brand) as v from part where p_partkey % 3 <> 0 and p_partkey % 2 = 0")
def fn11(spark, d):
    p = table(spark, d, "part")
    key = F.when(p.p_partkey % 3 == 0, F.concat("p_brand", F.lit(" x"))).otherwise(F.col("p_brand"))
    registry = p.filter("p_partkey % 2 = 0").select("p_partkey")
    return p.select("p_partkey", fx.doi("10.1", key).alias("v")).filter("v is not null").join(registry, "p_partkey", "left_semi")


@Q("fn12_year_key", _sql([1999, None, None, 2004]).replace(" end as v", " end::int as v"))
def fn12(spark, d):
    return _case(spark, d, ["1999", "99", "c1999", " 2004 "]).select("p_partkey", fx.year_key(F.col("t")).alias("v"))


@Q("fn12_pub_interval", "with t as (select o_orderkey, o_orderdate, case when o_orderkey % 3 <> 0 then strftime(o_orderdate, '%Y') end as y from orders) select o_orderkey, coalesce(y || '-01-01', '1886-01-01') as first, coalesce(y || '-12-31', strftime(o_orderdate, '%Y-%m-%d')) as last, y is null as undated from t")
def fn12_interval(spark, d):
    """Two thirds of the orders have a year; the day of the order stands for now."""
    o = table(spark, d, "orders").withColumn("y", F.when(F.col("o_orderkey") % 3 != 0, F.date_format("o_orderdate", "yyyy")).otherwise("n.d."))
    i = o.select("o_orderkey", fx.pub_interval(F.col("y"), F.col("o_orderdate")).alias("i"))
    return i.select("o_orderkey", F.col("i.start").cast("string").alias("first"), F.col("i.end").cast("string").alias("last"), "i.undated")


@Q("fn13_fmt_date", "select o_orderkey, case when o_orderkey % 4 = 0 then strftime(o_orderdate, '%Y') when o_orderkey % 4 = 1 then strftime(o_orderdate, '%b %Y') when strftime(o_orderdate, '%m-%d') = '01-01' then strftime(o_orderdate, '%Y') when strftime(o_orderdate, '%d') = '01' then strftime(o_orderdate, '%b %Y') else strftime(o_orderdate, '%Y-%m-%d') end as v from orders where not (o_orderkey % 4 = 1 and month(o_orderdate) = 1) and o_orderkey % 9 <> 0 union all select o_orderkey, strftime(o_orderdate, '%Y') from orders where o_orderkey % 4 = 1 and month(o_orderdate) = 1 and o_orderkey % 9 <> 0 union all select o_orderkey, null from orders where o_orderkey % 9 = 0")
def fn13(spark, d):
    """Days of orders, of a fourth of them the year only and of another its month, whose first day stands for it; every ninth has no date."""
    turn, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    raw = F.when(F.col("o_orderkey") % 9 == 0, "soon").when(turn == 0, F.date_format(day, "yyyy")).when(turn == 1, F.date_format(day, "yyyy-MM-01'T'00:00:00'Z'")).otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, d, "orders").select("o_orderkey", fx.shown_date(raw).alias("v"))


#: The lines of an order as a page of contents: a title by the quantity, which repeats, and a page by the part; some are noise, too far on or on the cover.
LINES = """select l_orderkey as k, l_linenumber as n, case when l_partkey % 13 = 0 then 'Director ' else 'Quantity ' end || l_quantity::int as title, case when l_partkey % 11 <> 0 then l_partkey % 70 end as page from lineitem"""
FOUND = f"""with l as (select *, ' ' || title || ' . .. ' || coalesce(page::varchar, 'Back cover') as t from ({LINES}) x), u as (select *, row_number() over (partition by k, lower(title) order by n, t) as r from l where title not like 'Director%' and (page is null or page <= 60)),
e as (select * from u where r = 1 and k in (select k from u where r = 1 group by 1 having count(*) >= 3))"""


def _issues(spark, d):
    title = F.concat(F.when(F.col("l_partkey") % 13 == 0, "Director ").otherwise("Quantity "), F.col("l_quantity").cast("int"))
    page = F.when(F.col("l_partkey") % 11 != 0, (F.col("l_partkey") % 70).cast("string")).otherwise("Back cover")
    line = F.struct("l_linenumber", F.concat(F.lit(" "), title, F.lit(" . .. "), page).alias("t"))
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list(line)).alias("lines"))  # the lines of an order
    return lines.select("k", F.array(F.lit("Contents"), F.array_join("lines.t", "\n")).alias("pages"))


@Q("fn14_toc_parse", FOUND + " select k, n_place::int as place, title, page::int as page from (select *, row_number() over (partition by k order by n, t) - 1 as n_place from e) z")
def fn14(spark, d):
    return _issues(spark, d).select("k", F.posexplode(contents.toc(F.col("pages"))).alias("place", "e")).select("k", "place", "e.*")


@Q("fn15_article_slices", FOUND + " select k, title, page::int as first_page, case when lead(page) over w - 1 >= page then lead(page) over w - 1 end::int as last_page from e where page is not null window w as (partition by k order by page, n, t)")
def fn15(spark, d):
    """The pages of each article of the contents: up to the next one's, or open."""
    return _issues(spark, d).select("k", F.explode(contents.ranges(contents.toc(F.col("pages")))).alias("e")).select("k", "e.title", F.col("e.page").alias("first_page"), F.col("e.last").alias("last_page"))


ITEMS = f"select p_partkey, {_pick(['hazards', 'emp', 'mapping', 'wetlands', 'groundwater', None, 'other'])} as schema, {_pick(['rasters', 'geologic-maps', 'publications', 'mining-district-files', 'external', 'x'], 'p_size')} as root, case when p_partkey % 11 = 0 then 'OFR' end as series, {_pick(['cog', 'parquet', 'pdf', 'zarr', 'raster-tiles', 'text', 'odd'])} as a, {_pick(['pdf', 'tiles', 'cog'], 'p_size')} as b from part"
PUBLICATION = "(root in ('publications', 'external') or series is not null)"


@Q("fn16_categorize", f"""select p_partkey, case when schema = 'hazards' then 'hazards' when schema = 'emp' then 'energy-minerals' when schema = 'mapping' or root = 'geologic-maps' then 'geologic-maps' when schema = 'wetlands' then 'wetlands' when schema = 'groundwater' then 'groundwater'
    when root = 'rasters' then 'rasters' when root = 'mining-district-files' then 'mining-district-files' when {PUBLICATION} then 'publications' else 'other' end as category,
    case when {PUBLICATION} then 'publication' when list_has_any([a, b], ['cog', 'raster-tiles']) then 'raster' when schema is not null or list_has_any([a, b], ['tiles', 'parquet', 'zarr']) then 'vector' else 'other' end as kind,
    array_to_string(list_filter(case when a = b then [map {{'cog': 'COG', 'pdf': 'PDF'}}[a]] else [map {{'cog': 'COG', 'parquet': 'GeoParquet', 'pdf': 'PDF', 'zarr': 'Datacube', 'text': 'Text'}}[a], map {{'cog': 'COG', 'pdf': 'PDF', 'tiles': 'Web map'}}[b]] end, lambda x: x is not null and x <> ''), ',') as formats from ({ITEMS}) i""")
def fn16(spark, d):
    """The category, the kind and the formats of items of all schemas and roots."""
    i = sql(spark, d, ITEMS, "part").withColumn("assets", F.array("a", "b"))
    publication = catalogue.is_publication(F.col("root"), F.lit(None).cast("string"), F.col("series"))
    return i.select("p_partkey", catalogue.category(F.col("schema"), F.col("root"), publication).alias("category"), catalogue.item_kind(publication, F.col("schema"), F.col("assets")).alias("kind"), F.array_join(catalogue.formats_of(F.col("assets")), ",").alias("formats"))


@Q("fn17_geometry_kind", "select p_partkey, case p_partkey % 4 when 0 then 'points' when 1 then 'polygons' when 2 then 'mixed' end as v from part")
def fn17(spark, d):
    kinds = F.split(F.col("t"), ",")
    t = _case(spark, d, ["Point,MultiPoint", "Polygon", "Point,LineString", None])
    return t.select("p_partkey", fx.geometry_kind(kinds).alias("v"))


@Q("fn18_mention_tokens", _sql(["ann|bo.day", ""]))
def fn18(spark, d):
    return _case(spark, d, ["@Ann and @bo.day, @ann!", "mail a@b.org"]).select("p_partkey", F.array_join(mentions(F.col("t")), "|").alias("v"))


@Q("fn19_metadata_precedence", "select p_partkey, case when p_partkey % 2 = 0 then p_brand when p_partkey % 3 = 0 then p_type else p_name end as v from part")
def fn19(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", fx.precedence(F.when(k % 2 == 0, F.col("p_brand")).otherwise(" "), F.when(k % 3 == 0, F.col("p_type")), F.col("p_name")).alias("v"))


@Q("fn20_file_field_carry", "select p_partkey, case when p_partkey % 4 = 0 then p_size else p_size + 1000 end as size from part")
def fn20(spark, d):
    p = table(spark, d, "part")
    now = p.filter("p_partkey % 4 = 0").select("p_partkey", F.col("p_size").alias("now"))
    return p.join(now, "p_partkey", "left").select("p_partkey", F.coalesce("now", F.col("p_size") + 1000).alias("size"))


@Q("fn21_input_digest", "select p_brand, sha256(count(*) || ':' || sum(('0x' || md5(p_partkey || ':' || p_size)[1:12])::bigint) || ':' || sum(('0x' || md5(p_partkey || ':' || p_size)[13:24])::bigint)) as digest from part group by 1")
def fn21(spark, d):
    from stratalake.operators.aggregates import digest_of

    return table(spark, d, "part").groupBy("p_brand").agg(digest_of(F.concat("p_partkey", F.lit(":"), "p_size")).alias("digest"))


@Q("fn22_colour_to_hex", "select p_partkey, case p_partkey % 3 when 0 then '#' || lpad(lower(hex(p_size)), 2, '0') || 'ff00' when 1 then '#808080' else '#ff8000' end as v from part")
def fn22(spark, d):
    p = table(spark, d, "part")
    space = F.when(p.p_partkey % 3 == 0, "RGB").when(p.p_partkey % 3 == 1, "GREY").otherwise("CMYK")
    values = F.when(p.p_partkey % 3 == 0, F.array(p.p_size.cast("double"), F.lit(255.0), F.lit(0.0))).when(p.p_partkey % 3 == 1, F.array(F.lit(50.2))).otherwise(F.array(F.lit(0.0), F.lit(49.8), F.lit(100.0), F.lit(0.0)))
    return p.select("p_partkey", fx.hex_colour(space, F.transform(values, lambda x: x)).alias("v"))


@Q("fn23_raster_record_map", "select p_partkey, case when lower(p_type) in ('economy', 'promo') then lower(p_type) else 'other' end as kind, case when lower(p_type) not in ('economy', 'promo') then p_type end as original, 26912 as epsg from part")
def fn23(spark, d):
    kind, original = fx.enum_or_other(F.col("p_type"), ["economy", "promo"])
    return table(spark, d, "part").select("p_partkey", kind.alias("kind"), original.alias("original"), F.regexp_extract(F.lit("EPSG:26912"), "([0-9]+)$", 1).cast("int").alias("epsg"))


@Q("fn24_latlon_parse", _sql([39.5, 39.5, -111.875, None, -39.25]))
def fn24(spark, d):
    return _case(spark, d, ["39.5", "39 30 0 N", "111 52.5 W", "abc", "-39 15"]).select("p_partkey", F.round(fx.degrees_of(F.col("t")), 6).alias("v"))


PAIRS = ["39.5, -111.5", "39.5 111.5", "111.5 39.5", "39 30 0 N 111 30 0 W", "W 111 30, N 39 30", "39°30'N, 111°30'W", "39 30 111 30", "39.5", "39.5, 10", "north of here", None, "39 75 N 111 W", "-111.5, 39.5"]


@Q("fn24_latlon_pairs", _sql(["39.5/-111.5"] * 7 + [None] * 5 + ["39.5/-111.5"]))
def fn24_pairs(spark, d):
    t = _case(spark, d, PAIRS).withColumn("p", fx.latlon(F.col("t"), (-114.6, 36.5, -108.5, 42.5)))
    return t.select("p_partkey", F.concat(F.round("p.lat", 5), F.lit("/"), F.round("p.lon", 5)).alias("v"))


@Q("fn25_township_parse", _sql(["T3S R2E/12", "T10N R1W/0", "-", "-", "T3S R2E/12", "T1N R2W/36", "-"]))
def fn25(spark, d):
    t = _case(spark, d, ["T3S R2E sec 12", "t10n, r1w", "T3S R2E sec 40", "nowhere", "Sec. 12, T3S, R2E", "T. 01 N. R. 2 W. S36", "T3S R2E and more"]).withColumn("v", fx.township(F.col("t")))
    return t.select("p_partkey", F.coalesce(F.concat("v.label", F.lit("/"), F.coalesce("v.section", F.lit(0))), F.lit("-")).alias("v"))
