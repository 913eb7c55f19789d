"""Queries over orders, pages and top rows."""

from pyspark.sql import functions as F

from stratalake.operators import ordering, pages, results
from stratalake.plans.storage import new_folder
from stratalake.queries.base import BOXES, Register, boxes, sql, table

Q = Register()


@Q("wn2_ordinal_of_row", "select k.ordinal from (select o_orderkey, row_number() over (order by o_totalprice desc nulls last, o_orderkey) - 1 as ordinal from orders) k where o_orderkey = (select min(o_orderkey) + 0 from orders)")
def wn2(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ordering.ordinal(o, [("o_totalprice", False)], "o_orderkey", o.agg(F.min("o_orderkey")).first()[0])


YEARS = "select doc_id, lang, source, n_chars, case doc_id % 7 when 0 then 'n.d.' when 1 then ' ' || (1900 + doc_id % 90) || ' ' when 2 then (1900 + doc_id % 90) || ' (rev 2017)' else (1900 + doc_id % 90)::varchar end as year from documents"
EDITIONS = f"""with d as ({YEARS}), e as (select *, trim(year) as y from d where regexp_matches(trim(year), '^[0-9]{{4}}$')),
u as (select * from (select *, count(*) over (partition by lang, source, y) as c from e) t where c = 1),
g as (select doc_id, y as version, lag(doc_id) over w as predecessor, lead(doc_id) over w as successor,
    nullif(last_value(doc_id) over (w rows between unbounded preceding and unbounded following), doc_id) as latest, lead(doc_id) over w is not null as deprecated from u window w as (partition by lang, source order by y))"""


def _editions(spark, d):
    n = 1900 + F.col("doc_id") % 90
    year = F.when(F.col("doc_id") % 7 == 0, "n.d.").when(F.col("doc_id") % 7 == 1, F.concat(F.lit(" "), n, F.lit(" "))).when(F.col("doc_id") % 7 == 2, F.concat(n, F.lit(" (rev 2017)"))).otherwise(n.cast("string"))
    return table(spark, d, "documents").select("doc_id", "lang", "source", year.alias("year"))


@Q("wn3_edition_graph", EDITIONS + " select * from g")
def wn3(spark, d):
    return ordering.edition_graph(_editions(spark, d), ["lang", "source"], "year", "doc_id").drop("lang", "source", "year")


@Q("wn3_editions_left_out", EDITIONS + " select doc_id, case when regexp_matches(trim(year), '^[0-9]{4}$') then 'year is shared' else 'no year' end as reason from d where doc_id not in (select doc_id from g)")
def wn3_left_out(spark, d):
    return ordering.left_out(_editions(spark, d), ["lang", "source"], "year", "doc_id")


@Q("wn4_draw_order", "select p_partkey, row_number() over (partition by p_brand order by (p_size % 2 = 0), p_size, p_partkey) as rank from part")
def wn4(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", (F.col("p_size") % 2 == 0).alias("even"))
    return ordering.numbered_within(p, ["p_brand"], ["even", "p_size", "p_partkey"], "rank").select("p_partkey", "rank")


@Q("wn5_tier_membership", EDITIONS + " select d.doc_id, case when n_chars < 1000 then '24k' when n_chars < 3000 then '250k' else '500k' end as tier, case when g.doc_id is null then 'not dated' when deprecated then 'superseded' else 'member' end as status from d left join g on g.doc_id = d.doc_id")
def wn5(spark, d):
    """A row a map, with its tier and whether it is a member: what is left out keeps a row that says why."""
    tier = F.when(F.col("n_chars") < 1000, "24k").when(F.col("n_chars") < 3000, "250k").otherwise("500k")
    maps = table(spark, d, "documents").select("doc_id", tier.alias("tier"))
    status = F.when(F.col("deprecated").isNull(), "not dated").when(F.col("deprecated"), "superseded").otherwise("member")
    return maps.join(wn3(spark, d).select("doc_id", "deprecated"), "doc_id", "left").select("doc_id", "tier", status.alias("status"))


@Q("wn6_numbered_keys", "with u as (select url, lower(regexp_extract(url, '^https?://([^/]+)', 1)) as k, min(page_id) as page_id from pages group by 1, 2) select url, case when row_number() over (partition by k order by url) = 1 then k else k || '_' || row_number() over (partition by k order by url) end as key from u")
def wn6(spark, d):
    p = table(spark, d, "pages").withColumn("k", F.lower(F.regexp_extract("url", "^https?://([^/]+)", 1)))
    one = p.groupBy("url", "k").agg(F.min("page_id").alias("page_id"))
    return ordering.numbered_within(one, ["k"], ["url"], "n").select("url", F.when(F.col("n") == 1, F.col("k")).otherwise(F.concat("k", F.lit("_"), "n")).alias("key"))


@Q("wn7_best_per_group", "select vec_id, label from (select vec_id, label, embedding[1] as s, row_number() over (partition by label order by embedding[1], vec_id) as r from embeddings) t where r = 1 order by s, vec_id limit 5")
def wn7(spark, d):
    return ordering.best_per_group(table(spark, d, "embeddings"), "label", F.col("embedding")[0], "vec_id", 5).select("vec_id", "label")


@Q("or2_page_query", "select l_orderkey, l_linenumber, (select count(*) from lineitem where l_quantity < 10) as total from lineitem where l_quantity < 10 order by l_extendedprice desc nulls last, l_orderkey, l_linenumber limit 20 offset 40")
def or2(spark, d):
    t = table(spark, d, "lineitem").filter("l_quantity < 10").withColumn("id", F.struct("l_orderkey", "l_linenumber"))
    total = t.agg(F.count(F.lit(1)).alias("total"))
    return ordering.page(t, F.desc_nulls_last("l_extendedprice"), "id", 20, 40).crossJoin(F.broadcast(total)).select("l_orderkey", "l_linenumber", "total")


BY_PRICE = [("l_extendedprice", False), ("l_orderkey", True), ("l_linenumber", True)]


def _pages(spark, d):
    path = new_folder(spark, "pages")
    pages.write_pages(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), BY_PRICE, path, 5000)
    return path


@Q("or2_deep_page", "select l_orderkey, l_linenumber from lineitem order by l_extendedprice desc nulls last, l_orderkey, l_linenumber limit 30 offset (select count(*) * 5 // 6 from lineitem)")
def or2_deep(spark, d):
    """A page five sixths down a sorted copy, of which one or two blocks are read."""
    path = _pages(spark, d)
    return pages.read_page(spark, path, 30, pages.total(spark, path) * 5 // 6).select("l_orderkey", "l_linenumber")


@Q("wn2_ordinal_from_pages", "select count(*) as ordinal from lineitem l, (select * from lineitem where l_orderkey = (select max(l_orderkey) from lineitem) order by l_linenumber limit 1) m where l.l_extendedprice > m.l_extendedprice or (l.l_extendedprice = m.l_extendedprice and (l.l_orderkey, l.l_linenumber) < (m.l_orderkey, m.l_linenumber))")
def wn2_pages(spark, d):
    """The place of the last order's first line by price, from the directory and one block."""
    lines = table(spark, d, "lineitem")
    row = lines.filter(F.col("l_orderkey") == lines.agg(F.max("l_orderkey")).first()[0]).orderBy("l_linenumber").first().asDict()
    place = pages.place_of(spark, _pages(spark, d), BY_PRICE, row)
    return spark.range(1).select(F.lit(place).cast("long").alias("ordinal"))


#: Orders as results: every fourth has no date of publication, of those every third none of loading; the priority is the title.
RESULTS = "select o_orderkey, o_orderpriority as title, case when o_orderkey % 4 <> 0 then o_orderdate end as published, case when o_orderkey % 3 <> 0 then o_orderdate end as loaded from orders"


def _sorted(spark, d, sort):
    return results.sorted_results(sql(spark, d, RESULTS, "orders"), sort, 50, rank="o_orderkey").select("o_orderkey")


@Q("or3_result_sort", f"select o_orderkey from ({RESULTS}) r order by published desc nulls last, case when published is null then loaded end desc nulls last, o_orderkey limit 50")
def or3(spark, d):
    return _sorted(spark, d, "newest")


@Q("or3_oldest_first", f"select o_orderkey from ({RESULTS}) r order by published asc nulls last, case when published is null then loaded end asc nulls last, o_orderkey limit 50")
def or3_oldest(spark, d):
    return _sorted(spark, d, "oldest")


@Q("or3_by_title", f"select o_orderkey from ({RESULTS}) r order by lower(title) asc nulls last, o_orderkey limit 50")
def or3_title(spark, d):
    return _sorted(spark, d, "title")


OVER = f"""select id, greatest(0, least(xmax, -112.0) - greatest(xmin, -113.5)) * greatest(0, least(ymax, 40.5) - greatest(ymin, 38.0)) as o, (xmax - xmin) * (ymax - ymin) as own
    from ({BOXES}) b where xmin <= -112.0 and xmax >= -113.5 and ymin <= 40.5 and ymax >= 38.0"""


@Q("or4_overlap_rank", f"select id, round(0.25e0 * (o / 3.75e0) + 0.75e0 * case when own > 0 then o / own else 1 end, 9) as score from ({OVER}) t order by score desc, id limit 30")
def or4(spark, d):
    return results.by_overlap(boxes(spark, d), (-113.5, 38.0, -112.0, 40.5), "id", 30).select("id", "score")


@Q("or5_drawable_limit", f"select id, (xmax - xmin) * (ymax - ymin) <= 4 * 0.001e0 as in_area from ({BOXES}) b where (xmax * 20 - xmin * 20) * (ymax * 20 - ymin * 20) <= 4")
def or5(spark, d):
    """Boxes, twenty times as wide and high, that are drawn without an area, and whether they are in one of a thousandth of a square degree at their own size."""
    b = boxes(spark, d)
    key, area = F.col("id"), (0.0, 0.0, 0.04, 0.025)
    wide = b.select(key, (F.col("xmin") * 20).alias("xmin"), (F.col("xmax") * 20).alias("xmax"), (F.col("ymin") * 20).alias("ymin"), (F.col("ymax") * 20).alias("ymax"))
    drawn = results.drawable(b, area).select("id", F.lit(True).alias("in_area"))
    return results.drawable(wide).select("id").join(drawn, "id", "left").select("id", F.coalesce("in_area", F.lit(False)).alias("in_area"))


@Q("or6_most_detailed", "select p_brand, arg_min(p_partkey, (case when p_size % 5 = 0 then 1e308 else p_size end, p_partkey)) as p_partkey from part group by p_brand")
def or6(spark, d):
    p = table(spark, d, "part").select("p_brand", "p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("scale"))
    return results.most_detailed(p, ["p_brand"], "scale", "p_partkey").select("p_brand", "p_partkey")


@Q("or7_shard_assignment")
def or7(spark, d):
    return table(spark, d, "orders").select("o_orderkey", ordering.shard(F.col("o_orderkey"), 16).alias("shard"))


@Q("or8_work_order", "with a as (select user_id, count(*) as tries, bool_or(event_type = 'purchase') as settled from events where event_id % 3 = 0 group by 1), u as (select distinct user_id from events) select u.user_id, coalesce(tries, 0) as tries, (coalesce(tries, 0) = 0) as first_time from u left join a on u.user_id = a.user_id where not coalesce(settled, false)")
def or8(spark, d):
    e = table(spark, d, "events")
    log = e.filter("event_id % 3 = 0").select("user_id", (F.col("event_type") == "purchase").alias("settled"))
    return ordering.work_order(e.select("user_id").distinct(), log, "user_id").withColumn("first_time", F.col("tries") == 0).orderBy("tries", "user_id")
