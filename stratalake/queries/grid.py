"""Queries over grids, tiles and cubes."""

from pyspark.sql import functions as F

from stratalake.operators import grid
from stratalake.queries.base import BOXES, POINTS, Register, boxes, points, table

Q = Register()
P, B = f"({POINTS}) p", f"({BOXES}) b"
CELL = "lpad(floor(y)::int::varchar, 2, '0') || lpad(floor(-x)::int::varchar, 3, '0') || substr('abcdefgh', (floor((y - floor(y)) / 0.125e0) + 1)::int, 1) || (floor((-x - floor(-x)) / 0.125e0) + 1)::int"


@Q("gr1_tile_index", f"""with z as (select id, z::int as z, floor((xmin + 180) / 360 * 2 ** z)::bigint as x0, floor((xmax + 180) / 360 * 2 ** z)::bigint as x1,
    floor((1 - ln(tan(radians(ymax)) + 1 / cos(radians(ymax))) / pi()) / 2 * 2 ** z)::bigint as y0, floor((1 - ln(tan(radians(ymin)) + 1 / cos(radians(ymin))) / pi()) / 2 * 2 ** z)::bigint as y1 from {B}, unnest(range(6, 11)) t(z))
select z, tx, ty, count(*) as n from (select z, unnest(range(x0, x1 + 1)) as tx, y0, y1 from z) a, lateral (select unnest(range(y0, y1 + 1)) as ty) c group by 1, 2, 3""")
def gr1(spark, d):
    return grid.tile_index(boxes(spark, d), 6, 10).groupBy("z", "tx", "ty").agg(F.count(F.lit(1)).alias("n"))


@Q("gr2_grid_cell", f"select id, {CELL} as code, true as inside from {P}")
def gr2(spark, d):
    p = points(spark, d).withColumn("code", grid.cell_code(F.col("x"), F.col("y"))).withColumn("b", grid.cell_bounds(F.col("code")))
    inside = (F.col("x") >= F.col("b.xmin")) & (F.col("x") <= F.col("b.xmax")) & (F.col("y") >= F.col("b.ymin")) & (F.col("y") <= F.col("b.ymax"))
    return p.select("id", "code", inside.alias("inside"))


@Q("gr3_cells_in_region", f"""with c as (select -114 + i * 0.125e0 as x, 37 + j * 0.125e0 as y from range(40) a(i), range(40) b(j)) select c.x, c.y, count(p.id) as n from c left join {P} on p.x >= c.x and p.x < c.x + 0.125 and p.y >= c.y and p.y < c.y + 0.125
    where not (c.x >= -111 and c.y >= 41) group by 1, 2""")
def gr3(spark, d):
    p = points(spark, d)
    cells = grid.region_cells(p, (-114.0, 37.0, -109.0, 42.0), (-111.0, 41.0, -109.0, 42.0))
    held = p.select((F.floor(F.col("x") / grid.STEP) * grid.STEP).alias("x"), (F.floor(F.col("y") / grid.STEP) * grid.STEP).alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(held, ["x", "y"], "left").select("x", "y", F.coalesce("n", F.lit(0)).alias("n"))


@Q("gr4_cells_in_bbox", f"select id, ((floor(xmax / 0.125e0) - floor(xmin / 0.125e0) + 1) * (floor(ymax / 0.125e0) - floor(ymin / 0.125e0) + 1))::bigint as n from {B}")
def gr4(spark, d):
    return grid.cells_of(boxes(spark, d)).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@Q("gr5_gazetteer_validate", f"select id, greatest(abs(xmin - round(xmin / 0.125e0) * 0.125e0), abs(ymin - round(ymin / 0.125e0) * 0.125e0)) > 0.005 as off_grid from {B}")
def gr5(spark, d):
    near = lambda c: F.abs(F.col(c) - F.round(F.col(c) / grid.STEP) * grid.STEP)
    return boxes(spark, d).select("id", (F.greatest(near("xmin"), near("ymin")) > 0.005).alias("off_grid"))


@Q("gr6_byte_range_plan", "with g as (select doc_id, sum(n_chars) over (order by doc_id) - n_chars as start, n_chars as size from documents) select count(distinct b)::bigint as blocks, (count(distinct b) * 4096)::bigint as bytes from (select unnest(range((start // 4096)::bigint, ((start + size - 1) // 4096 + 1)::bigint)) as b from g where doc_id % 5 = 0 and size > 0) t")
def gr6(spark, d):
    """Byte spans of documents laid end to end; the offsets come from a running total of ranges of ids."""
    from stratalake.operators.ordering import numbered

    t = numbered(table(spark, d, "documents").select("doc_id", "n_chars"), ["doc_id"], "row")
    # As many parts as rows of a part: neither of the two running totals has more rows than the root of all.
    t = t.withColumn("part", F.floor(F.col("row") / max(1, int(t.count() ** 0.5))))
    from pyspark.sql import Window

    sums = t.groupBy("part").agg(F.sum("n_chars").alias("s"))
    before = sums.select("part", F.coalesce(F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    here = F.sum("n_chars").over(Window.partitionBy("part").orderBy("row")) - F.col("n_chars")
    spans = t.withColumn("here", here).join(before, "part").withColumn("start", F.col("before") + F.col("here")).filter("doc_id % 5 = 0 and n_chars > 0")
    blocks = spans.select(F.explode(F.expr("sequence(start div 4096, (start + n_chars - 1) div 4096)")).alias("b")).distinct()
    return blocks.agg(F.count(F.lit(1)).alias("blocks")).withColumn("bytes", F.col("blocks") * 4096)


@Q("gr7_cube_steps", "select c.o_custkey, count(*) as n, max(s)::date::varchar as last from (select o_custkey, min(o_orderdate)::date as a, max(o_orderdate)::date as b from orders group by 1) c, lateral (select unnest(generate_series(date_trunc('month', a)::timestamp, b::timestamp, interval 1 month)) as s) t group by 1")
def gr7(spark, d):
    c = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    axis = c.withColumn("s", grid.steps(F.trunc("a", "month"), F.col("b"), F.expr("interval 1 month")))
    return axis.select("o_custkey", F.size("s").cast("long").alias("n"), F.element_at("s", -1).cast("string").alias("last"))


@Q("gr7_axis_labels", """with c as (select o_custkey as k, min(o_orderdate)::date as a, max(o_orderdate)::date as b, list(o_orderdate::date order by o_orderdate::date) as d from orders group by 1),
s as (select k, case k % 5 when 0 then list_transform(d, lambda x: case when len(list_filter(d, lambda y: day(y) <> 1)) > 0 then strftime(x, '%b %-d, %Y') when len(list_filter(d, lambda y: month(y) <> 1)) > 0 then strftime(x, '%b %Y') else strftime(x, '%Y') end)
    when 1 then list_transform(generate_series(date_trunc('month', a)::timestamp, b::timestamp, interval 2 month), lambda x: strftime(x, '%b %Y'))
    when 2 then list_transform(generate_series(date_trunc('year', a)::timestamp, b::timestamp, interval 1 year), lambda x: strftime(x, '%Y'))
    when 3 then list_transform(generate_series(1::bigint, 1 + k % 12, 1), lambda x: strftime(make_date(2000, x, 1), '%b')) else ['a', 'b'] end as l from c)
select k, len(l)::int as n, l[1] as first, l[-1] as last from s""")
def gr7_labels(spark, d):
    """Axes of customers: listed dates, steps of two months and of a year, numbered months, and other values."""
    c = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"), F.array_sort(F.collect_list(F.col("o_orderdate").cast("date").cast("string"))).alias("d"))
    kind = F.col("k") % 5
    text = lambda *by: F.coalesce(*[F.when(kind == i, v.cast("string")) for i, v in by])
    values = F.when(kind == 0, F.col("d")).when(kind == 4, F.array(F.lit("a"), F.lit("b")))
    low = text((1, F.trunc("a", "month")), (2, F.trunc("a", "year")), (3, F.lit(1)))
    labels = grid.axis_labels(values, low, text((1, F.col("b")), (2, F.col("b")), (3, 1 + F.col("k") % 12)), text((1, F.lit("P2M")), (2, F.lit("P1Y")), (3, F.lit(1))), kind == 3)
    return c.select("k", labels.alias("l")).select("k", F.size("l").alias("n"), F.element_at("l", 1).alias("first"), F.element_at("l", -1).alias("last"))


@Q("gr8_cube_selection", "select p_brand as axis, coalesce(max(case when p_size = 7 then p_size end), case when max(p_brand) < 'Brand#3' then arg_max(p_size, p_partkey) else arg_min(p_size, p_partkey) end) as step from part group by 1")
def gr8(spark, d):
    axis = table(spark, d, "part").select(F.col("p_brand").alias("axis"), F.col("p_size").alias("step"), F.col("p_partkey").alias("pos"), (F.col("p_brand") < "Brand#3").alias("dated"))
    return grid.selected_step(axis, axis.select("axis").distinct().withColumn("pick", F.lit(7)))


@Q("gr9_display_stretch", "select round(quantile_cont(value, 0.02), 9) as low, round(quantile_cont(value, 0.8), 9) as high, min(value) as least, max(value) as most from events where not isnan(value) and value <> 0")
def gr9(spark, d):
    q = grid.display_stretch(table(spark, d, "events"), "value", 0.02, 0.8, fill=0.0)
    return q.select(F.round("low", 9).alias("low"), F.round("high", 9).alias("high"), "least", "most")
