"""Queries over points and boxes."""

from pyspark.sql import functions as F

from stratalake.operators import dissolve, geo, spatial
from stratalake.operators.ordering import numbered
from stratalake.plans.storage import new_folder
from stratalake.queries.base import BOXES, POINTS, Register, boxes, points, sql
from stratalake.sources import archive

Q = Register()
P, B = f"({POINTS}) p", f"({BOXES}) b"
VIEW = (-113.5, 38.0, -112.0, 40.5)
AREAS = [(-113.5, 38.0, -112.5, 39.5), (-113.0, 38.5, -111.0, 40.0), (-112.0, 40.0, -110.0, 42.0)]
MEETS = "xmin <= -112.0 and xmax >= -113.5 and ymin <= 40.5 and ymax >= 38.0"
HILBERT = f"""
with recursive p as (select * from {P}), e as (select min(x) x0, max(x) x1, min(y) y0, max(y) y1 from p),
h(id, s, x, y, d) as (
    select id, 32768::bigint, floor((x - x0) / greatest(x1 - x0, 1e-9) * 65535)::bigint, floor((y - y0) / greatest(y1 - y0, 1e-9) * 65535)::bigint, 0::bigint from p, e
    union all
    select id, s // 2,
        case when (y & s) > 0 then x when (x & s) > 0 then 65535 - y else y end,
        case when (y & s) > 0 then y when (x & s) > 0 then 65535 - x else x end,
        d + s * s * (case when (x & s) > 0 then case when (y & s) > 0 then 2 else 3 end when (y & s) > 0 then 1 else 0 end)
    from h where s > 0),
k as (select id, d from h where s = 0)
"""


@Q("or1_hilbert_key", HILBERT + "select id, d as h from k")
def or1(spark, d):
    return geo.with_hilbert(points(spark, d)).select("id", "h")


@Q("wn1_feature_id", HILBERT + "select id, row_number() over (order by d, id) as feature_id from k")
def wn1(spark, d):
    return numbered(geo.with_hilbert(points(spark, d)).select("id", "h"), ["h", "id"]).select("id", "feature_id")


@Q("pf1_crs_gate", f"select id, case when id % 2 = 0 then x else degrees(x * 10000 / 6378137.0) end as x, case when id % 2 = 0 then y else degrees(2 * atan(exp(y * 10000 / 6378137.0)) - pi() / 2) end as y from {P}")
def pf1(spark, d):
    p = points(spark, d)
    mixed = p.withColumns({"epsg": F.when(p.id % 2 == 0, 4326).otherwise(3857), "x": F.when(p.id % 2 == 0, p.x).otherwise(p.x * 10000), "y": F.when(p.id % 2 == 0, p.y).otherwise(p.y * 10000)})
    return geo.crs_gate(mixed).select("id", "x", "y")


@Q("pf2_reproject_points", f"""
with c as (select id, 0.00669437999014132 as e2, (x + 120) * 50000 as e, y * 110000 as n from {P}),
m as (select id, e, e2, e2 / (1 - e2) as p2, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) as e1, n / 0.9996 / (6378137.0 * (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256)) as mu from c),
f as (select *, mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu) + (151 * e1 ** 3 / 96) * sin(6 * mu) as phi from m),
g as (select *, 6378137.0 / sqrt(1 - e2 * sin(phi) ** 2) as n1, tan(phi) ** 2 as t1, p2 * cos(phi) ** 2 as c1, 6378137.0 * (1 - e2) / (1 - e2 * sin(phi) ** 2) ** 1.5 as r1 from f),
h as (select *, (e - 500000.0) / (n1 * 0.9996) as d from g)
select id, round(degrees((d - (1 + 2 * t1 + c1) * d ** 3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1 ** 2 + 8 * p2 + 24 * t1 ** 2) * d ** 5 / 120) / cos(phi)) - 111, 7) as lon,
    round(degrees(phi - (n1 * tan(phi) / r1) * (d ** 2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 ** 2 - 9 * p2) * d ** 4 / 24)), 7) as lat from h""")
def pf2(spark, d):
    lon, lat = geo.utm_to_lonlat((F.col("x") + 120) * 50000, F.col("y") * 110000, 12)
    return points(spark, d).select("id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@Q("pf3_bbox_columns", f"select id, x as xmin, y as ymin, x as xmax, y as ymax, 1 as vertices from {P}")
def pf3(spark, d):
    p = points(spark, d)
    return p.select("id", geo.envelope(geo.point_wkb(p.x, p.y)).alias("bbox")).select("id", "bbox.*")


@Q("pf4_blank_non_finite", "select count(*) as n, count(*) filter (where vec_id % 5 = 0) as blanked, round(sum(case when vec_id % 5 <> 0 then embedding[1] end)::double, 3) as total from embeddings")
def pf4(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.when(F.col("vec_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("embedding")[0].cast("double")).alias("x"))
    blank = e.withColumn("x", F.when(~F.isnan("x") & (F.abs("x") < F.lit(float("inf"))), F.col("x")))
    return blank.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").isNull()).alias("blanked"), F.round(F.sum("x"), 3).alias("total"))


@Q("pf5_drop_empty_geometry", f"select id from {P} where id % 3 <> 0")
def pf5(spark, d):
    p = points(spark, d).withColumn("x", F.when(F.col("id") % 3 != 0, F.col("x")))
    return p.withColumn("g", geo.envelope(geo.point_wkb(F.col("x"), F.col("y")))).filter("g.xmin is not null").select("id")


@Q("pf6_bbox_clip", f"select id from {B} where {MEETS}")
def pf6(spark, d):
    return boxes(spark, d).filter(geo.overlaps(VIEW)).select("id")


@Q("pf7_multi_area_clip", f"select id from {B} where " + " or ".join(f"(xmin <= {e} and xmax >= {w} and ymin <= {n} and ymax >= {s})" for w, s, e, n in AREAS))
def pf7(spark, d):
    return geo.multi_area(boxes(spark, d), AREAS).select("id")


@Q("pf8_exact_clip", f"""with c as (select id, (xmin + xmax) / 2 as cx, (ymin + ymax) / 2 as cy, greatest((xmax - xmin) / 2, 1e-6) as a, greatest((ymax - ymin) / 2, 1e-6) as b from {B} where {MEETS})
select id from c where greatest(0, -113.5 - cx, cx + 112.0) / a + greatest(0, 38.0 - cy, cy - 40.5) / b <= 1""")
def pf8(spark, d):
    """Diamonds inside the boxes, clipped by their own outline after the box prefilter."""
    cx, cy = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    a, b = F.greatest((F.col("xmax") - F.col("xmin")) / 2, F.lit(1e-6)), F.greatest((F.col("ymax") - F.col("ymin")) / 2, F.lit(1e-6))
    ring = boxes(spark, d).filter(geo.overlaps(VIEW)).select("id", cx.alias("cx"), cy.alias("cy"), a.alias("a"), b.alias("b"), F.array(cx - a, cx, cx + a, cx, cx - a).alias("xs"), F.array(cy, cy + b, cy, cy - b, cy).alias("ys"))
    w, s, e, n = VIEW
    near = ring.filter(spatial.ring_meets(F.col("xs"), F.col("ys"), (w - 1e-9, s - 1e-9, e + 1e-9, n + 1e-9)))
    return near.filter(spatial.diamond_meets(*map(F.col, ("cx", "cy", "a", "b")), VIEW)).select("id")


@Q("pf19_viewport_filter", f"select id from {B} where {MEETS}")
def pf19(spark, d):
    b = boxes(spark, d)
    return b.filter(F.coalesce(geo.valid_bbox(F.array(*map(F.lit, VIEW))).isNull(), F.lit(True)) | geo.overlaps(VIEW)).select("id")


@Q("pf25_valid_bbox", f"select id, case when id % 4 <> 0 and xmax <= 180 then [xmin, ymin, xmax, ymax] end as box from {B}")
def pf25(spark, d):
    b = boxes(spark, d)
    four, six = F.array("xmin", "ymin", "xmax", "ymax"), F.array("xmin", "ymin", F.lit(0.0), "xmax", "ymax", F.lit(9.0))
    raw = F.when(b.id % 4 == 0, F.array("xmin", F.lit(float("nan")), "xmax", "ymax")).when(b.id % 4 == 1, six).otherwise(four)
    return b.select("id", geo.valid_bbox(raw).alias("box"))


@Q("pf27_extent_sanity", f"select floor(min(x) * 1e6) / 1e6 as xmin, floor(min(y) * 1e6) / 1e6 as ymin, ceil(max(x) * 1e6) / 1e6 as xmax, ceil(max(y) * 1e6) / 1e6 as ymax, (floor(min(x) * 1e6) / 1e6 < -113) as outside from {P}")
def pf27(spark, d):
    p = points(spark, d)
    bad = p.limit(1).select("id", "name", "kind", F.lit(float("nan")).alias("x"), F.lit(1.0).alias("y"))
    return geo.outward(p.union(bad), (-113, 30, -100, 50))


@Q("ag2_centroid_extent", f"select min((xmin + xmax) / 2) as xmin, min((ymin + ymax) / 2) as ymin, max((xmin + xmax) / 2) as xmax, max((ymin + ymax) / 2) as ymax from {B}")
def ag2(spark, d):
    return geo.extent(boxes(spark, d).select(((F.col("xmin") + F.col("xmax")) / 2).alias("x"), ((F.col("ymin") + F.col("ymax")) / 2).alias("y")))


@Q("ag3_extent_union", f"select kind, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from {B} group by kind")
def ag3(spark, d):
    return boxes(spark, d).groupBy("kind").agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


SPECKS = f"with s as (select *, floor(xmin / 0.5)::bigint as cx, floor(ymin / 0.5)::bigint as cy from {B} where xmax - xmin < 0.1 and ymax - ymin < 0.1)"


@Q("ag4_speck_thinning", SPECKS.replace("0.1", "0.5") + " select cx, cy, arg_max(id, ((xmax - xmin) * (ymax - ymin), -id)) as id, count(*) as n from s group by cx, cy")
def ag4(spark, d):
    return geo.thinned_specks(boxes(spark, d), 0.5)


@Q("ag5_overview_generalise")
def ag5(spark, d):
    """Polylines of the embeddings' values, and some narrow rings and specks of the same."""
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    scale = F.when(F.col("vec_id") % 5 == 0, 0.001).otherwise(1.0)
    ys = F.transform("embedding", lambda v: v.cast("double") * scale)
    xs = F.transform("embedding", lambda v, i: (i.cast("double") / 10 + F.col("vec_id") % 3) * scale)
    ring = F.col("vec_id") % 4 == 0
    back = lambda c: F.when(ring, F.concat(c, F.slice(c, 1, 1))).otherwise(c)
    return geo.overview(e.select(F.col("vec_id").alias("id"), back(xs).alias("xs"), back(ys).alias("ys")), 0.05).select("id", "n")


@Q("ag6_overview_gate", "select label, sum(len(embedding))::bigint as vertices, not bool_and(vec_id % 3 = 0) and sum(len(embedding)) >= 300 as build from embeddings group by 1")
def ag6(spark, d):
    """A label is a layer; a third of the vectors stand for points."""
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    return geo.overview_gate(e, F.size("embedding"), F.col("vec_id") % 3 == 0, ["label"], 300)


@Q("ag6_overview_levels", """with s as (select label, count(*) as a, count(*) filter (where vec_id % 3 <> 0) as b, count(*) filter (where vec_id % 2 = 0) as c, count(*) filter (where vec_id % 5 = 0) as d from embeddings group by 1),
k as (select *, b < 0.7 * a as kb, case when b < 0.7 * a then b else a end as l1 from s), m as (select *, c < 0.7 * l1 as kc, case when c < 0.7 * l1 then c else l1 end as l2 from k)
select label, kb as level1, kc as level2, d < 0.7 * l2 as level3 from m""")
def ag6_levels(spark, d):
    """Levels of two thirds, a half and a fifth of a layer's rows."""
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    sizes = e.groupBy("label").agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("vec_id") % 3 != 0).alias("b"), F.count_if(F.col("vec_id") % 2 == 0).alias("c"), F.count_if(F.col("vec_id") % 5 == 0).alias("d"))
    kept = sizes.select("label", geo.kept_levels(F.array("a", "b", "c", "d")).alias("k"))
    return kept.select("label", *[F.get("k", F.lit(i)).alias(f"level{i + 1}") for i in range(3)])


@Q("ag7_block_merge", f"select floor(xmin / 0.5)::bigint as bx, floor(ymin / 0.5)::bigint as by, kind, arg_max(id, ((xmax - xmin) * (ymax - ymin), -id)) as id, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax, count(*) as parts from {B} group by 1, 2, 3")
def ag7(spark, d):
    return geo.block_merge(boxes(spark, d), 0.5, "kind")


@Q("ag8_dissolve_extent_by_key", f"select size, min(xmin) as xmin, max(xmax) as xmax, min(ymin) as ymin, max(ymax) as ymax, arg_min(name, id) as first_name from {B} group by size")
def ag8(spark, d):
    return boxes(spark, d).groupBy("size").agg(F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"), F.min_by("name", "id").alias("first_name"))


SQUARES = "select distinct o_orderpriority as key, o_custkey % 50 as x, o_orderkey % 37 as y from orders"


@Q("ag8_dissolve", f"""with c as ({SQUARES}), n as (select c.key, c.x, c.y, r.x is not null as r, u.x is not null as u, r.x is not null and u.x is not null and b.x is not null as b
    from c left join c r on r.key = c.key and r.x = c.x + 1 and r.y = c.y left join c u on u.key = c.key and u.x = c.x and u.y = c.y + 1 left join c b on b.key = c.key and b.x = c.x + 1 and b.y = c.y + 1)
select key, count(*)::double as area, (4 * count(*) - 2 * count(*) filter (where r) - 2 * count(*) filter (where u))::double as length, count(*) - count(*) filter (where r) - count(*) filter (where u) + count(*) filter (where b) as parts_less_holes from n group by key""")
def ag8_dissolve(spark, d):
    """Squares of the orders' priorities, dissolved to parts with holes; SQL counts them by their corners."""
    s = sql(spark, d, SQUARES, "orders").select("key", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    xs, ys = F.array("x", F.col("x") + 1, F.col("x") + 1, "x", "x"), F.array("y", "y", F.col("y") + 1, F.col("y") + 1, "y")
    parts = dissolve.dissolved(s.select("key", xs.alias("xs"), ys.alias("ys")), "key", size=4.0)
    holes = F.size("rings") - 1
    side = lambda r: F.aggregate(F.transform(F.sequence(F.lit(0), F.size(r["xs"]) - 2), lambda i: F.hypot(F.get(r["xs"], i + 1) - F.get(r["xs"], i), F.get(r["ys"], i + 1) - F.get(r["ys"], i))), F.lit(0.0), lambda a, b: a + b)
    length = F.aggregate(F.transform("rings", side), F.lit(0.0), lambda a, b: a + b)
    return parts.groupBy("key").agg(F.round(F.sum("area"), 6).alias("area"), F.round(F.sum(length), 6).alias("length"), F.sum(1 - holes).alias("parts_less_holes"))


ARCHIVE = HILBERT + f", f as (select id, row_number() over (order by d, id) as feature_id from k) select f.feature_id, p.id, p.name, p.x, p.y from f join p on f.id = p.id"


def _archived(spark, d):
    p = geo.crs_gate(points(spark, d).withColumn("epsg", F.lit(4326))).drop("epsg")
    path = new_folder(spark, "archive")
    archive.write_archive(numbered(geo.with_hilbert(p), ["h", "id"]), path, "feature_id")
    return path


@Q("sk1_write_archive", ARCHIVE)
def sk1(spark, d):
    return archive.read_latest(spark, _archived(spark, d)).select("feature_id", "id", "name", "x", "y")


@Q("sc7_feature_query", ARCHIVE + " where p.x between -113.5 and -112.0 and p.y between 38.0 and 40.5")
def sc7(spark, d):
    found = archive.feature_query(archive.read_latest(spark, _archived(spark, d)), VIEW)
    return found.select("feature_id", "id", "name", "x", "y")


@Q("sk2_adaptive_file_rows", "select greatest(128, least(122880, floor(8388608 / avg(strlen(text)))))::bigint as rows_per_file from documents")
def sk2(spark, d):
    return archive.rows_per_file(spark.read.parquet(f"{d}/documents.parquet"), "text")


@Q("sk4_geo_metadata", f"select kind, 'Point' as geometry_types, 'bbox' as covering, min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax from {P} where x is not null group by kind")
def sk4(spark, d):
    """The sidecar of each class's archive, written and read back."""
    p = points(spark, d).withColumn("g", geo.point_wkb(F.col("x"), F.col("y")))
    path = new_folder(spark, "sidecars")
    archive.sidecars(p, "g", ["kind"]).write.partitionBy("kind").text(path)
    read = spark.read.text(path).withColumn("m", F.from_json("value", archive.SIDECAR)).select("kind", F.col("m.columns.geom").alias("g"))
    box = [F.get("g.bbox", F.lit(i)).alias(c) for i, c in enumerate(("xmin", "ymin", "xmax", "ymax"))]
    return read.select("kind", F.array_join("g.geometry_types", ",").alias("geometry_types"), F.get("g.covering.bbox.xmin", F.lit(0)).alias("covering"), *box)


@Q("sk14_dry_run_report", f"select count(*) as n, count(x) as with_geometry, min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax, 'id,name,kind,x,y' as columns from {P}")
def sk14(spark, d):
    p = points(spark, d)
    return p.agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("with_geometry"), F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"), F.lit(",".join(p.columns)).alias("columns"))
