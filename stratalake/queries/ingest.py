"""Queries over sources and sinks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.operators import geo
from stratalake.operators.ordering import numbered
from stratalake.plans.storage import new_folder, written
from stratalake.queries.base import POINTS, Register, points, sql, table
from stratalake.sources import archive, exports, readers
from stratalake.streaming import changes, runs

Q = Register()
P = f"({POINTS}) p"


@Q("sc1_discover_topics", "select 's' || (c_custkey % 3) as schema, 'layer' || c_custkey || '_current' as layer, 'layer' || c_custkey as stem from customer where c_custkey % 2 = 0 and c_custkey % 3 < 2 and c_custkey % 5 <> 0")
def sc1(spark, d):
    c = table(spark, d, "customer")
    name = F.when(c.c_custkey % 5 == 0, F.concat(F.lit("1 bad"), c.c_custkey, F.lit("_current"))).when(c.c_custkey % 2 == 0, F.concat(F.lit("layer"), c.c_custkey, F.lit("_current"))).otherwise(F.concat(F.lit("layer"), c.c_custkey, F.lit("xcurrent")))
    return readers.discover(c.select(F.concat(F.lit("s"), c.c_custkey % 3).alias("schema"), name.alias("name")), "_current", ["s0", "s1"])


@Q("sc2_partitioned_table_scan", "select count(*) as n, sum(o_orderkey)::bigint as keys from orders")
def sc2(spark, d):
    o = table(spark, d, "orders")
    low, high = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return readers.partitioned_scan(lambda p: o.filter(p), "o_orderkey", low, high, 6).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@Q("sc2_ranges_by_bytes", "select count(*) as n, sum(n_chars)::bigint as chars, true as even from documents")
def sc2_bytes(spark, d):
    """Ranges of documents of about equal bytes: the largest has at most 1.5 times the mean, and together they are the table."""
    docs = table(spark, d, "documents")
    parts = readers.byte_ranges(docs, "doc_id", 6, 1)
    sized = docs.withColumn("b", readers.row_bytes(docs))
    each = F.array(*[F.sum(F.when(F.expr(p), F.col("b"))) for p in parts])
    rows = sum((F.count_if(F.expr(p)) for p in parts[1:]), F.count_if(F.expr(parts[0])))
    chars = sum((F.coalesce(F.sum(F.when(F.expr(p), F.col("n_chars"))), F.lit(0)) for p in parts[1:]), F.coalesce(F.sum(F.when(F.expr(parts[0]), F.col("n_chars"))), F.lit(0)))
    return sized.agg(rows.alias("n"), chars.alias("chars"), (F.array_max(each) <= 1.5 * F.sum("b") / len(parts)).alias("even"))


@Q("sc3_typed_registry_read", "select event_id, (props->>'$.k')::bigint as k from events")
def sc3(spark, d):
    return readers.typed_json(table(spark, d, "events"), "props", "k bigint, keywords array<string>", ("keywords",)).select("event_id", "props.k")


@Q("sc4_text_coerced_feed", "select s_suppkey::varchar as s_suppkey, case when s_suppkey % 4 = 0 then '' else s_name end as s_name, s_nationkey || ', 7' as l from supplier")
def sc4(spark, d):
    s = table(spark, d, "supplier")
    return readers.as_text(s.select("s_suppkey", F.when(s.s_suppkey % 4 != 0, s.s_name).alias("s_name"), F.array(s.s_nationkey, F.lit(7)).alias("l")))


@Q("sc5_document_scan", "select s_suppkey, s_name as body from supplier where s_suppkey % 3 <> 0")
def sc5(spark, d):
    """A text file a supplier, named s1.txt and so on; the key comes back from the id."""
    path = new_folder(spark, "bodies")
    s = table(spark, d, "supplier")
    exports.write_sidecars(s.select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.when(s.s_suppkey % 3 == 0, " ").otherwise(s.s_name).alias("body")), "id", "body", path)
    return readers.document_scan(spark, path).select(F.regexp_extract("id", "^S(-?[0-9]+)$", 1).cast("long").alias("s_suppkey"), "body")


@Q("sc6_catalogue_scan", "select c_mktsegment as collection, count(*) as items, sum((c_custkey % 10 = 0)::int)::bigint as unread from customer group by 1")
def sc6(spark, d):
    c = table(spark, d, "customer")
    path = new_folder(spark, "items")
    text = F.when(c.c_custkey % 10 == 0, "{broken").otherwise(F.to_json(F.struct(F.col("c_custkey").alias("id"))))
    c.select(F.col("c_mktsegment").alias("collection"), text.alias("value")).write.partitionBy("collection").text(path)
    good, bad = readers.catalogue_scan(spark, path, "id bigint")
    both = good.select("collection", F.lit(0).alias("bad")).union(bad.select("collection", F.lit(1)))
    return both.groupBy("collection").agg(F.count(F.lit(1)).alias("items"), F.sum("bad").alias("unread"))


@Q("sc8_covering_layout_detect", "select 'geom' as geometry, 'bbox.xmin' as first, 'xmin' as flat, count(*) as n from customer")
def sc8(spark, d):
    p = points(spark, d)
    flat = p.withColumns({"geom": geo.point_wkb(p.x, p.y), "xmin": p.x, "ymin": p.y, "xmax": p.x, "ymax": p.y})
    nested = flat.withColumn("bbox", F.struct("xmin", "ymin", "xmax", "ymax"))
    return p.agg(F.lit(archive.geometry_column(nested)).alias("geometry"), F.lit(archive.covering(nested)[0]).alias("first"), F.lit(archive.covering(flat)[0]).alias("flat"), F.count(F.lit(1)).alias("n"))


def _csv(spark, d):
    path = new_folder(spark, "csv")
    c = table(spark, d, "customer")
    line = F.concat_ws(";", c.c_custkey.cast("string"), F.lpad(c.c_custkey.cast("string"), 8, "0"), c.c_acctbal.cast("string"), c.c_name)
    ragged = F.when(c.c_custkey % 20 == 3, F.concat(line, F.lit(";x;y"))).otherwise(line)
    header = spark.createDataFrame([(-1, "key;code;balance;name")], "k bigint, value string")
    header.union(c.select("c_custkey", ragged.alias("value"))).coalesce(1).sortWithinPartitions("k").select("value").write.text(path)
    return path


@Q("sc9_csv_table_read", "select c_custkey as key, lpad(c_custkey::varchar, 8, '0') as code, c_acctbal as balance, c_name as name from customer where c_custkey % 20 <> 3")
def sc9(spark, d):
    return readers.csv_table(spark, _csv(spark, d))[0]


@Q("sc10_header_row_detect", "select p_brand, (1 + min(p_partkey) % 3)::int as row_no, 'Part|Size|Price' as header from part where p_brand not like '%3' group by 1")
def sc10(spark, d):
    """A sheet a brand: a title, up to two blank rows, the header (some have none), and its parts; the header is looked for in each sheet."""
    p = table(spark, d, "part")
    brands = p.groupBy("p_brand").agg((F.min("p_partkey") % 3).alias("blank"))
    cells = lambda *c: F.array(*c).cast("array<string>")
    blanks = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.when(i < F.col("blank"), cells(F.lit(""), F.lit(" "))))
    names = F.when(F.endswith("p_brand", F.lit("3")), cells(F.lit("1"), F.lit("2"), F.lit("3"))).otherwise(cells(F.lit("Part"), F.lit("Size"), F.lit("Price")))
    top = F.filter(F.concat(F.array(cells(F.concat(F.lit("Parts of "), "p_brand"))), blanks, F.array(names)), lambda x: x.isNotNull())
    head = brands.select("p_brand", F.posexplode(top).alias("row_no", "cells"))
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    first = p.withColumn("i", place).filter(F.col("i") <= readers.HEADER_ROWS)  # rows further down are never looked at
    rest = first.join(brands, "p_brand").select("p_brand", (F.col("blank") + 1 + F.col("i")).cast("int").alias("row_no"), cells("p_partkey", "p_size", "p_retailprice").alias("cells"))
    return readers.header_rows(head.unionByName(rest), "p_brand").select("p_brand", "row_no", F.array_join("cells", "|").alias("header"))


@Q("sc11_paged_api_collect", "select c_custkey as id, c_name as name from customer")
def sc11(spark, d):
    """The customers as a service would give them: a written table that is asked for its rows page by page."""
    rows = numbered(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_custkey"], "n")
    service = written(rows.select((F.col("n") - 1).alias("n"), "c_custkey", "c_name"), "service")
    spark.dataSource.register(readers.PagedSource)
    options = {"total": service.count(), "page": 100, "fetch": "stratalake.queries.ingest:fetch_page", "source": service.inputFiles()[0].rpartition("/")[0]}
    return spark.read.format("paged").options(**options).load()


def fetch_page(source: str, offset: int, limit: int) -> list[tuple[int, str]]:
    """Stands in for a service: it gives at most 60 rows at once, and fails for more than 80."""
    import pyarrow.dataset as ds

    if limit > 80:
        raise OSError("too many rows asked for")
    n = ds.field("n")
    found = ds.dataset(source, format="parquet").to_table(filter=(n >= offset) & (n < offset + min(limit, 60))).sort_by("n")
    return list(zip(found.column("c_custkey").to_pylist(), found.column("c_name").to_pylist()))


@Q("sc12_row_group_extents", f"select count(*) as n, min(x) as xmin, max(y) as ymax from {P}")
def sc12(spark, d):
    path = new_folder(spark, "groups")
    points(spark, d).write.parquet(path)
    return readers.footers(spark, path, ("x", "y", "x", "y")).agg(F.sum("rows").alias("n"), F.min("xmin").alias("xmin"), F.max("ymax").alias("ymax"))


@Q("sk3_archive_type_cast", "select o_orderkey, 'INTERVAL ''' || (o_orderkey % 5) || ' 0' || (o_orderkey % 7) || ':00:00'' DAY TO SECOND' as span, o_orderdate::varchar as made, o_totalprice as price from orders")
def sk3(spark, d):
    """Intervals become text, other types stay."""
    key = F.col("o_orderkey").cast("int")
    o = table(spark, d, "orders").select("o_orderkey", F.make_dt_interval(key % 5, key % 7).alias("span"), F.col("o_orderdate").alias("made"), F.col("o_totalprice").alias("price"))
    cast = archive.castable(o)
    return cast.select("o_orderkey", "span", F.date_format("made", "yyyy-MM-dd HH:mm:ss").alias("made"), "price")


@Q("sk5_archive_is_current", "select count(*) > 0 as has_box, bool_and(true) as has_statistics, true as has_version from customer")
def sk5(spark, d):
    path = new_folder(spark, "current")
    folder = archive.write_archive(points(spark, d), path, "id")
    found = archive.read_latest(spark, path)
    stats = readers.footers(spark, folder, ("xmin", "ymin", "xmax", "ymax"))
    version = archive.read_sidecar(spark, path).first()["version"]
    return stats.agg(F.lit(archive.covering(found)[0] == "bbox.xmin").alias("has_box"), F.bool_and(F.col("xmin").isNotNull() & F.col("ymax").isNotNull()).alias("has_statistics"), F.lit(version == "1.1.0").alias("has_version"))


@Q("sk6_geojson_small_export", f"select count(*) as n, sum(105 + strlen(id::varchar || name || kind || x::varchar || y::varchar)) <= 1000000 as small from {P}")
def sk6(spark, d):
    p = points(spark, d)
    text = p.select(exports.feature(p, "id").alias("value"))
    return text.agg(F.count(F.lit(1)).alias("n"), (F.sum(F.octet_length("value")) <= exports.GEOJSON_BYTES).alias("small"))


@Q("sk7_feature_seq_export", f"select id, name, x from {P}")
def sk7(spark, d):
    path = new_folder(spark, "features")
    exports.write_features(points(spark, d), "id", path)
    f = spark.read.schema("id bigint, geometry struct<coordinates: array<double>>, properties struct<name: string>").json(path)
    return f.select("id", F.col("properties.name").alias("name"), F.col("geometry.coordinates")[0].alias("x"))


@Q("sk8_csv_export_clipped", f"select id, name, kind from {P} where x between -113.5 and -112.0 and y between 38.0 and 40.5")
def sk8(spark, d):
    path = new_folder(spark, "clipped")
    exports.clipped_csv(points(spark, d), path, geo.within((-113.5, 38.0, -112.0, 40.5)))
    return spark.read.schema("id bigint, name string, kind string, geom string").csv(path, header=True, enforceSchema=True).select("id", "name", "kind")


@Q("sk11_related_table_export", "select * from nation where n_regionkey in (select r_regionkey from region)")
def sk11(spark, d):
    related = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return written(related, "related")


@Q("sk12_item_mirror", f"select id, kind as collection from {P} where id % 3 <> 0")
def sk12(spark, d):
    path = new_folder(spark, "mirror")
    items = points(spark, d).withColumn("geometry", F.when(F.col("id") % 3 != 0, F.array("x", "y")))
    items.filter("geometry is not null").withColumnRenamed("kind", "collection").write.partitionBy("collection").parquet(path)
    return spark.read.parquet(path).select("id", "collection")


CHANGES = "select event_id, case when event_id % 10 = 0 then 'elsewhere' else 'geo' end as schema, case when event_id % 7 = 0 then 'Bad Name' else 'topic_' || (user_id % 20) end as topic, ts as at from events"


@Q("sm1_change_event_stream", f"select distinct case when schema <> 'geo' then schema else topic end as name, case when schema <> 'geo' then 'unknown schema' when topic = 'Bad Name' then 'bad topic' else 'ingested' end as outcome from ({CHANGES}) c")
def sm1(spark, d):
    """Each good topic, ingested, and what was skipped with its reason: the schema that isn't known, or the topic's name."""
    path, out, state = (new_folder(spark, n) for n in ("events", "ingested", "state"))
    rows = sql(spark, d, CHANGES, "events")
    rows.select(F.to_json(F.struct("schema", "topic", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))).alias("value")).write.text(path)
    append = lambda df: df.write.mode("append").parquet(out)
    good = lambda batch, _: append(batch.select(F.col("topic").alias("name"), F.lit("ingested").alias("outcome")))
    bad = lambda batch, _: append(batch.select(F.when(F.col("reason") == "unknown schema", F.col("schema")).otherwise(F.col("topic")).alias("name"), F.col("reason").alias("outcome")))
    changes.run_changes(changes.change_stream(spark, path, ["geo"], "400 days"), state, good, bad)
    return spark.read.schema("name string, outcome string").parquet(out).distinct()


@Q("sm1_one_run_a_topic")
def sm1_runs(spark, d):
    """The runs that the events' topics get, if every third event reports the end of a run; tested by brute force."""
    path, out, state = (new_folder(spark, n) for n in ("messages", "starts", "state"))
    rows = table(spark, d, "events").select(F.lit("geo").alias("schema"), F.concat(F.lit("topic_"), F.col("user_id") % 20).alias("topic"), F.when(F.col("event_id") % 3 == 0, "done").otherwise("change").alias("kind"), F.col("ts").cast("timestamp").alias("at"))
    rows.write.parquet(path)
    messages = spark.readStream.schema(rows.schema).parquet(path)
    runs.write_starts(runs.runs_to_start(messages, "400 days", 400 * 86400), out, state)
    return spark.read.schema(runs.STARTS).parquet(out).groupBy("topic").agg(F.max("run").alias("runs"), F.count_if(F.col("why") == "changed meanwhile").alias("meanwhile"))
