"""Queries over incremental runs and upkeep."""

from pyspark.sql import functions as F

from stratalake.operators.aggregates import digest_of, fingerprint
from stratalake.operators.merge import row_hash
from stratalake.plans import upkeep
from stratalake.plans.storage import new_folder, written
from stratalake.plans.versions import VersionedTable
from stratalake.queries.base import Register, table

Q = Register()
PATHS = "select 'lake/t' || (event_id % 9) || '/' || event_id as path, 't' || (event_id % 9) as tab, ts as modified, event_id from events"


def _listing(spark, d):
    e = table(spark, d, "events")
    tab = F.concat(F.lit("t"), e.event_id % 9)
    return e.select(F.concat(F.lit("lake/"), tab, F.lit("/"), e.event_id).alias("path"), tab.alias("tab"), F.col("ts").cast("timestamp_ntz").alias("modified"), "event_id")


@Q("in1_skip_unchanged", """with t as (select o_custkey % 20 as topic, count(*) as n, bool_or(o_orderkey % 97 = 5) as edited from orders group by 1)
select topic, n, not edited and topic % 5 <> 0 and topic % 7 <> 0 as skipped, case when topic % 5 = 0 then 'outputs are missing' when topic % 7 = 0 then 'old format' when edited then 'changed' else 'unchanged' end as reason from t""")
def in1(spark, d):
    """Topics against their stored state: some were edited, some lost their outputs, and some have an older format."""
    o = table(spark, d, "orders").withColumn("topic", F.col("o_custkey") % 20)
    state = fingerprint(o, "v1", ("topic",)).withColumns({"outputs": F.col("topic") % 5 != 0, "format": F.when(F.col("topic") % 7 == 0, 1).otherwise(2)})
    now = fingerprint(o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 5, "X").otherwise(F.col("o_orderstatus"))), "v1", ("topic",))
    return upkeep.skip_plan(now, written(state, "state"), 2).select("topic", F.col("rows").alias("n"), "skipped", "reason")


@Q("in1_hash_advances", """with t as (select o_custkey % 20 as topic, count(*) as n, bool_or(o_orderkey % 97 = 5) as edited from orders group by 1)
select topic, not (edited or topic % 5 = 0 or topic % 7 = 0) or topic % 3 <> 0 as skipped_next from t""")
def in1_advance(spark, d):
    """After a run in which a sink fails for every third topic: these come up again, the others are skipped."""
    o = table(spark, d, "orders").withColumn("topic", F.col("o_custkey") % 20)
    state = fingerprint(o, "v1", ("topic",)).withColumns({"outputs": F.col("topic") % 5 != 0, "format": F.when(F.col("topic") % 7 == 0, 1).otherwise(2)})
    now = written(fingerprint(o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 5, "X").otherwise(F.col("o_orderstatus"))), "v1", ("topic",)), "now")
    state = written(state, "state")
    plan = written(upkeep.skip_plan(now, state, 2), "plan")
    todo = [r["topic"] for r in plan.filter("not skipped").select("topic").collect()]  # the topics of a run
    outcomes = {str(t): {"lake": "ok", "archive": "failed: OSError" if t % 3 == 0 else "ok"} for t in todo}
    after = written(upkeep.advanced(state, now, plan, outcomes, 2), "state")
    return upkeep.skip_plan(now, after, 2).select("topic", F.col("skipped").alias("skipped_next"))


@Q("in2_independent_sinks", "select count(*) as n, 'a:ok b:failed: ValueError c:ok' as report from nation")
def in2(spark, d):
    path = new_folder(spark, "sink")

    def fails(df):
        raise ValueError("this sink is down")

    n = table(spark, d, "nation")
    report = upkeep.run_sinks(n, {"a": lambda df: df.write.parquet(f"{path}/a"), "b": fails, "c": lambda df: df.write.json(f"{path}/c")})
    return spark.read.schema(n.schema).json(f"{path}/c").agg(F.count(F.lit(1)).alias("n"), F.lit(" ".join(f"{k}:{v}" for k, v in report.items())).alias("report"))


@Q("in3_needs_plan", "select p_partkey, concat_ws(',', case when p_size < 10 then 'thumbnail' end, case when p_partkey % 4 = 0 then 'version' end) as needs from part where p_size < 10 or p_partkey % 4 = 0")
def in3(spark, d):
    p = upkeep.needs(table(spark, d, "part"), {"thumbnail": F.col("p_size") < 10, "version": F.col("p_partkey") % 4 == 0})
    return p.select("p_partkey", F.array_join("needs", ",").alias("needs"))


@Q("in4_tier_rebuild_plan", "select p_brand from part group by 1 having count(*) filter (where p_partkey % 50 = 0) > 0")
def in4(spark, d):
    p = table(spark, d, "part")
    digest = lambda size: p.groupBy("p_brand").agg(digest_of(F.concat("p_partkey", F.lit(":"), size)).alias("digest"))
    changed = F.when(F.col("p_partkey") % 50 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))
    return upkeep.rebuild_plan(digest(changed), digest(F.col("p_size")), "p_brand").select("p_brand")


@Q("in5_pending_set", "select user_id from events where event_type = 'click' intersect select user_id from events where event_type = 'error'")
def in5(spark, d):
    e = table(spark, d, "events")
    changed, problems = (e.filter(F.col("event_type") == t).select("user_id").distinct() for t in ("click", "error"))
    return changed.join(problems, "user_id", "left_semi")


@Q("in5_pending_cleared", """with r as (select user_id, max(ts) as began from events where event_type = 'error' group by 1)
select c.user_id as topic, min(ts) as since, count(*) as marks from events c left join r on r.user_id = c.user_id where event_type = 'click' and (began is null or ts >= began) group by 1""")
def in5_cleared(spark, d):
    """Clicks mark their users, errors stand for the refreshes; what was marked since the last one is pending."""
    e = table(spark, d, "events")
    marks = e.filter("event_type = 'click'").select(F.col("user_id").alias("topic"), F.col("ts").alias("at"))
    return upkeep.pending(marks, e.filter("event_type = 'error'").select(F.col("user_id").alias("topic"), F.col("ts").alias("began")))


@Q("in6_served_fields_changed", "select p_partkey from part where p_size % 5 = 0")
def in6(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    sizes = table(spark, d, "part").select("p_partkey", "p_size")
    new = p.join(sizes, "p_partkey").withColumn("p_type", F.when(F.col("p_size") % 5 != 0, F.col("p_type"))).drop("p_size")
    old = p.select("p_partkey", row_hash(p, "p_partkey").alias("old"))
    return new.select("p_partkey", row_hash(new, "p_partkey").alias("now")).join(old, "p_partkey").filter(~F.col("old").eqNullSafe(F.col("now"))).select("p_partkey")


@Q("mt1_expire_versions", f"with v as ({PATHS}) select path from v where modified < (select max(modified) from v) - interval 7 day and modified < (select max(modified) from v w where w.tab = v.tab)")
def mt1(spark, d):
    v = _listing(spark, d).withColumnRenamed("modified", "ts")
    now = v.agg(F.max("ts")).first()[0]
    return upkeep.expired(v, F.lit(now).cast("timestamp_ntz")).select("path")


@Q("mt2_compact_small_files", "select count(*) as n, sum(event_id)::bigint as ids, true as fewer from events")
def mt2(spark, d):
    path = new_folder(spark, "backlog")
    table(spark, d, "events").repartition(40).write.parquet(path)
    out = upkeep.compacted(spark, path)
    many, few = spark.read.parquet(path).inputFiles(), out.inputFiles()
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.lit(len(few) < len(many)).alias("fewer"))


@Q("mt2_compact_groups", "select count(*) as n, sum(event_id)::bigint as ids, true as fewer, true as settled from events")
def mt2_groups(spark, d):
    """Small files are joined in groups of neighbours; a second run finds nothing to do."""
    lake = VersionedTable(spark, new_folder(spark, "backlog"), "event_id", 1 << 18)
    events = table(spark, d, "events")
    lake.replace(events.filter("event_id % 2 = 0"), 6)
    for part in (1, 3, 5):
        lake.merge(events.filter(F.col("event_id") % 6 == part))
    before, done = lake.manifest().count(), lake.compact()
    again = lake.compact()
    return lake.read().agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.lit(lake.manifest().count() <= before - done["files"] + done["groups"]).alias("fewer"), F.lit(again["groups"] == 0).alias("settled"))


@Q("mt3_sweep_of_versions", "select true as swept, count(*) as n from orders")
def mt3_versions(spark, d):
    """Once the first of two versions is expired, the files that only it names are the orphans, and the table still reads."""
    lake = VersionedTable(spark, new_folder(spark, "lake"), "o_orderkey")
    orders = table(spark, d, "orders")
    lake.replace(orders)
    first = lake.references().collect()
    lake.replace(orders.withColumn("o_orderstatus", F.lit("?")))
    kept = lake.history().filter(F.col("version") == lake.newest())
    gone = upkeep.orphans(lake.listing().select("path", "modified"), lake.references(kept), F.current_timestamp() + F.expr("interval 1 hour"))
    same = {r["path"] for r in gone.select("path").collect()} == {r["path"] for r in first}
    return lake.read().filter("o_orderstatus = '?'").agg(F.lit(same).alias("swept"), F.count(F.lit(1)).alias("n"))


@Q("mt3_orphan_sweep", f"select path from ({PATHS}) v where event_id % 5 = 0 and modified < (select max(ts) from events) - interval 3 day")
def mt3(spark, d):
    listing = _listing(spark, d)
    now = listing.agg(F.max("modified")).first()[0]
    return upkeep.orphans(listing, listing.filter("event_id % 5 <> 0").select("path"), F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(3))).select("path")


@Q("mt4_drop_dangling", "select 't' || k as tab from range(9) t(k) where k in (2, 5) and exists (select 1 from events)")
def mt4(spark, d):
    listing = _listing(spark, d)
    return upkeep.dangling(listing.select("tab", "path"), listing.filter("tab not in ('t2', 't5')"))


@Q("mt5_retire_topic", f"select path from ({PATHS}) v where path like 'lake/t1/%'")
def mt5(spark, d):
    return upkeep.retired(_listing(spark, d), "lake/t1").select("path")


@Q("mt6_checksum_backfill", "select n_nationkey, sha256(n_name || chr(10)) as checksum from nation")
def mt6(spark, d):
    path = new_folder(spark, "files")
    n = table(spark, d, "nation")
    n.select("n_nationkey", F.col("n_name").alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    sums = upkeep.checksums(spark, path, 1 << 20)
    return sums.filter("size > 0").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "checksum")
