"""Queries over two versions of the orders."""

from pyspark.sql import functions as F

from stratalake.operators import merge
from stratalake.plans.storage import new_folder
from stratalake.plans.versions import VersionedTable
from stratalake.queries.base import ORDERS2, Register, sql, table

Q = Register()
COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
V2 = f"({ORDERS2})"
KEY = "o_orderkey"


def _versions(spark, d):
    return table(spark, d, "orders").select(*COLUMNS.split(", ")), sql(spark, d, ORDERS2, "orders")


@Q("mg1_narrow_delta", f"select s.o_orderkey from {V2} s left join orders t on s.o_orderkey = t.o_orderkey where t.o_orderkey is null or s.o_orderstatus <> t.o_orderstatus")
def mg1(spark, d):
    return merge.delta_keys(*_versions(spark, d), KEY)


@Q("mg2_upsert", f"select * from {V2} union all select {COLUMNS} from orders where o_orderkey % 11 = 0")
def mg2(spark, d):
    return merge.upsert(*_versions(spark, d), KEY)


@Q("mg3_delete_absent", f"select {COLUMNS} from orders where o_orderkey in (select o_orderkey from {V2})")
def mg3(spark, d):
    old, new = _versions(spark, d)
    return old.join(new.select(KEY), KEY, "left_semi")


@Q("mg4_null_key_guard", f"select true as nulls, -count(*) as n from {V2} where o_orderkey % 5 = 0 union all select false, count(*) from {V2}")
def mg4(spark, d):
    old, new = _versions(spark, d)
    rows = []
    for every in (5, 1 << 40):  # with null keys, and with none
        try:
            merged = merge.merge(old, new.withColumn(KEY, F.when(F.col(KEY) % every != 0, F.col(KEY))), KEY)
            rows.append(merged.agg(F.lit(every == 5).alias("nulls"), F.count(F.lit(1)).alias("n")))
        except ValueError:
            rows.append(new.filter(F.col(KEY) % every == 0).agg(F.lit(every == 5).alias("nulls"), (-F.count(F.lit(1))).alias("n")))
    return rows[0].union(rows[1])


@Q("mg5_merge_publish", f"select * from {V2}")
def mg5(spark, d):
    old, new = _versions(spark, d)
    path = new_folder(spark, "lake")
    merge.publish(old, path)
    merge.publish(merge.merge(merge.current(spark, path), new, KEY), path)
    return merge.current(spark, path)


@Q("mg5_delta_publish", f"select * from {V2}")
def mg5_delta(spark, d):
    """The same, as a version that shares files with the one before."""
    old, new = _versions(spark, d)
    lake = VersionedTable(spark, new_folder(spark, "lake"), KEY)
    lake.replace(old)
    lake.merge(new, delete_absent=True)
    return lake.read()


@Q("mg5_touched_files", "select count(*) as n, sum(case when o_orderkey <= (select max(o_orderkey) // 100 from orders) then 1 else 0 end)::bigint as changed, true as few from orders")
def mg5_files(spark, d):
    """A change of the first hundredth of the keys rewrites two of sixteen files at most, and leaves the others to both versions."""
    old, _ = _versions(spark, d)
    lake = VersionedTable(spark, new_folder(spark, "lake"), KEY)
    lake.replace(old, 16)
    top = old.agg(F.max(KEY)).first()[0]
    done = lake.merge(old.filter(F.col(KEY) <= top // 100).withColumn("o_orderstatus", F.lit("?")))
    few = done["files"] <= 2 and done["kept_files"] >= 14
    return lake.read().agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "?").alias("changed"), F.lit(few).alias("few"))


#: Rows are matched by a digest of what doesn't change here, as geometries are.
DIFF = f"""with o as (select md5(o_orderkey::varchar) as k, min((o_orderstatus, o_totalprice)) as a, count(*) as c from orders group by 1),
n as (select md5(o_orderkey::varchar) as k, min((o_orderstatus, o_totalprice)) as a, count(*) as c from {V2} group by 1)
select count(*) filter (where o.k is null) as added, count(*) filter (where n.k is null) as removed, count(*) filter (where o.a <> n.a) as modified,
    count(*) filter (where o.a = n.a) as unchanged, sum(o.c)::bigint as old_rows, sum(n.c)::bigint as new_rows from o full join n on o.k = n.k"""


@Q("mg6_version_diff_summary", DIFF)
def mg6(spark, d):
    return merge.diff_summary(*_versions(spark, d), F.md5(F.col(KEY).cast("string")), ["o_orderstatus", "o_totalprice"])


@Q("mg7_version_diff_rows", f"""select md5(coalesce(s.o_orderkey, t.o_orderkey)::varchar) as key, case when t.o_orderkey is null then 'added' when s.o_orderkey is null then 'removed' else 'modified' end as change,
    case when t.o_orderkey is not null and s.o_orderkey is not null then 'o_orderstatus:' || t.o_orderstatus || '>' || s.o_orderstatus end as fields
    from {V2} s full join orders t on s.o_orderkey = t.o_orderkey where t.o_orderkey is null or s.o_orderkey is null or s.o_orderstatus <> t.o_orderstatus""")
def mg7(spark, d):
    rows = merge.diff_rows(*_versions(spark, d), F.md5(F.col(KEY).cast("string")), ["o_orderstatus", "o_totalprice"])
    return rows.withColumn("fields", F.array_join(F.transform("fields", lambda x: F.concat(x["col"], F.lit(":"), x["old"], F.lit(">"), x["new"])), ","))


@Q("sk9_lake_write", f"select 'merge' as mode, count(*) as n from {V2}")
def sk9(spark, d):
    old, new = _versions(spark, d)
    mode, _ = merge.lake_mode(old, new, KEY)
    return (merge.merge(old, new, KEY) if mode == "merge" else new).agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n")).select("mode", "n")


@Q("sk10_key_loss_warning", "select count(*) as n, 'the source has no o_orderkey' as warning from orders")
def sk10(spark, d):
    old, new = _versions(spark, d)
    _, warnings = merge.lake_mode(old, new.drop(KEY), KEY)
    return old.agg(F.count(F.lit(1)).alias("n")).withColumn("warning", F.lit("; ".join(warnings)))
