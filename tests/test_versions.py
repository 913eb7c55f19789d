"""Versions that share files, compaction in groups, and the sweep."""

import pytest
from pyspark.sql import functions as F

from stratalake.plans import upkeep
from stratalake.plans.versions import VersionedTable


def content(df):
    return sorted(tuple(r) for r in df.collect())


def files(lake, version=None):
    return {r["file"] for r in lake.manifest(version).collect()}


@pytest.fixture
def lake(spark, tmp_path):
    lake = VersionedTable(spark, f"file://{tmp_path}/lake", "k")
    lake.replace(spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")), 10)
    return lake


def test_a_merge_rewrites_touched_files_only(spark, lake):
    before, first = files(lake), lake.newest()
    assert len(before) == 10
    done = lake.merge(spark.createDataFrame([(5, "new"), (6, "new"), (7, "v7")], "k long, v string"))
    assert (done["files"], done["kept_files"], done["changed"], done["new"]) == (1, 9, 2, 0)
    assert len(before & files(lake)) == 9 and len(files(lake)) == 10
    want = [(i, "new" if i in (5, 6) else f"v{i}") for i in range(2000)]
    assert content(lake.read()) == want and content(lake.read(first)) == [(i, f"v{i}") for i in range(2000)]
    assert lake.merge(spark.createDataFrame([(5, "new")], "k long, v string"))["version"] is None


def test_new_and_absent_keys(spark, lake):
    done = lake.merge(spark.createDataFrame([(5000, "a"), (-3, "b")], "k long, v string"))
    assert (done["files"], done["new"]) == (0, 2)
    source = lake.read().filter("k % 500 <> 3 or k > 1000").withColumn("v", F.when(F.col("k") == 1500, "c").otherwise(F.col("v")))
    want = content(source)
    done = lake.merge(source, delete_absent=True)
    assert (done["absent"], done["changed"]) == (2, 1) and done["files"] <= 4
    assert content(lake.read()) == want
    with pytest.raises(ValueError):
        lake.merge(spark.createDataFrame([(None, "x")], "k long, v string"))


def test_text_keys(spark, tmp_path):
    lake = VersionedTable(spark, f"file://{tmp_path}/text", "k")
    lake.replace(spark.range(500).select(F.format_string("k%05d", "id").alias("k"), F.col("id").alias("v")), 5)
    done = lake.merge(spark.createDataFrame([("k00007", -1), ("zz", 9)], "k string, v long"))
    assert done["files"] == 1 and done["new"] == 1 and lake.read().filter("v = -1").count() == 1 and lake.read().count() == 501


def test_compaction_in_groups(spark, tmp_path):
    lake = VersionedTable(spark, f"file://{tmp_path}/small", "k")
    rows = spark.range(30000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    lake.replace(rows.filter("k < 20000"), 1)
    large = files(lake)
    for i in range(6):
        lake.merge(rows.filter((F.col("k") >= 20000) & (F.col("k") % 6 == i)))
    sizes = {r["file"]: r["bytes"] for r in lake.manifest().collect()}
    small = {f: b for f, b in sizes.items() if f not in large}
    lake.target_bytes = 3 * max(small.values())
    assert len(small) >= 6 and min(sizes[f] for f in large) > lake.target_bytes / 2
    want = content(lake.read())
    assert lake.compact(budget_bytes=1)["version"] is None
    one = lake.compact(budget_bytes=int(3.1 * max(small.values())))
    assert one["groups"] == 1 and one["bytes"] <= 3.1 * max(small.values()) and large <= files(lake)
    lake.compact()
    assert large <= files(lake) and len(files(lake)) < len(sizes) and content(lake.read()) == want
    while lake.compact()["version"]:
        pass
    now = files(lake)
    assert lake.compact() == {"groups": 0, "files": 0, "bytes": 0, "version": None} and files(lake) == now


def test_expired_versions_leave_orphans(spark, lake):
    old = files(lake)
    lake.merge(spark.createDataFrame([(5, "new")], "k long, v string"))
    kept = lake.history().filter(F.col("version") == lake.newest())
    soon = F.current_timestamp() + F.expr("interval 1 hour")
    listed = lambda df: {r["path"].split("/")[-1] for r in df.collect()}
    assert listed(upkeep.orphans(lake.listing().select("path", "modified"), lake.references(), soon)) == set()
    gone = listed(upkeep.orphans(lake.listing().select("path", "modified"), lake.references(kept), soon))
    assert gone == {f.split("/")[-1] for f in old - files(lake)} and len(gone) == 1
    history = lake.history().withColumn("tab", F.lit("t"))
    assert {r["version"] for r in upkeep.expired(history, F.current_timestamp() + F.expr("interval 30 days")).collect()} == {r["version"] for r in history.collect()} - {lake.newest()}
