"""Incremental runs and upkeep of a lake."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.aggregates import fingerprint
from stratalake.plans.storage import small, written

TARGET_BYTES = 256 << 20


def unchanged(df: DataFrame, state: DataFrame, topic: str, signature: str) -> bool:
    """Whether a topic's fingerprint equals the stored one (topic, rows, hash_sum, signature)."""
    now = fingerprint(df, signature).withColumn("topic", F.lit(topic))
    return not now.join(state, ["topic", "rows", "hash_sum", "signature"], "left_semi").isEmpty()


def skip_plan(now: DataFrame, state: DataFrame, newest: int) -> DataFrame:
    """`now` (topic, rows, hash_sum, signature) with skipped and its reason: a topic is skipped if its stored state is equal, its outputs exist and their format is current.

    `state` has outputs (whether they exist) and format as well. Metadata is written either way.
    """
    old = state.select("topic", *[F.col(c).alias(f"_{c}") for c in ("rows", "hash_sum", "signature", "outputs", "format")])
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("hash_sum").eqNullSafe(F.col("_hash_sum")) & F.col("signature").eqNullSafe(F.col("_signature"))
    reason = F.when(F.col("_rows").isNull(), "new").when(~F.col("_outputs"), "outputs are missing").when(F.col("_format") < newest, "old format").when(~same, "changed").otherwise("unchanged")
    return now.join(old, "topic", "left").withColumn("reason", reason).withColumn("skipped", F.col("reason") == "unchanged").drop(*[c for c in old.columns if c != "topic"])


def run_sinks(df: DataFrame, sinks: dict[str, Callable[[DataFrame], None]]) -> dict[str, str]:
    """Run each sink over one written copy of `df`; a sink that fails is reported and the others still run."""
    source, out = written(df, "sinks"), {}
    for name, sink in sinks.items():
        try:
            sink(source)
            out[name] = "ok"
        except Exception as e:  # noqa: BLE001  any sink's failure is its own
            out[name] = f"failed: {type(e).__name__}"
    return out


def advanced(state: DataFrame, now: DataFrame, plan: DataFrame, outcomes: dict[str, dict[str, str]], newest: int) -> DataFrame:
    """The state after a run: (topic, rows, hash_sum, signature, outputs, format).

    `plan` is that of `skip_plan`, `outcomes` has for each topic that ran what its data sinks reported (see `run_sinks`). A topic's hash vouches for its outputs, so it moves on only where all of them were rewritten; after
    a failed sink the old one stays, or none, and the next run does the topic again. Topics that were skipped or not looked at keep their state.
    """
    spark = state.sparkSession
    ran = [(t, all(x == "ok" for x in r.values())) for t, r in outcomes.items()]
    done = spark.createDataFrame([(t,) for t, ok in ran if ok], "topic string").join(plan.filter(~F.col("skipped")).select(F.col("topic").cast("string").alias("topic")), "topic", "left_semi")
    columns = ["topic", "rows", "hash_sum", "signature", "outputs", "format"]
    key = F.col("topic").cast("string")
    moved = now.join(small(done.withColumnRenamed("topic", "_t")), key == F.col("_t"), "left_semi").withColumns({"outputs": F.lit(True), "format": F.lit(newest)}).select(columns)
    return moved.unionByName(state.join(small(done.withColumnRenamed("topic", "_t")), key == F.col("_t"), "left_anti").select(columns))


def needs(manifest: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """`manifest` with the names of the checks that hold, for the rows that need anything."""
    todo = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return manifest.withColumn("needs", todo).filter(F.size("needs") > 0)


def pending(marks: DataFrame, refreshed: DataFrame) -> DataFrame:
    """(topic, since, marks): the topics that wait for a refresh, from when and how often they were marked since their last one.

    `marks` has (topic, at), a row for each change, and `refreshed` (topic, began), a row for each refresh that ended. A refresh clears what was marked before it began, and nothing that was marked while it ran,
    so a mark is never lost; marks without a topic count for nothing.
    """
    last = refreshed.groupBy(F.col("topic").alias("_t")).agg(F.max("began").alias("began"))
    # Marks are counted by topic and time first: a topic that is marked very often is a few rows where it meets its refresh.
    counted = marks.filter("topic is not null").groupBy("topic", "at").agg(F.count(F.lit(1)).alias("n"))
    waiting = counted.join(last, F.col("topic") == F.col("_t"), "left").filter(F.col("began").isNull() | (F.col("at") >= F.col("began")))
    return waiting.groupBy("topic").agg(F.min("at").alias("since"), F.sum("n").alias("marks"))


def rebuild_plan(digests: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Keys whose (key, digest) isn't in the stored state."""
    return digests.join(state, [key, "digest"], "left_anti")


def expired(versions: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Versions older than so many days, never a table's newest."""
    newest = versions.groupBy("tab").agg(F.max("ts").alias("newest"))
    return versions.join(newest, "tab").filter((F.col("ts") < now - F.make_dt_interval(F.lit(days))) & (F.col("ts") < F.col("newest"))).drop("newest")


def compacted(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """A folder's Parquet files rewritten as few files of about the target size; the caller switches to the new ones."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length").alias("b")).first()["b"] or 0
    return written(spark.read.parquet(path).coalesce(max(1, -(-files // target_bytes))), "compacted")


def orphans(listing: DataFrame, refs: DataFrame, cutoff: Column) -> DataFrame:
    """Files that nothing references and that are older than the cutoff; refused if a referenced file isn't listed."""
    if not refs.join(listing, "path", "left_anti").isEmpty():
        raise ValueError("a referenced file is missing from the listing")
    return listing.join(refs.select("path"), "path", "left_anti").filter(F.col("modified") < cutoff)


def dangling(refs: DataFrame, listing: DataFrame) -> DataFrame:
    """Tables none of whose files exist."""
    there = refs.join(listing.select("path").withColumn("there", F.lit(True)), "path", "left")
    return there.groupBy("tab").agg(F.count("there").alias("n")).filter("n = 0").select("tab")


def retired(listing: DataFrame, folder: str) -> DataFrame:
    """The paths in exactly this folder, not in one whose name begins alike."""
    return listing.filter(F.startswith("path", F.lit(folder.rstrip("/") + "/")))


def checksums(spark: SparkSession, path: str, most_bytes: int) -> DataFrame:
    """(the folder's partition columns, file, size, checksum) of the files up to a size."""
    files = spark.read.format("binaryFile").load(path).filter(F.col("length") <= most_bytes)
    folders = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.select(*folders, F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.col("length").alias("size"), F.sha2("content", 256).alias("checksum"))


#: Fixed value: a prune of more than this share of what is expected is refused.
MOST_PRUNED = 0.05


def prune_guard(doomed: DataFrame, expected: DataFrame) -> DataFrame:
    """(doomed, expected, refused): how many rows a prune would delete, of how many expected ones, and whether that is too many."""
    counts = doomed.agg(F.count(F.lit(1)).alias("doomed")).crossJoin(F.broadcast(expected.agg(F.count(F.lit(1)).alias("expected"))))
    return counts.withColumn("refused", F.col("doomed") > MOST_PRUNED * F.greatest("expected", F.lit(1)))
