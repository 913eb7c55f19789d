"""Versions of a keyed table that share their files: a merge rewrites the files that hold touched keys and nothing else.

A version is a manifest, a table of its files with their key ranges, rows and bytes, and a pointer that is written last; neither is ever overwritten. Files are written in
ranges of the key, so that a change of neighbouring keys touches few of them. Which files these are is found in two steps: by the ranges
of the manifest, and among what is left by the file that each row lies in. Expiry and the sweep of files that no version names work on the manifests.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.merge import guard_keys, row_hash
from stratalake.plans.storage import small, written
from stratalake.plans.upkeep import TARGET_BYTES


class VersionedTable:
    """The table at `path`, with its rows told apart by `key`."""

    def __init__(self, spark: SparkSession, path: str, key: str, target_bytes: int = TARGET_BYTES):
        self.spark, self.path, self.key, self.target_bytes = spark, path, key, target_bytes

    def history(self) -> DataFrame:
        """(version, ts, action): the versions, and when each was published."""
        return self.spark.read.schema("version string, ts timestamp, action string").json(f"{self.path}/pointers/*")

    def newest(self) -> str:
        return self.history().agg(F.max("version")).first()[0]

    def manifest(self, version: str | None = None) -> DataFrame:
        """(file, low, high, rows, bytes) of a version, the newest unless one is named."""
        return self.spark.read.parquet(f"{self.path}/manifests/{version or self.newest()}")

    def read(self, version: str | None = None) -> DataFrame:
        return self._of([r["file"] for r in self.manifest(version).select("file").collect()])  # a row a file

    def _of(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self._schema()).parquet(*files) if files else self.spark.createDataFrame([], self._schema())

    def _with_file(self, files: list[str]) -> DataFrame:
        """The rows of the files, each with the `_file` that it lies in."""
        rows = self._of(files)
        return rows.withColumn("_file", F.col("_metadata.file_path") if files else F.lit(None).cast("string"))

    def _schema(self):
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def _written(self, df: DataFrame, parts: int | None = None, by_group: bool = False) -> DataFrame:
        """The manifest rows of new files: in so many ranges of the key, or as many as their bytes ask for; or one a group of `_group`."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        if by_group:
            df.repartition("_group").sortWithinPartitions("_group", self.key).write.partitionBy("_group").parquet(folder)
        else:
            ranged = df.repartitionByRange(parts, self.key) if parts else df.repartitionByRange(self.key)
            ranged.sortWithinPartitions(self.key).write.parquet(folder)
        files = self.spark.read.schema(df.drop("_group").schema).parquet(folder)
        meta = files.select(F.col(self.key), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        return meta.groupBy("file").agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"))

    def _point(self, manifest: DataFrame, action: str) -> str:
        version = f"{time.time_ns():020}-{uuid.uuid4().hex}"
        manifest.coalesce(1).write.parquet(f"{self.path}/manifests/{version}")  # a row a file
        now = self.spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("ts"), F.lit(action).alias("action"))
        now.coalesce(1).write.json(f"{self.path}/pointers/{version}")
        return version

    def replace(self, df: DataFrame, parts: int | None = None) -> str:
        """A version of just these rows, in `parts` files if asked for. The first one settles the schema."""
        guard_keys(df, self.key)
        df.limit(0).write.mode("ignore").parquet(f"{self.path}/schema")
        return self._point(self._written(df.select(self._schema().names), parts), "replace")

    def _within_reach(self, keys: DataFrame, manifest: pa.Table) -> set[str]:
        """The files whose range holds one of the keys, found by the places of the keys among the ends of all ranges."""
        low, high = (manifest[c].to_numpy(zero_copy_only=False) for c in ("low", "high"))
        ends = np.unique(np.concatenate((low, high)))
        place = lambda k: np.searchsorted(ends, k, "left") + np.searchsorted(ends, k, "right")  # noqa: E731  odd at an end, even between

        def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(place(batch.column(0).to_numpy(zero_copy_only=False))).astype(np.int64))], names=["place"])

        places = sorted(r["place"] for r in keys.mapInArrow(touched, "place bigint").distinct().collect())  # two a file at most
        first, last = np.searchsorted(places, place(low), "left"), np.searchsorted(places, place(high), "right")
        return {f for f, a, b in zip(manifest["file"].to_pylist(), first, last) if a < b}

    def merge(self, source: DataFrame, delete_absent: bool = False, leave_out: tuple[str, ...] = ()) -> dict:
        """A version with the rows of `source` brought in, and, if asked, without the keys that it lacks; says what was rewritten.

        Only files that hold a changed or absent key are rewritten; they are read once for hashes of their rows and once to be written. Rows whose columns, but
        `leave_out`, are as before stay where they are. Without a change there is no new version.
        """
        guard_keys(source, self.key)
        source = source.select(self._schema().names)
        manifest = self.manifest().toArrow()
        files = set(manifest["file"].to_pylist()) if delete_absent else self._within_reach(source.select(self.key), manifest)
        ours = self._with_file(sorted(files))
        old = ours.select(F.col(self.key).alias("_k"), row_hash(ours.drop("_file"), self.key, *leave_out).alias("_h"), "_file")
        new = source.select(F.col(self.key).alias("_n"), row_hash(source, self.key, *leave_out).alias("_new"))
        both = old.join(new, F.col("_k") == F.col("_n"), "full_outer" if delete_absent else "right")
        change = F.when(F.col("_k").isNull(), "new").when(F.col("_n").isNull(), "absent").when(F.col("_h") != F.col("_new"), "changed")
        touched = written(both.select(F.coalesce("_k", "_n").alias("_key"), "_file", change.alias("change")).filter("change is not null"), "touched")
        counts = {r["change"]: r["n"] for r in touched.groupBy("change").agg(F.count(F.lit(1)).alias("n")).collect()}
        hit = {r["_file"] for r in touched.select("_file").filter("_file is not null").distinct().collect()}  # files to rewrite
        done = {"files": len(hit), "kept_files": manifest.num_rows - len(hit), **{c: counts.get(c, 0) for c in ("new", "changed", "absent")}}
        if not counts:
            return done | {"version": None}
        keys = touched.select("_key")
        stay = self._of(sorted(hit)).join(small(keys), F.col(self.key) == F.col("_key"), "left_anti")
        come = source.join(small(touched.filter("change <> 'absent'").select("_key")), F.col(self.key) == F.col("_key"), "left_semi")
        kept = self.spark.createDataFrame(manifest).filter(~F.col("file").isin(sorted(hit))) if hit else self.spark.createDataFrame(manifest)
        # New files are as large as those of the table are on average.
        rows = sum(r["rows"] for r in manifest.to_pylist() if r["file"] in hit) + counts.get("new", 0) - counts.get("absent", 0)
        usual = sum(manifest["rows"].to_pylist()) / max(manifest.num_rows, 1)
        parts = max(1, round(rows / usual)) if usual else None
        return done | {"version": self._point(kept.unionByName(self._written(stay.unionByName(come), parts)), "merge")}

    def compact(self, budget_bytes: int | None = None) -> dict:
        """A version whose small files, those under half the target, are joined to ones of about the target, neighbours by key together; large ones stay as they are.

        At most `budget_bytes` are rewritten; what is left waits for the next run. Without a group of two files there is no new version.
        """
        manifest = self.manifest().toArrow()
        few = sorted((r for r in manifest.to_pylist() if r["bytes"] < self.target_bytes / 2), key=lambda r: (r["low"], r["high"], r["file"]))
        groups: list[list[dict]] = [[]]
        for r in few:
            if groups[-1] and sum(x["bytes"] for x in groups[-1]) + r["bytes"] > self.target_bytes:
                groups.append([])
            groups[-1].append(r)
        chosen, spent = [], 0
        for g in (g for g in groups if len(g) > 1):
            size = sum(r["bytes"] for r in g)
            if budget_bytes is not None and spent + size > budget_bytes:
                break
            chosen.append(g)
            spent += size
        done = {"groups": len(chosen), "files": sum(map(len, chosen)), "bytes": spent}
        if not chosen:
            return done | {"version": None}
        placed = self.spark.createDataFrame([(r["file"], i) for i, g in enumerate(chosen) for r in g], "_file string, _group int")
        gone = sorted(r["file"] for g in chosen for r in g)
        rows = self._with_file(gone).join(F.broadcast(placed), "_file").drop("_file")
        kept = self.spark.createDataFrame(manifest).filter(~F.col("file").isin(gone))
        return done | {"version": self._point(kept.unionByName(self._written(rows, by_group=True)), "compact")}

    def listing(self) -> DataFrame:
        """(path, modified, bytes) of all files that were ever written and are still there."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.path}/data")
        return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))

    def references(self, versions: DataFrame | None = None) -> DataFrame:
        """(path): the files that some version names, of all versions or those of a column `version`."""
        names = [r["version"] for r in (versions or self.history()).select("version").collect()]  # a row a version
        local = F.regexp_replace("file", "^file:/+", "file:/")  # listings write local paths with one slash
        return self.spark.read.parquet(*[f"{self.path}/manifests/{v}" for v in names]).select(local.alias("path")).distinct()
