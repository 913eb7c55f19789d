"""A stored text index, kept by increments.

A segment holds the postings of the documents that an update brought: rows of a term with up to BLOCK documents, their ids as differences, how often they
hold the term and how long they are, and the block's largest count and smallest length, from which the best score that it can give follows. Postings are partitioned by
BUCKETS of terms, so that a search reads its terms' buckets only. A document that is removed or rewritten leaves a tombstone, which
counts for the segments before it. A version is a pointer, written last, that names its segments and tombstones; nothing is ever overwritten.
Merging writes one segment of what is alive.

Ranges of (term, document) are cut into blocks where they lie, so a term of every document is spread over tasks; nothing gathers a term.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.functions.stemming import STOP_WORDS, porter
from stratalake.operators.search import B, K1, bm25_part, terms, word_counts
from stratalake.plans.storage import small, written

#: Partitions of the postings, and documents in a block at most.
BUCKETS, BLOCK = 64, 512
#: Blocks a term, those of the best bounds, from which a search takes its first threshold.
FIRST_BLOCKS = 8
POSTINGS = "term string, first bigint, last bigint, n int, gaps array<bigint>, tfs array<int>, lengths array<int>, most int, shortest int, bucket int"


@dataclass(frozen=True)
class Analyzer:
    """How texts and queries become terms."""

    stems: bool = True
    stop_words: frozenset[str] = STOP_WORDS

    def words(self, text: Column) -> Column:
        found = terms(text)
        return F.filter(found, lambda w: ~w.isin(*sorted(self.stop_words))) if self.stop_words else found

    def query(self, text: str) -> list[str]:
        found = [w for w in re.findall("[a-z0-9]+", text.lower()) if w not in self.stop_words]
        return sorted({porter(w) if self.stems else w for w in found})


def _counts(docs: DataFrame, analyzer: Analyzer) -> DataFrame:
    """(term, doc, tf, length) of docs (doc, text); each document's words are counted, and stemmed, where it lies."""
    keyed = docs.select(F.struct("doc", F.size(analyzer.words(F.col("text"))).alias("length")).alias("key"), "text")
    counted = word_counts(keyed, "key", analyzer.words(F.col("text")), porter if analyzer.stems else None)
    return counted.select("term", "key.doc", F.col("tf").cast("int").alias("tf"), "key.length")


def _cutter(block: int):
    """Blocks of `block` documents at most from rows (bucket, term, doc, tf, length) in the order of term and document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            code = batch.column(1).dictionary_encode().indices.to_numpy()
            new = np.concatenate(([True], code[1:] != code[:-1]))
            start = np.flatnonzero(new)
            place = np.arange(n) - np.repeat(start, np.diff(np.concatenate((start, [n]))))
            at = np.flatnonzero(place % block == 0)
            ends = np.concatenate((at[1:], [n]))
            doc, tf, length = (batch.column(i).to_numpy() for i in (2, 3, 4))
            gaps = np.diff(doc, prepend=0)
            gaps[at] = 0
            offsets = pa.array(np.concatenate((at, [n])).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (gaps.astype(np.int64), tf.astype(np.int32), length.astype(np.int32))]
            own = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(own), pa.array(doc[at]), pa.array(doc[ends - 1]), pa.array((ends - at).astype(np.int32)), *lists, pa.array(np.maximum.reduceat(tf, at)), pa.array(np.minimum.reduceat(length, at)), batch.column(0).take(own)],
                names=[c.split()[0] for c in POSTINGS.split(", ")],
            )

    return cut


def _uncut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, segment, doc, tf, length) of blocks (term, segment, first, gaps, tfs, lengths)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        gaps = batch.column(3)
        n = gaps.value_lengths().to_numpy()
        own = np.repeat(np.arange(len(n)), n)
        run = np.cumsum(gaps.flatten().to_numpy())
        before = np.concatenate(([0], run))[np.concatenate(([0], np.cumsum(n)[:-1]))]  # a block's first gap is 0
        doc = run - before[own] + batch.column(2).to_numpy()[own]
        take = pa.array(own)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(doc), batch.column(4).flatten(), batch.column(5).flatten()], names=["term", "segment", "doc", "tf", "length"])


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


class TextIndex:
    """The index at `path`, in its newest version."""

    def __init__(self, spark: SparkSession, path: str, analyzer: Analyzer | None = None):
        self.spark, self.path, self.analyzer = spark, path, analyzer or Analyzer()

    def _state(self) -> dict:
        """The segments, each with the documents and words that it brought, and tombstones with what they took away."""
        try:
            newest = self.spark.read.schema("version string, state string").json(f"{self.path}/pointers/*").agg(F.max(F.struct("version", "state"))).first()[0]
        except Exception as e:  # noqa: BLE001  an index that was never written has no pointers
            if "PATH_NOT_FOUND" not in str(e):
                raise
            newest = None
        return json.loads(newest["state"]) if newest else {"segments": [], "tombstones": [], "docs": 0, "words": 0}

    def _point(self, state: dict) -> None:
        version = f"{time.time_ns():020}-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(version, json.dumps(state))], "version string, state string").coalesce(1).write.json(f"{self.path}/pointers/{version}")

    def _read(self, state: dict, what: str, schema: str) -> DataFrame:
        """The rows of all segments, each with the place of its segment in the order of writing."""
        read = lambda s: self.spark.read.schema(schema).parquet(f"{self.path}/segments/{s['name']}/{what}").withColumn("segment", F.lit(s["at"]))
        if not state["segments"]:
            return self.spark.createDataFrame([], f"{schema}, segment int")
        out = read(state["segments"][0])
        for s in state["segments"][1:]:
            out = out.unionByName(read(s))
        return out

    def _tombstones(self, state: dict) -> DataFrame | None:
        """(t_doc, t_at): the newest tombstone of each document."""
        if not state["tombstones"]:
            return None
        rows = self.spark.read.schema("doc bigint, at int").parquet(*[f"{self.path}/tombstones/{t}" for t in state["tombstones"]])
        return rows.groupBy(F.col("doc").alias("t_doc")).agg(F.max("at").alias("t_at"))

    def _alive(self, rows: DataFrame, state: dict) -> DataFrame:
        """Rows (doc, segment, ...) that no later tombstone is for."""
        dead = self._tombstones(state)
        return rows if dead is None else rows.join(small(dead), (F.col("doc") == F.col("t_doc")) & (F.col("segment") < F.col("t_at")), "left_anti")

    def documents(self) -> DataFrame:
        """(doc, length, digest) of the documents that are alive."""
        state = self._state()
        return self._alive(self._read(state, "docs", "doc bigint, length int, digest bigint"), state).drop("segment")

    def postings(self) -> DataFrame:
        """(term, doc, tf, length) of the documents that are alive."""
        state = self._state()
        return self._alive(self._uncut(self._read(state, "postings", POSTINGS)), state).drop("segment")

    @staticmethod
    def _uncut(blocks: DataFrame) -> DataFrame:
        return blocks.select("term", "segment", "first", "gaps", "tfs", "lengths").mapInArrow(_uncut, "term string, segment int, doc bigint, tf int, length int")

    def _segment(self, counts: DataFrame, docs: DataFrame, at: int) -> tuple[dict, int, int]:
        """Write a segment of counts (term, doc, tf, length) and docs (doc, length, digest); returns it with its documents and words."""
        name = f"{at:08}-{uuid.uuid4().hex}"
        keyed = counts.select(_bucket(F.col("term")).alias("bucket"), "term", "doc", "tf", "length")
        ranged = keyed.repartitionByRange("bucket", "term", "doc").sortWithinPartitions("bucket", "term", "doc")
        ranged.mapInArrow(_cutter(BLOCK), POSTINGS).write.partitionBy("bucket").parquet(f"{self.path}/segments/{name}/postings")
        docs.write.parquet(f"{self.path}/segments/{name}/docs")
        stored = self.spark.read.parquet(f"{self.path}/segments/{name}/docs").agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        return {"name": name, "at": at}, stored[0], stored[1]

    def update(self, added: DataFrame, removed: DataFrame | None = None, key: str = "doc_id", text: str = "text", digest: Column | None = None) -> None:
        """Bring in `added` documents, in place of those of the same key, and take out those of the keys of `removed`. What is written grows with these only."""
        state = self._state()
        at = 1 + max([s["at"] for s in state["segments"]] + [0])
        new = written(added.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), (digest if digest is not None else F.xxhash64(F.col(text))).alias("digest")), "added")
        gone = new.select("doc")
        gone = gone if removed is None else gone.union(removed.select(F.col(key).cast("long").alias("doc"))).distinct()
        old = self._alive(self._read(state, "docs", "doc bigint, length int, digest bigint"), state)
        dead = written(old.join(gone, "doc", "left_semi").select("doc", "length", F.lit(at).alias("at")), "dead")
        n, length = dead.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        if n:
            name = f"{at:08}-{uuid.uuid4().hex}"
            dead.select("doc", "at").write.parquet(f"{self.path}/tombstones/{name}")
            state["tombstones"].append(name)
        docs = new.select("doc", F.size(self.analyzer.words(F.col("text"))).alias("length"), "digest")
        segment, more, words = self._segment(_counts(new, self.analyzer), docs, at)
        state["segments"].append(segment)
        self._point(state | {"docs": state["docs"] - n + more, "words": state["words"] - length + words})

    def sync(self, docs: DataFrame, key: str = "doc_id", text: str = "text", *fields: str) -> DataFrame:
        """Make the index that of `docs`: only documents that are new, rewritten or whose stored fields changed are brought in. Returns (added, removed), how many."""
        digest = F.xxhash64(*[x for c in (text, *fields) for x in (F.col(c).isNull(), F.col(c))])
        now = docs.select(F.col(key).cast("long").alias("doc"), digest.alias("digest"))
        old = self.documents().select("doc", "digest")
        changed = written(now.join(old, ["doc", "digest"], "left_anti").select("doc"), "changed")
        removed = written(old.join(now, "doc", "left_anti").select(F.col("doc").alias(key)), "removed")
        counts = changed.agg(F.count(F.lit(1)).alias("added")).crossJoin(removed.agg(F.count(F.lit(1)).alias("removed")))
        added = docs.join(small(changed.withColumnRenamed("doc", "_doc")), F.col(key) == F.col("_doc"), "left_semi")
        if not changed.isEmpty() or not removed.isEmpty():
            self.update(added, removed, key, text, digest)
        return counts

    def merge(self) -> None:
        """One segment of what is alive in all of them; tombstones are no longer needed."""
        state = self._state()
        segment, docs, words = self._segment(written(self.postings(), "alive"), self.documents(), 1 + max([s["at"] for s in state["segments"]] + [0]))
        self._point({"segments": [segment], "tombstones": [], "docs": docs, "words": words})

    def blocks(self, asked: list[str], state: dict | None = None) -> DataFrame:
        """The blocks of the given terms; only their buckets are read."""
        state = state or self._state()
        buckets = [r[0] for r in self.spark.createDataFrame([(t,) for t in asked], "term string").select(_bucket(F.col("term"))).distinct().collect()]  # of the query
        return self._read(state, "postings", POSTINGS).filter(F.col("bucket").isin(buckets) & F.col("term").isin(asked))

    def search(self, query: str, k: int = 50) -> DataFrame:
        """(doc, score): the k best documents by BM25, ties by the smaller id; blocks that can't hold one of them aren't read further than their bounds."""
        asked = self.analyzer.query(query)
        if not asked:
            return self.spark.createDataFrame([], "doc bigint, score double")
        state = self._state()
        scored, _ = self._scored(state, self.blocks(asked, state), k)
        return scored.orderBy(F.desc("score"), "doc").limit(k)

    def _scored(self, state: dict, blocks: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """(doc, score) of the documents in the blocks that count, and these blocks (term, segment, first)."""
        mean = F.lit(state["words"] / max(state["docs"], 1))
        if state["tombstones"]:
            df = self._alive(self._uncut(blocks), state).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        else:
            df = blocks.groupBy("term").agg(F.sum("n").alias("df"))
        df = written(df, "df")  # a row a term of the query
        part = lambda tf, length: bm25_part(F.lit(state["docs"]), F.col("df"), tf, length, mean)
        bounds = written(blocks.select("term", "segment", "first", "most", "shortest").join(F.broadcast(df), "term").select("term", "segment", "first", part(F.col("most"), F.col("shortest")).alias("bound")), "bounds")

        def scores(chosen: DataFrame) -> DataFrame:
            there = blocks.join(small(chosen.select("term", "segment", "first")), ["term", "segment", "first"], "left_semi")
            rows = self._alive(self._uncut(there), state).join(F.broadcast(df), "term")
            return rows.groupBy("doc").agg(F.sum(part(F.col("tf"), F.col("length"))).alias("score"))

        best = bounds.groupBy("term").agg(F.max("bound").alias("best"))
        ranked = bounds.withColumn("place", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("bound"), "segment", "first")))  # few of a task are shuffled
        # What some blocks give is a lower limit of what their documents have; the k-th best of these is one of the k-th best score.
        first = scores(ranked.filter(F.col("place") <= FIRST_BLOCKS)).orderBy(F.desc("score")).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).first()
        least = first["s"] if first["n"] == k else None
        if least is None:
            return scores(bounds), bounds
        others = best.agg(F.sum("best").alias("all"))
        reach = bounds.join(F.broadcast(best), "term").crossJoin(F.broadcast(others)).withColumn("reach", F.col("bound") + F.col("all") - F.col("best"))
        kept = written(reach.filter(F.col("reach") >= least - 1e-9).select("term", "segment", "first"), "kept-blocks")
        return scores(kept), kept
