"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text: it doubles and adds a random number for each byte, so that its 32 bits
depend on the last 32 bytes only. A chunk ends where the hash falls below 1/AVERAGE of its range, MIN_CHUNK bytes or more after it
began, and at MAX_CHUNK bytes at the latest; so an insertion moves the ends near it and no others. Chunks are
counted by digest, and of each digest the occurrence with the smallest (doc_id, start) is the first. Runs of
neighbouring chunks that occur more than once are extended on both sides to the exact byte up to which the text is that
of another occurrence; runs that then meet are one, and those of MIN_SPAN bytes or more are the repeated spans.

A digest has 64 bits and is told apart by the chunk's size too; two unlike chunks that agree in both still have unlike surroundings, so that they make no span
of MIN_SPAN bytes unless one chunk is that long.

Defined results: null and empty texts have no chunks; repeats within a text count; rows that share a doc_id and a
text, null ids included, are one; documents without repeats have no rows; a very long text is a slice of its own and needs some 60 bytes of memory for each of its
own; other columns are ignored (deduplicated keeps them), whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm import kernels as K
from stratalake.llm.tables import documents, written

AVERAGE, MIN_CHUNK, MAX_CHUNK, MIN_SPAN = 32, 16, 192, 96
WARM = 32
#: Bytes of context that a task hands on at a time.
CONTEXT_BYTES = 4 << 20
_GEAR = (K.mix(np.arange(1001, 1257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def chunk_ends(data: np.ndarray, offsets: np.ndarray, average: int = AVERAGE, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> np.ndarray:
    """The ends of all chunks, each document's last one included."""
    h = _GEAR[data]
    width = 1
    while width < WARM:  # h over 2 * width bytes, from h over width bytes
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    cut = np.flatnonzero(h < np.uint32((1 << 32) // average)) + 1
    # The hash has to have rolled over this document's own bytes.
    own = np.searchsorted(offsets, cut - 1, "right") - 1
    cut = cut[cut - offsets[own] >= WARM]
    marks = np.union1d(cut, offsets)
    ends, start = [], 0
    stops = set(offsets.tolist())
    for mark in marks.tolist():
        while mark - start > most:
            start += most
            ends.append(start)
        if mark > start and (mark - start >= least or mark in stops):
            ends.append(mark)
            start = mark
    return np.array(ends, np.int64)


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, t, start, size, digest) of all chunks, in bytes of the UTF-8 text; t is the text's hash."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in K.slices(batch.column(2)):
                ends = chunk_ends(data, offsets)
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
                own = np.searchsorted(offsets, starts, "right") - 1
                rows = pa.array(own + at)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array((starts - offsets[own]).astype(np.int32)), pa.array((ends - starts).astype(np.int32)), pa.array(K.span_hashes(data, starts, ends).view(np.int64))], names=["doc_id", "t", "start", "size", "digest"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").filter("text <> ''")
    return rows.mapInArrow(chunk, "doc_id bigint, t bigint, start int, size int, digest bigint")


def _with_context(texts: DataFrame, spots: DataFrame, width: int) -> DataFrame:
    """`spots` (doc_id, t, run, digest, left, target, pos) with up to `width` bytes of text after pos; before it, and backwards, if left."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
        names = ["doc_id", "t", "run", "digest", "left", "target", "context"]
        full = max(1, CONTEXT_BYTES // width)
        for batch in batches:
            rows: list[tuple] = []
            for r in range(batch.num_rows):
                doc_id, t, data = batch.column(0)[r].as_py(), batch.column(1)[r].as_py(), batch.column(2)[r].as_buffer()
                spots_ = batch.column(3)[r].values
                for run, digest, left, target, pos in zip(*(spots_.field(i).to_pylist() for i in range(5))):
                    context = data[max(0, pos - width) : pos].to_pybytes()[::-1] if left else data[pos : pos + width].to_pybytes()
                    rows.append((doc_id, t, run, digest, left, target, context))
                    if len(rows) == full:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    # Nulls are ids like any other here.
    keys = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "t"]
    lists = spots.groupBy(*keys).agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("run", "digest", "left", "target", "pos")).alias("spots"))
    once = texts.groupBy(*keys).agg(F.first("text").alias("text"))
    joined = once.join(lists, ["none", "id", "t"]).select("doc_id", "t", F.col("text").cast("binary").alias("text"), "spots")
    return joined.mapInArrow(cut, "doc_id bigint, t bigint, run bigint, digest bigint, left boolean, target boolean, context binary")


@F.arrow_udf(T.IntegerType())
def _common(context: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
    """How many bytes `context` has in common with the better one of its neighbours in order."""
    out = []
    for x, *others in zip(context.to_pylist(), before.to_pylist(), after.to_pylist()):
        best = 0
        for y in others:
            if y is not None and y[: best + 1] == x[: best + 1]:
                n = min(len(x), len(y))
                differ = int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])
                best = max(best, n - (differ.bit_length() + 7) // 8)
        out.append(best)
    return pa.array(out, pa.int32())


def extensions(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, t, run, left, more): by how many bytes the ends of runs go on like the text around another occurrence.

    Among all occurrences of the chunk at the end of a run, sorted by the bytes that follow (or precede, backwards), the one that has
    most in common with it is a neighbour. Ends that have all `width` bytes in common are compared over more of them.
    """
    ends = rows.filter("head and start > 0").select("digest", F.lit(True).alias("left")).union(rows.filter("tail").select("digest", F.lit(False)))
    pos = F.when(F.col("left"), F.col("start")).otherwise(F.col("start") + F.col("size"))
    spots = rows.join(ends.distinct(), "digest").select("doc_id", "t", "run", "digest", "left", F.when(F.col("left"), F.col("head")).otherwise(F.col("tail")).alias("target"), pos.alias("pos"))
    width, found = MAX_CHUNK, None
    while True:
        order = Window.partitionBy("digest", "left").orderBy("context")
        near = _with_context(texts, spots, width).withColumns({"before": F.lag("context").over(order), "after": F.lead("context").over(order)}).filter("target")
        got = written(near.select("doc_id", "t", "run", "digest", "left", _common("context", "before", "after").alias("more")), "extensions")
        found = got if found is None else found.union(got)
        further = got.filter(F.col("more") == width).select("digest", "left").distinct()
        if further.isEmpty():
            return found.drop("digest")
        spots, width = spots.join(further, ["digest", "left"], "left_semi"), 8 * width


def _spans(docs: DataFrame, min_span: int) -> DataFrame:
    """(doc_id, t, start, end, n_chunks, n_copies, first_doc_id): t is the text's hash."""
    all_ = written(chunks(docs), "chunks")
    first = F.min(F.struct("doc_id", "t", "start"))
    shared = written(all_.groupBy("digest", "size").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).filter("n > 1").select("digest", "size", "first"), "digests")
    found = all_.join(shared, ["digest", "size"]).select("doc_id", "t", "start", "size", "digest", F.col("first.doc_id").alias("first_doc_id"), (F.struct("doc_id", "t", "start") != F.col("first")).alias("copy")).distinct()
    by_doc = Window.partitionBy("doc_id", "t").orderBy("start")
    end = F.col("start") + F.col("size")
    head = F.coalesce(F.lag(end).over(by_doc) != F.col("start"), F.lit(True))
    tail = F.coalesce(F.lead("start").over(by_doc) != end, F.lit(True))
    rows = found.withColumns({"head": head, "tail": tail}).withColumn("run", F.sum(F.col("head").cast("long")).over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    rows = written(rows, "runs")
    more = extensions(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").filter("text <> ''"), rows)
    nothing = F.lit(None)
    parts = rows.select("doc_id", "t", "run", F.col("start").cast("long"), end.cast("long").alias("end"), F.lit(1).cast("long").alias("n_chunks"), F.col("copy").cast("long").alias("n_copies"), "first_doc_id", F.lit(0).alias("before"), F.lit(0).alias("after"))
    parts = parts.union(more.select("doc_id", "t", "run", nothing.cast("long"), nothing.cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), nothing.cast("long"), F.when(F.col("left"), F.col("more")).otherwise(0), F.when(F.col("left"), 0).otherwise(F.col("more"))))
    total = [F.sum("n_chunks").alias("n_chunks"), F.sum("n_copies").alias("n_copies"), F.min("first_doc_id").alias("first_doc_id")]
    runs = parts.groupBy("doc_id", "t", "run").agg((F.min("start") - F.max("before")).alias("start"), (F.max("end") + F.max("after")).alias("end"), *total)
    # Extended runs may meet.
    by_doc = Window.partitionBy("doc_id", "t").orderBy("start", "run")
    apart = F.coalesce(F.col("start") > F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = runs.withColumn("apart", apart.cast("long")).withColumn("run", F.sum("apart").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("doc_id", "t", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), *total)
    return spans.filter(F.col("end") - F.col("start") >= min_span).drop("run")


def repeated_spans(docs: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """(doc_id, start, end, n_chunks, n_copies, first_doc_id): the repeated spans of each document.

    n_copies counts the chunks that occurred before; a span without any is the first of its kind, and `deduplicated` drops those whose chunks all did.
    """
    return _spans(docs, min_span).drop("t")


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Each text without its (start, end) spans of bytes, moved inwards to whole characters."""
    out = []
    for text, held in zip(texts.to_pylist(), spans.to_pylist()):
        if text is None or not held:
            out.append(text)
            continue
        data, parts, at = text.encode(), [], 0
        for span in held:
            start, end = span["start"], span["end"]
            while start < len(data) and data[start] & 0xC0 == 0x80:
                start += 1
            while at < end < len(data) and data[end] & 0xC0 == 0x80:
                end -= 1
            if start < end:
                parts.append(data[at:start])
                at = end
        out.append(b"".join([*parts, data[at:]]).decode())
    return pa.array(out, pa.string())


def deduplicated(docs: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """`docs` with all their columns, and texts without the spans whose chunks all occurred before; spans that are copied in part stay."""
    copied = _spans(docs, min_span).filter("n_copies = n_chunks")
    lists = copied.groupBy(F.col("doc_id").alias("s_doc_id"), F.col("t").alias("s_t")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    out = rows.join(lists.hint("shuffle_hash"), F.col("row.doc_id").cast("long").eqNullSafe(F.col("s_doc_id")) & (F.xxhash64("row.text") == F.col("s_t")), "left")
    return out.select(*[F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(_without("row.text", "spans")).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(documents(spark, sf_dir))
