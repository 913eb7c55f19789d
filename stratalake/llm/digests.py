"""Document fingerprints from improbable features.

Every window of WINDOW bytes has an entropy. How often each (quantised) entropy occurs is counted over the whole
corpus, and the rarer a window's entropy, the better its rank. Among any RUN neighbouring windows the best one
scores a point; windows with POINTS or more are a document's features. They are inserted, in order, into a chain of Bloom
filters of FILTER_BYTES bytes with at most FEATURES features each. Two fingerprints are compared by the bits that their
filters share, less those expected by chance, over the most that they could share: each filter of the shorter chain
against its best match in the other one.

Defined results: a null text is empty; an empty text has the empty fingerprint, which is like another empty one (1) and
unlike all else (0); a text of less than WINDOW bytes is one feature; null ids come first in the order of documents; rows that
share a doc_id follow each other by the hash of their texts; a table of one row is followed by itself; a very long text is a slice of its own
and needs some 60 bytes of memory for each of its own, its filters are compared in blocks of PAIRS, and the time of that grows with the product
of both chains; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from base64 import b64encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm import kernels as K
from stratalake.llm.tables import documents, small, written

WINDOW, RUN, POINTS = 64, 64, 16
FILTER_BYTES, FEATURES, HASHES = 256, 160, 5
BINS = 1000
#: Bytes of text in a range of ids, about, the most ranges, and the bytes of a bucket, into which ranges are split where they hold more.
RANGE_BYTES, RANGES, BUCKET_BYTES = 1 << 20, 1000, 8 << 20
#: How many pairs of filters are compared at once (33 MB).
PAIRS = 1 << 17
SLICE_BYTES = 1 << 20
_BLOCK = 1 << 16
_SCALE = 1 << 16
_N = np.arange(WINDOW + 1)
_SUM = np.round(_SCALE * _N * np.log2(np.maximum(_N, 1))).astype(np.int64)
#: What the n + 1st equal byte adds to a window's sum of n log2 n, and the largest such sum.
_STEP, _MOST = np.diff(_SUM), int(_SUM[-1])
OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The quantised entropy of the window that begins at each byte (BINS: all bytes equal; 0: all differ).

    The sum of n log2 n over a window's bytes is kept as whole numbers that come and go with the bytes, so that equal
    windows have equal sums wherever they stand.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    edge = WINDOW - 1
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for at in range(0, n, _BLOCK):
        low, high = max(0, at - edge), min(n, at + _BLOCK + edge)
        part = data[low:high]
        b, a = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        same = np.empty(len(part), bool)
        for k in range(1, min(WINDOW, len(part))):
            equal = np.equal(part[k:], part[:-k], out=same[k:]).view(np.uint8)
            b[k:] += equal
            a[:-k] += equal
        end = min(n, at + _BLOCK)
        before[at:end], after[at:end] = b[at - low : end - low], a[at - low : end - low]
    change = _STEP[before]
    change[WINDOW:] -= _STEP[after[:-WINDOW]]
    # The first bytes have no full window; what came before them is not there.
    total = np.cumsum(change)[edge:]
    return total * BINS // _MOST


def _inside(offsets: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of the first n starts have `width` items inside their document."""
    length = np.diff(offsets)
    left = np.repeat(offsets[1:], length) - np.arange(offsets[-1])
    return left[:n] >= width


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all features in order, and the document of each."""
    chosen = np.zeros(len(data), bool)
    lengths = np.diff(offsets)
    bins = entropy_bins(data)
    if len(bins):
        valid = _inside(offsets, WINDOW, len(bins))
        # Best rank first, then the leftmost; windows across documents come last.
        key = np.where(valid, rank[bins], BINS + 2) * np.int64(1 << 40) + np.arange(len(bins))
        best, width = key, 1
        while width < RUN and len(best) > width:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        full = _inside(offsets, RUN + WINDOW - 1, len(best)) if width == RUN else np.zeros(0, bool)
        points = np.bincount((best[: len(full)][full] & ((1 << 40) - 1)), minlength=len(data))
        runs = np.maximum(lengths - (RUN + WINDOW - 2), 0)
        need = np.minimum(POINTS, np.maximum(runs, 1))
        chosen = points >= np.repeat(need, lengths)
        for d in np.flatnonzero((lengths >= WINDOW) & (runs <= 0)):  # fewer windows than a run
            chosen[offsets[d] : offsets[d + 1]] = False
            low, high = offsets[d], offsets[d + 1] - WINDOW + 1
            chosen[low + int(np.argmin(key[low:high]))] = True
    short = np.flatnonzero((lengths > 0) & (lengths < WINDOW))
    for d in short:
        chosen[offsets[d] : offsets[d + 1]] = False
    chosen[offsets[short]] = True
    starts = np.flatnonzero(chosen)
    own = np.searchsorted(offsets, starts, "right") - 1
    return K.span_hashes(data, starts, np.minimum(starts + WINDOW, offsets[own + 1])), own


def filters(hashes: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All filters, as rows of 64-bit words, and the index of each document's first one (with a closing total)."""
    order = np.lexsort((np.arange(len(own)), hashes, own))
    again = np.zeros(len(own), bool)
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
    hashes, own = hashes[~again], own[~again]
    count = np.bincount(own, minlength=n)
    place = np.arange(len(own)) - np.concatenate(([0], np.cumsum(count)))[own]
    first = np.concatenate(([0], np.cumsum(-(-count // FEATURES))))
    bits = np.zeros((int(first[-1]), FILTER_BYTES * 8), bool)
    row = first[own] + place // FEATURES
    for j in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * j)) & np.uint64(FILTER_BYTES * 8 - 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1).view(np.uint64) if len(bits) else np.zeros((0, FILTER_BYTES // 8), np.uint64), first


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of each text."""
    out: list[np.ndarray] = []
    for _, _, data, offsets in K.slices(pa.array(texts, pa.large_binary()), SLICE_BYTES):
        hashes, own = features(data, offsets, rank)
        rows, first = filters(hashes, own, len(offsets) - 1)
        out += [rows[first[d] : first[d + 1]] for d in range(len(offsets) - 1)]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1: how far the shared bits exceed what chance would share."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(b) < len(a):
        a, b = b, a
    nb = np.bitwise_count(b).sum(1, dtype=np.int64)[None, :]
    best = np.empty(len(a))
    rows = max(1, PAIRS // len(b))
    for at in range(0, len(a), rows):
        part = a[at : at + rows]
        na = np.bitwise_count(part).sum(1, dtype=np.int64)[:, None]
        shared = np.bitwise_count(part[:, None, :] & b[None, :, :]).sum(2, dtype=np.int64)
        chance, most = na * nb / (FILTER_BYTES * 8), np.minimum(na, nb)
        best[at : at + rows] = np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(1)
    return float(best.mean())


def rarity(docs: DataFrame) -> np.ndarray:
    """The rank of each entropy bin over all documents: 0 is the rarest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS + 1, np.int64)
        for batch in batches:
            for _, _, data, offsets in K.slices(batch.column(0), SLICE_BYTES):
                bins = entropy_bins(data)
                total += np.bincount(bins[_inside(offsets, WINDOW, len(bins))], minlength=BINS + 1) if len(bins) else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS + 1)), pa.array(total)], names=["bin", "n"])

    rows = docs.select("text").mapInArrow(count, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(BINS + 1, np.int64)
    for r in rows:
        total[r["bin"]] = r["n"]
    rank = np.empty(BINS + 1, np.int64)
    rank[np.lexsort((np.arange(BINS + 1), total))] = np.arange(BINS + 1)
    return rank


def _buckets(docs: DataFrame) -> DataFrame:
    """(a, sub, doc_id, t, text): ranges of the order (doc_id, t), null ids first, of about BUCKET_BYTES of text each.

    Quantiles of doc_id give a range for each RANGE_BYTES, RANGES at most; each is split, by its bytes, into equal widths of doc_id, or of t where all its ids are one.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    quantiles = F.percentile_approx(F.col("doc_id").cast("long"), [i / RANGES for i in range(1, RANGES)], 10_000)
    found, size = docs.agg(quantiles, F.sum(F.octet_length("text"))).first()
    wanted = min(RANGES, -(-(size or 0) // RANGE_BYTES))
    bounds = [found[i * RANGES // wanted - 1] for i in range(1, wanted)] if found else []
    edges = F.array(*map(F.lit, sorted(set(bounds)))).cast("array<bigint>")
    rows = rows.withColumn("a", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.size(F.filter(edges, lambda x: x < F.col("doc_id")))))
    parts = F.ceil(F.sum(F.octet_length("text")) / BUCKET_BYTES)
    stats = rows.groupBy("a").agg(F.greatest(F.lit(1), parts).alias("parts"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    rows = rows.join(F.broadcast(written(stats, "ranges")), "a")  # RANGES + 1 rows at most
    by_text = F.floor((F.col("t") * F.lit(2.0**-64) + 0.5) * F.col("parts"))
    by_id = F.floor((F.col("doc_id") - F.col("low")) / (F.col("high") - F.col("low") + F.lit(1.0)) * F.col("parts"))
    sub = F.least(F.when(F.col("low") < F.col("high"), by_id).otherwise(by_text), F.col("parts") - 1)
    return rows.select("a", sub.cast("long").alias("sub"), "doc_id", "t", "text")


def followed(docs: DataFrame) -> DataFrame:
    """(a, sub, guard, doc_id, text), dealt and sorted by bucket, so that each row is followed by the next document.

    The last document of a bucket is followed by a guard: a second copy of the first document of the next bucket that has any (of the first
    one, after the last).
    """
    rows = _buckets(docs)
    firsts = written(rows.groupBy("a", "sub").agg(F.min(F.struct("doc_id", "t")).alias("first")), "firsts")
    n = firsts.count()
    # The bucket before: within a range by its order, and across ranges by the last bucket of each.
    last = sorted(((r["a"], r["sub"]) for r in firsts.groupBy("a").agg(F.max("sub").alias("sub")).collect()))
    spark = docs.sparkSession
    across = spark.createDataFrame([(a, *last[i - 1]) for i, (a, _) in enumerate(last)], "l_a int, l_before int, l_sub bigint")
    order = Window.partitionBy("a").orderBy("sub")
    guards = firsts.withColumn("before", F.lag("sub").over(order)).join(F.broadcast(across), F.col("a") == F.col("l_a"))
    guards = guards.select(F.col("a").alias("g_a"), F.col("sub").alias("g_sub"), F.col("first.doc_id").alias("g_doc_id"), F.col("first.t").alias("g_t"), F.when(F.col("before").isNull(), F.col("l_before")).otherwise(F.col("a")).alias("b_a"), F.coalesce("before", "l_sub").alias("b_sub"))
    same = (F.col("a") == F.col("g_a")) & (F.col("sub") == F.col("g_sub")) & F.col("doc_id").eqNullSafe(F.col("g_doc_id")) & (F.col("t") == F.col("g_t"))
    joined = rows.join(small(written(guards, "guards")), same, "left")
    own = F.struct(F.col("a"), F.col("sub"), F.lit(0).alias("guard"))
    both = F.when(F.col("b_a").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("b_a").cast("int").alias("a"), F.col("b_sub").alias("sub"), F.lit(1).alias("guard"))))
    dealt = joined.select(F.explode(both).alias("at"), "doc_id", "t", "text").select("at.*", "doc_id", "t", "text")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 2)
    return dealt.repartition(parts, "a", "sub").sortWithinPartitions("a", "sub", "guard", F.asc_nulls_first("doc_id"), "t")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, and its likeness to its edited text's and to the next document's."""
    rank = rarity(docs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[tuple[int, int], int, int | None, str]]:
            for batch in batches:
                for start in range(0, batch.num_rows, 500):
                    part = batch.slice(start, 500)
                    yield from zip(zip(part.column(0).to_pylist(), part.column(1).to_pylist()), *(part.column(c).to_pylist() for c in (2, 3, 4)))

        def emit(group: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
            texts, edited = [], []
            for _, text, following in group:
                half = len(text) // 2
                edited.append((text[: len(text) - half] + following[:half]).encode())
                texts.append(text.encode())
            # A following text is the next one's own, but for the last of a bucket.
            alone = [i for i in range(len(group)) if i + 1 == len(group) or group[i][2] is not group[i + 1][1]]
            all_ = fingerprints(texts + edited + [group[i][2].encode() for i in alone], rank)
            own, new, last = all_[: len(group)], all_[len(group) : 2 * len(group)], dict(zip(alone, all_[2 * len(group) :]))
            columns = [
                pa.array([g[0] for g in group], pa.int64()),
                pa.array([len(g[1]) for g in group], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in edited]),
                pa.array([b64encode(x.tobytes()).decode() for x in own]),
                pa.array([b64encode(x.tobytes()).decode() for x in new]),
                pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
                pa.array([likeness(own[i], last[i] if i in last else own[i + 1]) for i in range(len(group))], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])

        pending, group, size = None, [], 0
        for bucket, guard, doc_id, text in rows():
            if pending and pending[0] == bucket:
                group.append((pending[1], pending[2], text))
                size += len(text)
            pending = None if guard else (bucket, doc_id, text)
            if size > SLICE_BYTES or len(group) > 2000:
                yield emit(group)
                group, size = [], 0
        if group:
            yield emit(group)

    return followed(docs).select("a", "sub", "guard", "doc_id", "text").mapInArrow(compare, OUT)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir))
