"""Language-model scores by stupid backoff, from counts over the whole corpus without the scored document.

A word is scored by its relative frequency after the ORDER - 1 words before it, or, where no other document has that n-gram, by
BACKOFF times its score after one word less; a word of no other document counts as half an occurrence.

The plan is two keyed exchanges around a count table. Documents are dealt to chunks by a hash; a chunk's distinct n-grams are exploded
to the buckets of their hashes, nested as one row for each chunk and bucket (sorted keys, counts). Each bucket is a part of the count
table: it sums its n-grams and joins the sums to every row that has them. What comes back meets the chunk's documents by a cogroup on the
chunk, and each document's scores are summed. A frequent n-gram is one entry of each chunk, so no bucket grows with it; a
chunk's rows are never more than its n-grams. `ngram_counts` gives the same table as plain rows.

Defined results: null texts and texts without words have no words and score null; every row is a document of its own, so
equal texts and repeated rows see each other; a null doc_id is kept; a text longer than CHUNK_BYTES makes its chunk longer and needs
some 60 bytes of memory for each of its own; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import kernels as K
from stratalake.llm.tables import documents

ORDER, BACKOFF = 3, 0.4
#: Bytes of text in a chunk and in a bucket of the counts (of its n-grams' texts), about.
CHUNK_BYTES, BUCKET_BYTES = 6 << 20, 6 << 20
#: Bits of an n-gram's key; differences of sorted keys are what the shuffle carries.
KEY_BITS = 58
#: The key of the empty n-gram, which is the context of single words; no other n-gram has it.
EMPTY = np.uint64(0)
_GROW, _DROP = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - KEY_BITS)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all words, and the index of each text's first one (with a closing total)."""
    codes, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, data, offsets in K.slices(texts):
        starts, ends, first = K.words(data, offsets)
        codes.append(np.maximum(K.span_hashes(data, starts, ends) >> _DROP, np.uint64(1)))
        lengths.append(np.diff(first))
    return np.concatenate(codes), np.concatenate(([0], np.cumsum(np.concatenate(lengths))))


def ngrams(codes: np.ndarray, first: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For sizes 1 to `order`: the keys of all n-grams, and the index of each text's first one."""
    own, out, longer = K.owner(first), [(codes, first)], codes
    for n in range(2, order + 1):
        longer = np.maximum(K.mix(longer[:-1] * _GROW + codes[n - 1 :]) >> _DROP, np.uint64(1))
        out.append((longer[own[: len(longer)] == own[n - 1 :]], np.concatenate(([0], np.cumsum(np.maximum(np.diff(first) - (n - 1), 0))))))
    return out


def _distinct(grams: list[tuple[np.ndarray, np.ndarray]], inverse: bool = False) -> tuple[np.ndarray, ...]:
    """The sorted distinct keys of a chunk, the empty n-gram first, (the place of each n-gram among them,) and their counts."""
    keys, *place, counts = np.unique(np.concatenate([codes for codes, _ in grams]), return_inverse=inverse, return_counts=True)
    return np.concatenate(([EMPTY], keys)), *(p + 1 for p in place), np.concatenate(([len(grams[0][0])], counts))


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all low bytes first, compressed: the high ones are mostly zero."""
    return zstandard.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _low(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The smallest key of each bucket."""
    return np.array([-(-(int(b) << KEY_BITS) // buckets) for b in bucket], np.uint64)


def chunked(docs: DataFrame) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text) of all rows, and the number of buckets for their n-grams."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(-(-size // CHUNK_BYTES) or 1))
    return docs.select(chunk.alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), -(-size // BUCKET_BYTES) or 1


def exploded(chunks: DataFrame, order: int, buckets: int) -> DataFrame:
    """(bucket, chunk, keys, counts): the distinct n-grams of each chunk, by the bucket of their keys."""

    def explode(group: pa.Table) -> pa.Table:
        keys, counts = _distinct(ngrams(*words(group.column("text")), order))
        edges = np.searchsorted(keys, _low(np.arange(buckets), buckets)).tolist() + [len(keys)]
        held = [b for b in range(buckets) if edges[b] < edges[b + 1]]
        low = _low(np.array(held), buckets)
        # Differences of sorted keys have fewer bytes than the keys.
        steps = [_packed(np.diff(keys[edges[b] : edges[b + 1]], prepend=low[i])) for i, b in enumerate(held)]
        return pa.table([pa.array(held, pa.int32()), pa.repeat(group.column("chunk")[0], len(held)), pa.array(steps, pa.binary()), pa.array([_packed(counts[edges[b] : edges[b + 1]]) for b in held], pa.binary())], names=["bucket", "chunk", "keys", "counts"])

    return chunks.groupBy("chunk").applyInArrow(explode, "bucket int, chunk bigint, keys binary, counts binary")


def elsewhere(grams: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, others): for each key of each row of `grams`, its count in all other chunks."""

    def join(group: pa.Table) -> pa.Table:
        low = _low(np.array([group.column("bucket")[0].as_py()]), buckets)
        keys = [np.cumsum(_numbers(x.as_py())) + low for x in group.column("keys")]
        counts = [_numbers(x.as_py()).astype(np.int64) for x in group.column("counts")]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts_ = np.concatenate(counts)
        total = np.zeros(int(place.max(initial=-1)) + 1, np.int64)
        np.add.at(total, place, counts_)
        others = np.split(total[place] - counts_, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table([group.column("bucket"), group.column("chunk"), pa.array([_packed(x) for x in others], pa.binary())], names=["bucket", "chunk", "others"])

    return grams.groupBy("bucket").applyInArrow(join, "bucket int, chunk bigint, others binary")


def _left(grams: list[tuple[np.ndarray, np.ndarray]], place: np.ndarray, totals: np.ndarray) -> list[np.ndarray]:
    """For each n-gram of a chunk, its count in all documents but its own."""
    left = np.zeros(len(place), np.int64)
    again = np.flatnonzero(totals[place] > 1)  # the others are nowhere else
    pair = np.concatenate([K.owner(first) for _, first in grams])[again] * len(totals) + place[again]
    _, back, count = np.unique(pair, return_inverse=True, return_counts=True)
    left[again] = totals[place[again]] - count[back]
    return np.split(left, np.cumsum([len(codes) for codes, _ in grams])[:-1])


def scored(chunks: DataFrame, others: DataFrame, order: int) -> DataFrame:
    def score(group: pa.Table, found: pa.Table) -> pa.Table:
        grams = ngrams(*words(group.column("text")), order)
        _, kind, counts = _distinct(grams, True)
        parts = dict(zip(found.column("bucket").to_pylist(), found.column("others")))
        totals = counts + np.concatenate([_numbers(parts[b].as_py()) for b in sorted(parts)]).astype(np.int64)
        first = grams[0][1]
        length, own = np.diff(first), K.owner(first)
        value, shorter, before = np.zeros(len(own)), None, first
        # The size of the longest n-gram that could end at each word, less one: so often does a single word step down.
        steps = np.minimum(np.arange(len(own)) - first[own], order - 1)
        for n, (count, (_, at)) in enumerate(zip(_left(grams, kind, totals), grams), 1):
            doc = K.owner(at)
            index = np.arange(len(count)) - at[doc]
            if n == 1:  # after the empty n-gram, whose count is that of all words
                value = np.log(np.maximum(count, 0.5) / np.maximum(totals[0] - length, 1)[own]) + steps * np.log(BACKOFF)
            else:
                seen = count > 0
                place = (index + first[doc] + n - 1)[seen]
                value[place] = np.log(count[seen] / shorter[(index + before[doc])[seen]]) + (steps[place] - (n - 1)) * np.log(BACKOFF)
            shorter, before = count, at
        sums = np.bincount(own, value, len(length))
        none = length == 0
        return pa.table([group.column("doc_id"), pa.array(length.astype(np.int64)), pa.array(sums, mask=none), pa.array(sums / np.maximum(length, 1), mask=none)], names=["doc_id", "n_words", "log_score", "mean_log_score"])

    return chunks.groupBy("chunk").cogroup(others.groupBy("chunk")).applyInArrow(score, "doc_id bigint, n_words bigint, log_score double, mean_log_score double")


def backoff_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of each row: natural logarithms, summed and a word.

    Up to order - 1 words before a word count.
    """
    chunks, buckets = chunked(docs)
    return scored(chunks, elsewhere(exploded(chunks, order, buckets), buckets), order)


def ngram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(n, key, total): the counts of all n-grams of 1 to `order` words, as rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, (codes, _) in enumerate(ngrams(*words(batch.column(0)), order), 1):
                keys, counts = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), n, np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)], names=["n", "key", "total"])

    return docs.select("text").mapInArrow(count, "n int, key bigint, total bigint").groupBy("n", "key").agg(F.sum("total").alias("total"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = backoff_scores(documents(spark, sf_dir), ORDER)
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


OP2_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as (select doc_id, len(ws) as n, i, ws[i] as g1, case when i > 1 then ws[i - 1] || ' ' || ws[i] end as g2,
    case when i > 2 then ws[i - 2] || ' ' || ws[i - 1] || ' ' || ws[i] end as g3 from w, unnest(range(1, len(ws) + 1)) r(i)),
c as (select doc_id, n, i, count(*) over (partition by g1) - count(*) over (partition by doc_id, g1) as l1,
    case when i > 1 then count(*) over (partition by g2) - count(*) over (partition by doc_id, g2) else 0 end as l2,
    case when i > 2 then count(*) over (partition by g3) - count(*) over (partition by doc_id, g3) else 0 end as l3, count(*) over () as total from p),
b as (select *, lag(l1) over (partition by doc_id order by i) as k1, lag(l2) over (partition by doc_id order by i) as k2 from c),
t as (select doc_id, sum(case when l3 > 0 then ln(l3 / k2) when l2 > 0 then ln(l2 / k1) + least(i - 2, 1) * ln(0.4)
    else ln(greatest(l1, 0.5) / greatest(total - n, 1)) + least(i - 1, 2) * ln(0.4) end) as s from b group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, round(s, 4) as log_score, round(s / len(ws), 6) as mean_log_score from w left join t on w.doc_id = t.doc_id
"""
