"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to ORDER bytes, counted on a bounded sample of its labelled
documents. A byte that was seen after a context costs -log2(c / (total + distinct)) bits there; otherwise the escape,
-log2(distinct / (total + distinct)), is paid and the next shorter context asked, down to an even distribution
over all 256 bytes. The statistics are frozen, so the exact code length of a byte depends on the ORDER bytes
before it alone. The trees of all languages are sorted lists of what was seen, so the model's size is that of the distinct runs of bytes in the
sample; a text is scored by looking up its distinct runs and adding up their lengths under each language.

The sample takes each labelled document with a probability, drawn by its id: about `sample_bytes` a language, and less where all languages together
would pass `total_bytes`, whatever the size of the input; whole texts only, and one document a language at least. Every label is learned.
The model holds at most (ORDER + 1) * total_bytes entries of 13 bytes (and those of the single documents), which bounds what is broadcast.

Defined results: null texts and texts without a letter are `und` with score 0; a null language teaches nothing;
without labelled text everything is `und`; rows that share a doc_id are scored on their own; a null doc_id is learned from and not held out; ties go to the
language that comes first by code point; a very long text is a slice of its own and needs some 60 bytes of memory for each of its own; other columns are
kept, but lang_pred and score are replaced if they are there; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import kernels as K
from stratalake.llm.tables import documents, small, written

ORDER = 3
SAMPLE_BYTES, TOTAL_BYTES = 1_500_000, 16_000_000
#: What stands before the first byte of every text.
START = "\n" * ORDER
SLICE_BYTES = 1 << 20


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def training_sample(docs: DataFrame, sample_bytes: int, total_bytes: int = TOTAL_BYTES) -> DataFrame:
    """(lang, text) of labelled documents that are not held out, about `sample_bytes` of each language, one document at least."""
    labelled = docs.select("doc_id", "lang", "text").filter("lang is not null and text <> ''").filter(F.coalesce(fold(F.col("doc_id")) != 2, F.lit(True)))
    size = F.octet_length("text")
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", size), 11) * F.lit(2.0**-53)
    labelled = labelled.withColumns({"drawn": drawn, "long": size > sample_bytes})
    totals = written(labelled.groupBy(F.col("lang").alias("r_lang")).agg(F.sum(size).alias("bytes"), F.min(F.struct("long", "drawn")).alias("least")), "languages")
    share = min(sample_bytes, total_bytes / max(totals.count(), 1))
    # A few long documents may all be missed; the one with the smallest draw stands for them, a short one if there is any.
    chosen = (F.col("drawn") < F.lit(float(share)) / F.col("bytes")) | (F.struct("long", "drawn") == F.col("least"))
    return labelled.join(small(totals), F.col("lang") == F.col("r_lang")).filter(chosen).select("lang", "text")


def gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """(lang, size, gram, n): how often each run of 1 to order + 1 bytes occurs, the run packed into a number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for at, end, data, offsets in K.slices(batch.column(1), SLICE_BYTES):
                keep = np.ones(len(data), bool)
                for j in range(order):  # the bytes of the start are contexts, not symbols
                    keep[np.minimum(offsets[:-1] + j, len(data) - 1)] = False
                own = langs[at:end][np.searchsorted(offsets, np.flatnonzero(keep), "right") - 1]
                names, index = np.unique(own.astype(str), return_inverse=True)
                code = np.zeros(len(data), np.int64)
                for size in range(1, order + 2):
                    back = size - 1
                    code[back:] |= data[: len(data) - back].astype(np.int64) << (8 * back)
                    grams, n = np.unique(code[keep] | (index.astype(np.int64) << 40), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(names[grams >> 40].tolist(), pa.string()), pa.array(np.full(len(grams), size, np.int32)), pa.array(grams & ((1 << 40) - 1)), pa.array(n.astype(np.int64))], names=["lang", "size", "gram", "n"])

    padded = sample.select("lang", F.concat(F.lit(START), F.col("text")).alias("text"))
    return padded.mapInArrow(count, "lang string, size int, gram bigint, n bigint").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


class Lists:
    """For sorted keys, a list of (language, bits) each."""

    def __init__(self, key: np.ndarray, lang: np.ndarray, bits: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.keys, first = np.unique(key[order], return_index=True)
        self.first = np.append(first, len(key)).astype(np.int64)
        self.lang, self.bits = lang[order].astype(np.int32), bits[order].astype(np.float32)

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place among `asked`, the language and the bits of all that is listed for it."""
        at = np.minimum(np.searchsorted(self.keys, asked), max(len(self.keys) - 1, 0))
        hit = np.flatnonzero(self.keys[at] == asked) if len(self.keys) else np.zeros(0, np.int64)
        n = self.first[at[hit] + 1] - self.first[at[hit]]
        item = np.repeat(self.first[at[hit]] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.repeat(hit, n), self.lang[item], self.bits[item]


class Model:
    """Code lengths of bytes after contexts, for every language at once."""

    def __init__(self, counts: pa.Table, order: int):
        self.order = order
        self.langs = sorted(set(counts.column("lang").to_pylist()))
        names = counts.column("lang").combine_chunks().dictionary_encode()
        place = {x: i for i, x in enumerate(self.langs)}
        lang = np.array([place[x] for x in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy()]
        size, gram, n = (counts.column(c).to_numpy() for c in ("size", "gram", "n"))
        #: For each size of context: what a byte costs after it, and what the escape does.
        self.seen, self.escape = [], []
        for k in range(order + 1):
            pick = size == k + 1
            g, own, c = gram[pick], lang[pick], n[pick].astype(np.float64)
            context, row = np.unique((g >> 8) * len(self.langs) + own, return_inverse=True)
            total, distinct = np.bincount(row, c), np.bincount(row).astype(np.float64)
            self.seen.append(Lists(g, own, -np.log2(c / (total + distinct)[row])))
            self.escape.append(Lists(context // len(self.langs), context % len(self.langs), -np.log2(distinct / (total + distinct))))
        self.nbytes = sum(x.keys.nbytes + x.first.nbytes + x.lang.nbytes + x.bits.nbytes for x in self.seen + self.escape)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """What the last byte of each run of order + 1 bytes costs under each language."""
        out = np.full((len(grams), len(self.langs)), 8.0)
        for k in range(self.order + 1):
            mask = (1 << (8 * (k + 1))) - 1
            at, lang, cost = self.escape[k].find((grams & mask) >> 8)
            out[at, lang] += cost
            at, lang, cost = self.seen[k].find(grams & mask)
            out[at, lang] = cost
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bits of each text (which begins with START) under each language."""
        code, scored = np.zeros(len(data), np.int64), np.ones(len(data), bool)
        for j in range(self.order + 1):
            code[j:] |= data[: len(data) - j].astype(np.int64) << (8 * j)
        for j in range(self.order):
            scored[offsets[:-1] + j] = False
        grams, place = np.unique(code[scored], return_inverse=True)
        ends = offsets[1:] - self.order * np.arange(1, len(offsets))
        starts = np.concatenate(([0], ends[:-1]))
        full, out = starts < ends, np.zeros((len(starts), len(self.langs)))
        if full.any():
            out[full] = np.add.reduceat(self.bits(grams)[place], starts[full], axis=0)
        return out


def train(docs: DataFrame, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """The model, from counts that hold at most (order + 1) * TOTAL_BYTES entries."""
    counts = written(gram_counts(training_sample(docs, sample_bytes), order), "grams").toArrow()
    return Model(counts, order) if counts.num_rows else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with lang_pred and score: the language of the shortest code, and its probability if all are as likely."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(texts: pa.Array) -> pa.Array:
        m, langs, scores = kept.value, [], []
        # With many languages, slices are shorter.
        for _, _, data, offsets in K.slices(texts, min(SLICE_BYTES, (SLICE_BYTES << 4) // len(m.langs))):
            bits = m.code_lengths(data, offsets)
            best = bits.argmin(axis=1)
            gap = np.minimum(bits - bits[np.arange(len(bits)), best][:, None], 1000)
            langs += [m.langs[x] for x in best]
            scores.append(1 / np.exp2(-gap).sum(axis=1))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["lang_pred", "score"])

    predict = predict.asNondeterministic()  # not to be repeated for each of its fields
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    padded = F.concat(F.lit(START), F.coalesce("text", F.lit("")))
    found = predict(padded) if model else F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    out = docs.withColumns({"_found": found, "_known": known})
    return out.withColumns({"lang_pred": F.when(F.col("_known"), F.col("_found.lang_pred")).otherwise("und"), "score": F.when(F.col("_known"), F.col("_found.score")).otherwise(0.0)}).drop("_found", "_known")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identify(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
