"""Ranked lexical search of a set of queries over all documents, by bags of words: documents that no query can tell apart are scored once.

Queries are taken in blocks by a hash of their id, of about BLOCK_BYTES of text each, so that a block's vocabulary fits a task whatever their number.
Documents are reduced to their bag: how often they hold the terms of the vocabulary, and their length measure m. Equal bags with equal m are a class (grouped by a hash, told apart by
all their values), which gets one score for each query. Every task keeps the k best classes a query, with ties by the smallest
id of the class. A document among the k best is in one of the k best classes, as each better class has a better document; so these are
the only ones that are expanded, each to its k smallest ids at most.

The weights: N counts the documents with a term, L all terms, n those of a document, df the documents that hold a term, tf how often a document does. A term weighs
floor(1000 * ln((2N + 2) / (2df + 1))); m is 100 - B + B * n * N div L, and a score sums weight * ((10^9 * tf) div (1000 * tf + 8 * m)).

Defined results: a null or empty text has no terms and is never found, nor does such a query find anything; rows that share a doc_id are documents of their own;
null ids come last among equal scores; texts that share a query id are one query with the terms of all; a query's terms count once;
other columns are ignored, whatever their names; texts of any length are read whole; one query's terms are held by every task; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm import kernels
from stratalake.llm.tables import documents, small, written

#: The share of a document's length, in percent, in its measure m.
B = 90
#: Bytes of queries that are scored together.
BLOCK_BYTES = 4 << 20
#: Scores of a batch held at a time.
CELLS = 1 << 20
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
BAG = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of a slice of texts, A-Z in lower case, and the index of each text's first one (with a closing total)."""
    is_term = IS_TERM[data]
    starts, ends = kernels.spans(is_term, offsets)
    at = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(kernels.LOWER[data[is_term]])])
    return words, np.searchsorted(starts, offsets).astype(np.int64)


def query_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of each query."""
    typed = items.select(F.col(key).alias("item"), F.col(text).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in kernels.slices(batch.column(1)):
                words, first = _terms(data, offsets)
                own = pa.array(kernels.owner(first) + a)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), words.cast(pa.large_string()).cast(pa.string())], names=["item", "term"])

    return typed.mapInArrow(split, f"item {typed.schema['item'].dataType.simpleString()}, term string").distinct()


def bags(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(doc_id, n, terms, tfs) of each row: all its terms, and how often it holds those of the vocabulary, by their places there."""
    size = max(len(vocabulary), 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in kernels.slices(batch.column(1)):
                words, first = _terms(data, offsets)
                place = pc.index_in(words, value_set=vocabulary)
                hit = place.is_valid().to_numpy(zero_copy_only=False)
                own, place = kernels.owner(first)[hit], place.drop_null().to_numpy()
                pairs, tfs = np.unique(own * size + place, return_counts=True)
                at = pa.array(np.searchsorted(pairs, np.arange(b - a + 1) * size).astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in ((pairs % size).astype(np.int32), tfs.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(first)), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, BAG)


class Block:
    """The terms of a block of queries, as a table of which term is in which query, split into common and rare terms."""

    def __init__(self, pairs: pa.Table):
        ids = pairs["item"].combine_chunks().dictionary_encode(null_encoding="encode")
        self.items, item = ids.dictionary, ids.indices.to_numpy()
        words = pairs["term"].combine_chunks().dictionary_encode()
        self.vocabulary, term = words.dictionary.cast(pa.large_binary()), words.indices.to_numpy()
        in_items = np.bincount(term, minlength=len(self.vocabulary))
        self.longest = int(np.bincount(item).max(initial=0))
        # A term of many queries is a row of a matrix; the others keep lists of their queries.
        self.common = np.flatnonzero(in_items > max(4, len(self.items) // 16))
        self.row = np.full(len(self.vocabulary), -1, np.int64)
        self.row[self.common] = np.arange(len(self.common))
        self.matrix = np.zeros((len(self.common), len(self.items)))
        self.matrix[self.row[term[self.row[term] >= 0]], item[self.row[term] >= 0]] = 1
        order = np.argsort(term, kind="stable")
        self.listed, self.starts = item[order], np.concatenate(([0], np.cumsum(in_items)))

    def scores(self, own: np.ndarray, terms: np.ndarray, parts: np.ndarray, rows: int) -> np.ndarray:
        """The scores (rows x items) of bags, given each of their terms' part; sums beyond a double's whole numbers are taken in integers."""
        common = self.row[terms] >= 0
        exact = self.longest * int(parts.max(initial=0)) < 1 << 53
        kind = np.float64 if exact else np.int64
        dense = np.zeros((rows, len(self.common)), kind)
        dense[own[common], self.row[terms[common]]] = parts[common]
        out = (dense @ self.matrix.astype(kind, copy=False)).astype(np.int64)
        own, terms, parts = own[~common], terms[~common], parts[~common]
        n = self.starts[terms + 1] - self.starts[terms]
        before = np.cumsum(n) - n
        at = np.repeat(self.starts[terms] - before, n) + np.arange(n.sum())
        np.add.at(out.reshape(-1), np.repeat(own * len(self.items), n) + self.listed[at], np.repeat(parts, n))
        return out


def best_classes(classes: DataFrame, block: Block, weights: np.ndarray, k: int) -> DataFrame:
    """(item, score, first_id, class): the k best classes of each query that a task saw, by score, then by their smallest id."""
    width = len(block.items)
    step = max(1, CELLS // max(width, 1))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = {c: np.zeros(0, np.int64) for c in ("item", "score", "missing", "first", "class")}
        least = np.ones(width, np.int64)
        for batch in batches:
            ids, m, firsts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            missing, firsts = firsts.is_null().to_numpy(zero_copy_only=False).astype(np.int64), firsts.fill_null(0).to_numpy()
            for a in range(0, batch.num_rows, step):
                b = min(a + step, batch.num_rows)
                lists = [batch.column(i).slice(a, b - a) for i in (3, 4)]
                own = np.repeat(np.arange(b - a), pc.list_value_length(lists[0]).to_numpy())
                terms, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
                score = block.scores(own, terms, weights[terms] * (10**9 * tf // (1000 * tf + 8 * m[a:b][own])), b - a)
                row, item = np.nonzero(score >= least)
                new = {"item": item, "score": score[row, item], "missing": missing[a:b][row], "first": firsts[a:b][row], "class": ids[a:b][row]}
                top = {c: np.concatenate((top[c], new[c])) for c in top}
                order = np.lexsort((top["class"], top["first"], top["missing"], -top["score"], top["item"]))
                top = {c: v[order] for c, v in top.items()}
                starts = np.searchsorted(top["item"], np.arange(width + 1))
                place = np.arange(len(order)) - starts[top["item"]]
                full = np.flatnonzero(np.diff(starts) >= k)
                least[full] = top["score"][starts[full] + k - 1]
                top = {c: v[place < k] for c, v in top.items()}
        first = pa.array(top["first"], mask=top["missing"] > 0)
        yield pa.RecordBatch.from_arrays([pa.array(top["item"]), pa.array(top["score"]), first, pa.array(top["class"])], names=["item", "score", "first_id", "class"])

    return classes.select("class", "m", "first_id", "terms", "tfs").mapInArrow(best, "item bigint, score bigint, first_id bigint, class bigint")


def _first(df: DataFrame, group: list[str], order: list, k: int, name: str) -> DataFrame:
    """The first k rows of each group; Spark drops the others of a task before they are shuffled."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(name) <= k)


def _search(docs: DataFrame, block: Block, k: int) -> DataFrame:
    spark = docs.sparkSession
    found = written(bags(docs, block.vocabulary), "bags")
    n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()  # a row a term of the block
    df = np.zeros(len(block.vocabulary), np.int64)
    df[counts["term"].to_numpy()] = counts["df"].to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    measure = F.expr(f"cast({100 - B} + (cast({B} * n as decimal(19, 0)) * cast({n_docs} as decimal(19, 0))) div cast({max(n_terms, 1)} as decimal(19, 0)) as bigint)")
    held = found.filter(F.size("terms") > 0).select("doc_id", measure.alias("m"), F.xxhash64("terms", "tfs").alias("h"), "terms", "tfs")
    classes = held.groupBy("h", "m", "terms", "tfs").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("members"))
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    best = best_classes(classes, block, weights, k)
    best = written(_first(best, ["item"], [F.desc("score"), F.asc_nulls_last("first_id"), "class"], k, "place").select("item", "score", "class"), "best-classes")
    few = small(classes.join(small(best.select("class").distinct()), "class", "left_semi").select("class", F.col("h").alias("c_h"), F.col("m").alias("c_m"), F.col("terms").alias("c_terms"), F.col("tfs").alias("c_tfs")))
    same = (F.col("h") == F.col("c_h")) & (F.col("m") == F.col("c_m")) & (F.col("terms") == F.col("c_terms")) & (F.col("tfs") == F.col("c_tfs"))
    members = _first(held.join(few, same).select("class", "doc_id"), ["class"], [F.asc_nulls_last("doc_id")], k, "place").select("class", "doc_id")
    ranked = _first(written(members, "members").join(small(best), "class"), ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, "rank")
    names = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(block.items))), "item_id": block.items}))
    return ranked.join(small(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each query with a score above 0."""
    spark = docs.sparkSession
    size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = -(-size // block_bytes)
    pairs = written(query_terms(items, key, text).withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1)))), "query-terms")
    out = spark.createDataFrame([], f"item_id {items.schema[key].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    for b in range(blocks):
        own = pairs.filter(F.col("block") == b).select("item", "term").toArrow()  # the terms of a block
        if own.num_rows:
            out = out.union(_search(docs, Block(own), k))
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"
OP11_SQL = f"""
with d as (select doc_id, len({_WORDS}) as n, {_WORDS} as words from documents), s as (select count(*) as docs, sum(n)::bigint as total from d where n > 0),
q as (select distinct item_id, unnest({_WORDS}) as term from benchmark), v as (select distinct term from q),
p as (select doc_id, n, term, count(*) as tf from (select doc_id, n, unnest(words) as term from d) e where term in (select term from v) group by all),
w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::double))::bigint as weight from (select term, count(*) as df from p group by 1) f, s),
r as (select item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * ({100 - B} + ({B} * n * docs) // total))))::bigint as score from p join w using (term) join q using (term), s group by 1, 2)
select item_id, rank::int as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from r where score > 0) o where rank <= 10
"""
