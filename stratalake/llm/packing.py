"""Best-fit packing of tokenised documents into sequences, after a dominance reduction.

Only lengths matter to a packing, and there are at most `capacity` of them, so the plan is made from the
histogram of lengths, whose size does not depend on the corpus. It first fixes every set that provably
dominates all other sets with the same item (Martello and Toth): two lengths that fill a sequence, an item with
which nothing fits, and the best companions where at most one or two fit. What is left is packed by best fit,
longest first. The plan says, for the r-th piece of a length, its sequence and place; ranks within a length
are made in as many groups as a group has pieces, drawn at random when the pieces are written, with the groups' offsets: the n pieces of a
common length are no hot key, as neither a group nor the list of groups has more than about the root of n.

Defined results: a null text is empty and is the one id 0; rows that share a doc_id, and repeated rows, are documents of their own;
a null doc_id is kept; ties in length are packed in any order; a very long text is encoded as a whole; other columns are ignored, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from base64 import b64decode
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import documents, small, written

CAPACITY = 2048
END = array("I", [0]).tobytes()
#: Words whose ids a worker remembers; further ones are encoded each time.
REMEMBERED = 200_000
SPECIAL = "<|endoftext|>"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Words(dict):
    """The ids of words with the space before them, as little-endian bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def _encoder(path: str, ranks_path: str):
    """A function from text to the bytes of its ids.

    The ranks hold the same vocabulary as the tokenizer file and give the same ids several times faster. Tokens
    never hold a space after another character, so a text without neighbouring white space can be cut before
    each space and its words' ids remembered.
    """
    import re

    import tiktoken
    from tokenizers import Tokenizer

    whole = functools.cache(lambda: Tokenizer.from_file(path))  # seldom needed
    with open(ranks_path, "rb") as f:
        ranks = {b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    words, doubled = _Words(encode), re.compile(r"\s ")
    double_after = re.compile(r" \s")

    def ids(text: str) -> bytes:
        if SPECIAL in text:
            return array("I", whole().encode(text, add_special_tokens=False).ids).tobytes()
        if doubled.search(text) or double_after.search(text):
            return array("I", encode(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", encode(first)).tobytes() + b"".join(map(words.__getitem__, rest))

    return ids


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """The pieces of each document: only longer ones are cut, and their first piece may be shorter."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, ranks_path)
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + END
                n, at = len(ids) // 4, 0
                end = n if n <= capacity else n % capacity or capacity
                piece = 0
                while at < n:
                    for column, value in zip(columns, (doc_id, piece, at, end - at, zlib.crc32(ids[4 * at : 4 * end]))):
                        column.append(value)
                    piece, at, end = piece + 1, end, end + capacity
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


class Plan:
    """Sequences of a histogram of lengths: groups of equal sequences, each with its items as (length, copies)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {k: v for k, v in counts.items() if v}
        self.groups: list[tuple[list[tuple[int, int]], int]] = []
        self.reduce()
        self.fixed = sum(m for _, m in self.groups)
        self.best_fit()

    def fix(self, items: list[int], times: int) -> None:
        for x in items:
            self.left[x] -= times
            if not self.left[x]:
                del self.left[x]
        self.groups.append(([(x, items.count(x)) for x in dict.fromkeys(items)], times))

    def reduce(self) -> None:
        for x in sorted(self.left, reverse=True):  # what fills a sequence alone or in two dominates every set with it
            y = self.capacity - x
            if y == 0:
                self.fix([x], self.left[x])
            elif x in self.left and y in self.left and (x != y or self.left[x] > 1):
                self.fix([x, y], min(self.left[x], self.left[y]) if x != y else self.left[x] // 2)
        changed = True
        while changed:
            changed = False
            for x in sorted(self.left, reverse=True):
                while x in self.left and (found := self.dominating(x)):
                    self.fix(found, self.times(found))
                    changed = True

    def times(self, items: list[int]) -> int:
        return min(self.left[x] // items.count(x) for x in items)

    def dominating(self, x: int) -> list[int] | None:
        """A set with x such that the other items of any set with x can be put, whole, in the places of its own."""
        room = self.capacity - x
        present = sorted(self.left)
        others = present[: bisect_right(present, room)]
        copies = lambda y: self.left[y] - (y == x)
        others = [y for y in others if copies(y) > 0]
        if not others:
            return [x]
        least: list[int] = []
        for y in others[:3]:
            least += [y] * min(3, copies(y))
        a = others[-1]
        if sum(least[:2]) > room or len(least) == 1:
            return [x, a]
        if len(least) >= 3 and sum(least[:3]) <= room:
            return None
        fits = [y for y in others if y <= room - a and copies(y) > (y == a)]
        if not fits:
            return None
        b = fits[-1]
        larger: list[int] = []
        for y in others[bisect_right(others, b) :][:2]:
            larger += [y] * min(2, copies(y))
        if len(larger) < 2 or larger[0] + larger[1] > room:
            return [x, a, b]
        return None

    def best_fit(self) -> None:
        spaces: list[int] = []  # sorted; of each, the groups that have it left
        bins: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}

        def put(items: list[tuple[int, int]], times: int, space: int) -> None:
            if times and space not in bins:
                bins[space] = []
                spaces.insert(bisect_left(spaces, space), space)
            if times:
                bins[space].append((items, times))

        for x in sorted(self.left, reverse=True):
            n = self.left[x]
            while n:
                at = bisect_left(spaces, x)
                if at < len(spaces):
                    space = spaces[at]
                    items, times = bins[space].pop()
                    if not bins[space]:
                        del bins[space], spaces[at]
                else:
                    items, times, space = [], n, self.capacity
                each = space // x
                full = min(times, n // each)
                if full:
                    put([*items, (x, each)], full, space - each * x)
                    n -= full * each
                else:
                    put([*items, (x, n)], 1, space - n * x)
                    full, n = 1, 0
                if items:
                    put(items, times - full, space)
        self.groups += [g for held in bins.values() for g in held]

    def runs(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, first rank, end rank, copies a sequence, first sequence, offset) of pieces placed alike."""
        used, out, sequence = dict.fromkeys(range(self.capacity + 1), 0), [], 0
        for items, times in self.groups:
            offset = 0
            for x, copies in items:
                out.append((x, used[x], used[x] + times * copies, copies, sequence, offset))
                used[x] += times * copies
                offset += copies * x
            sequence += times
        return out


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`made` (pieces with a salt, written) with the sequence_id and offset of each piece."""
    spark = made.sparkSession
    counts = made.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    plan = Plan({r["length"]: r["n"] for r in counts.collect()}, capacity)
    runs = spark.createDataFrame(plan.runs() or [(0, 0, 0, 1, 0, 0)], "r_length bigint, low bigint, high bigint, copies bigint, first bigint, place bigint")
    # There are at most `capacity` lengths.
    sized = made.join(F.broadcast(counts), "length").withColumn("part", F.floor(F.col("salt") * F.ceil(F.sqrt("n"))))
    by_part = sized.groupBy("length", "part").agg(F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    ranked = sized.withColumn("k", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")))
    ranked = ranked.join(small(written(offsets, "offsets")), ["length", "part"]).withColumn("rank", F.col("before") + F.col("k") - 1)
    placed = ranked.join(small(runs), (F.col("length") == F.col("r_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    nth = F.col("rank") - F.col("low")
    sequence = F.col("first") + F.floor(nth / F.col("copies"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.cast("long").alias("sequence_id"), (F.col("place") + nth % F.col("copies") * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(written(pieces(docs, capacity).withColumn("salt", F.rand(5)), "pieces"), capacity)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
