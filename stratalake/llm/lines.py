"""Line dedup: lines that many documents share stay only in the largest doc_id that holds them.

Hashes of long lines are range-partitioned and sorted by document and position within a hash; the sorted rows
are streamed to find the first occurrence. A hash of many documents is salted, so that no task holds more than
about `SALT_DOCS` of its documents, and the winners of its salts meet again in further, much smaller rounds.
What comes back to the documents is a sparse bitmap (64 lines a word), never text.

Defined results: a null or empty text is one empty line; rows that share a doc_id are one document when
documents are counted; a null doc_id counts as the smallest; repeated rows get the same bitmap; an empty table
gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import documents, written

SALT_DOCS = 500
_SPACES = " \t\n\x0b\x0c\r"


def _text(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def line_occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, t, pos, h, g): each line whose key is long; t is the text's hash, (h, g) the key's."""
    exploded = docs.select("doc_id", F.xxhash64(_text("text")).alias("t"), F.posexplode(F.split(_text("text"), "\n", -1)).alias("pos", "line"))
    trimmed = exploded.filter(F.length("line") >= min_chars).withColumn("line", F.btrim("line", F.lit(_SPACES))).filter(F.length("line") >= min_chars)
    key = F.translate("line", string.ascii_uppercase, string.ascii_lowercase)
    return trimmed.select("doc_id", "t", "pos", F.xxhash64(key).alias("h"), F.hash(key).alias("g"))


def keep_bitmaps(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """(doc_id, t, keep, n_dropped) for each document that loses lines; keep maps a word of 64 lines to its bits."""
    occurrences = written(line_occurrences(docs, min_chars), "lines")
    counts = occurrences.select("h", "g", "doc_id").distinct().groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"))
    # Written, so that Spark can split a hot hash in the join below.
    shared = written(counts.filter(F.col("n") >= min_docs), "shared-hashes")
    rows = written(occurrences.join(shared, ["h", "g"]), "shared-lines")
    most = rows.agg(F.max("n")).first()[0] or 0
    lost, alive = [], rows
    while True:
        most = -(-most // SALT_DOCS)
        alive = alive.withColumn("n", F.ceil(F.col("n") / SALT_DOCS)).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("n")))
        first = F.first("doc_id").over(Window.partitionBy("h", "g", "salt").orderBy(F.desc_nulls_last("doc_id"), "t", "pos").rowsBetween(Window.unboundedPreceding, 0))
        marked = written(alive.repartitionByRange("h", "g", "salt").withColumn("first", F.col("doc_id").eqNullSafe(first)), "first-lines")
        lost.append(marked.filter(~F.col("first")).select("doc_id", "t", "pos"))
        alive = marked.filter("first").drop("first", "salt")
        if most <= 1:
            break
    dropped = lost[0]
    for more in lost[1:]:
        dropped = dropped.union(more)
    words = dropped.groupBy("doc_id", "t", F.expr("pos div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc_id", "t").agg(F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"), F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"))


def _joined(rows: DataFrame, text: str, doc_id: str, bitmaps: DataFrame) -> DataFrame:
    """`rows` with keep and n_dropped; the small side is hashed, so that texts are not sorted."""
    right = bitmaps.withColumnsRenamed({"doc_id": "b_doc_id", "t": "b_t"}).hint("shuffle_hash")
    return rows.join(right, F.col(doc_id).eqNullSafe(F.col("b_doc_id")) & (F.xxhash64(_text(text)) == F.col("b_t")), "left")


def _kept_text(text: str) -> Column:
    lines = F.filter(F.split(_text(text), "\n", -1), lambda x, i: F.coalesce(F.getbit(F.element_at("keep", F.floor(i / 64).cast("long")), i % 64), F.lit(1)) == 1)
    return F.when(F.col("keep").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """`docs` with all their columns, and texts without the repeated lines."""
    bitmaps = keep_bitmaps(docs, min_docs, min_chars)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    out = _joined(rows, "row.text", "row.doc_id", bitmaps)
    return out.select(*[_kept_text("row.text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = _joined(docs.select("doc_id", "text"), "text", "doc_id", keep_bitmaps(docs))
    n_lines = F.length(_text("text")) - F.length(F.replace(_text("text"), F.lit("\n"))) + 1
    return out.select("doc_id", n_lines.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.sha2(F.coalesce(_kept_text("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
with l as (select doc_id, i, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as trimmed
    from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i from documents)),
k as (select doc_id, i, line, case when length(trimmed) >= 40 then translate(trimmed, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as key from l),
s as (select key, max(doc_id) as last from k where key is not null group by key having count(distinct doc_id) >= 5),
m as (select k.doc_id, i, line, s.key is not null and k.doc_id <> s.last as gone from k left join s on k.key = s.key)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256 from m group by doc_id
"""
