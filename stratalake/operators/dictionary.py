"""A dictionary of the words of items, by which words that begin with a term, or are a slip of it, are found without looking at the items.

The folder holds `words` (field, word, key) in the order of words, so that a prefix is a range of files and row groups, and `variants` (variant, word): each distinct word with up to
SLIPS letters left out. Two words are at most d edits apart only if they meet when up to d letters of each are left out, so a term's own variants
name its candidates, which alone are compared by edit distance.
"""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from stratalake.operators.search import terms
from stratalake.plans.storage import small, written

#: Letters left out of stored words at most, and the longest word that has variants. What is asked beyond that is compared with every distinct word.
SLIPS, LONGEST = 2, 24


def variants(word: str, slips: int) -> list[str]:
    """`word` with up to so many letters left out."""
    out = {word}
    for n in range(1, min(slips, len(word)) + 1):
        out |= {"".join(c for i, c in enumerate(word) if i not in gone) for gone in map(set, combinations(range(len(word)), n))}
    return sorted(out)


@F.pandas_udf(ArrayType(StringType()))
def _variants(words: pd.Series) -> pd.Series:
    return words.map(lambda w: variants(w, SLIPS))


def slips_of(term: str) -> int:
    """The edits that a term forgives: one in five letters, of four letters or more without digits."""
    return int(0.2 * len(term)) if len(term) >= 4 and term.isalpha() else 0


def write_dictionary(items: DataFrame, key: str, fields: list[str], path: str) -> None:
    """Write the dictionary of the words of `fields`."""
    each = [items.select(F.lit(f).alias("field"), F.explode(terms(F.col(f))).alias("word"), F.col(key)) for f in fields]
    rows = each[0]
    for more in each[1:]:
        rows = rows.union(more)
    rows.distinct().repartitionByRange("word", F.col(key)).sortWithinPartitions("word", key).write.parquet(f"{path}/words")
    words = items.sparkSession.read.parquet(f"{path}/words").select("word").distinct()
    short = words.filter((F.length("word") <= LONGEST) & ~F.col("word").rlike("[0-9]"))
    spread = short.select(F.explode(_variants("word")).alias("variant"), "word")
    spread.repartitionByRange("variant").sortWithinPartitions("variant").write.parquet(f"{path}/variants")


def matching_words(spark: SparkSession, path: str, term: str) -> DataFrame:
    """(word, share): the words that begin with a term (share 1), and those that are a slip of it (a half)."""
    words = spark.read.parquet(f"{path}/words").select("word")
    begins = words.filter(F.startswith("word", F.lit(term))).distinct().select("word", F.lit(1.0).alias("share"))
    edits = slips_of(term)
    if not edits:
        return begins
    if edits <= SLIPS and len(term) + edits <= LONGEST:
        candidates = spark.read.parquet(f"{path}/variants").filter(F.col("variant").isin(variants(term, edits))).select("word").distinct()
    else:
        candidates = words.distinct()
    near = candidates.filter(F.levenshtein("word", F.lit(term), edits) >= 0)
    return begins.union(near.select("word", F.lit(0.5).alias("share"))).groupBy("word").agg(F.max("share").alias("share"))


def dictionary_search(spark: SparkSession, path: str, key: str, fields: dict[str, float], query: list[str]) -> DataFrame:
    """(key, score) as `search.keyword_search`: every term begins a word of some field (weighted), or is a slip of one."""
    weight = F.create_map(*[x for f, w in fields.items() for x in (F.lit(f), F.lit(float(w)))])
    found = None
    for i, q in enumerate(query):
        hits = matching_words(spark, path, q).withColumn("term", F.lit(i))
        found = hits if found is None else found.union(hits)
    found = written(found, "matching-words")
    rows = spark.read.parquet(f"{path}/words").filter(F.col("field").isin(list(fields))).join(small(found), "word")
    best = rows.groupBy(key, "term").agg(F.max(F.col("share") * weight[F.col("field")]).alias("best"))
    return best.groupBy(key).agg(F.sum("best").alias("score"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(query)).select(key, "score")
