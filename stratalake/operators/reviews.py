"""Comments on items: recipients, threads, status and inboxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mentions(body: Column) -> Column:
    """The names after an @ at a word's beginning, in lower case, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(r"(?:^|[^\w@])@(\w[\w.-]*\w|\w)"), F.lit(1)), lambda x: F.lower(x)))


def recipients(comments: DataFrame, roster: DataFrame) -> DataFrame:
    """(id, recipient, kind) of each comment: those mentioned, and those who wrote in its thread before, but its author."""
    named = comments.select("id", "author", F.explode(mentions(F.col("body"))).alias("recipient"), F.lit("mention").alias("kind")).join(roster.select(F.col("name").alias("recipient")), "recipient", "left_semi")
    writers = comments.select(F.col("thread").alias("_t"), F.col("author").alias("recipient"), F.col("made").alias("_at")).groupBy("_t", "recipient").agg(F.min("_at").alias("_at"))
    replied = comments.join(writers, (F.col("thread") == F.col("_t")) & (F.col("_at") < F.col("made"))).select("id", "author", "recipient", F.lit("reply").alias("kind"))
    both = named.select("id", "author", "recipient", "kind").union(replied).filter("recipient <> author")
    return both.groupBy("id", "recipient").agg(F.min("kind").alias("kind"))  # mention comes before reply


def review_log(comments: DataFrame, promoted: DataFrame, item=None, generation: str | None = None, kind: str | None = None, status: str | None = None, row_value: str | None = None, column: str | None = None, limit: int = 5000) -> DataFrame:
    """The newest comments that meet all the filters given, with `read_only`: those of the review generation on an item that was promoted are history.

    `comments` has (id, item_ids, generation, target_kind, status, row_key_vals, column_name, made), `promoted` the column `item`. The log is cut to `limit` before it meets the promoted items.
    """
    rules = [(item, F.array_contains("item_ids", item)), (generation, F.col("generation") == generation), (kind, F.col("target_kind") == kind), (status, F.col("status") == status)]
    rules += [(row_value, F.array_contains("row_key_vals", row_value)), (column, F.col("column_name") == column)]
    for value, rule in rules:
        comments = comments.filter(rule) if value is not None else comments
    newest = comments.orderBy(F.desc("made"), "id").limit(limit)
    frozen = newest.filter("generation = 'review'").select("id", F.explode("item_ids").alias("item")).join(promoted, "item", "left_semi").select("id").distinct().withColumn("_f", F.lit(True))
    return newest.join(frozen, "id", "left").withColumn("read_only", F.coalesce("_f", F.lit(False))).drop("_f").orderBy(F.desc("made"), "id")


def latest_status(log: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The last written row of each key."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max(F.struct(at, *[c for c in rest if c != at])).alias("_s")).select(*keys, *[F.col(f"_s.{c}").alias(c) for c in rest])


def threads(comments: DataFrame) -> DataFrame:
    """(item, roots, replies, open) of each item, the one with most comments first."""
    root = F.col("parent").isNull()
    return comments.groupBy("item").agg(F.count_if(root).alias("roots"), F.count_if(~root).alias("replies"), F.count_if(root & (F.col("status") == "open")).alias("open")).orderBy(F.desc(F.col("roots") + F.col("replies")), "item")


def inbox(notes: DataFrame, comments: DataFrame, who: str, unseen: bool = False, limit: int = 500) -> DataFrame:
    mine = notes.filter(F.col("recipient") == who)
    mine = mine.filter("seen_at is null") if unseen else mine
    return mine.join(comments, "id").orderBy(F.desc("made"), "id").limit(limit)


def deleted_rows(comments: DataFrame, keys: DataFrame) -> DataFrame:
    """The ids of comments none of whose row keys (an array) is in the table any more."""
    each = comments.select("id", F.explode("row_keys").alias("k")).join(keys.select(F.col("k"), F.lit(True).alias("there")), "k", "left")
    return each.groupBy("id").agg(F.bool_and(F.col("there").isNull()).alias("gone")).filter("gone").select("id")
