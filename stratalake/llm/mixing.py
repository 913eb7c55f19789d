"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target T and size S is wanted T/S times. The whole part is certain; the fractional
parts are settled in pairs. Of a pair, a random transfer of words (probability times size, so that the words
expected of the source never change) makes one of the two integral; the other goes on. Pairs are formed within
blocks of about `BLOCK` documents of a source, and the one that is left of each block joins the blocks of the
next level: a reduction tree of log(n) levels, each a shuffle on (source, block) with no large group. Rows that agree in
id, source and size are counted beforehand and go through the tree as one item, whose fraction is that of their copies together, so
that a repeated or missing id fills no block. A
source's words so differ from its target by less than the one document left at its root, which is often a
large one; a few small documents, drawn at random, then change sides to make up for it.

Defined results: null texts and texts without words have size 0, are taken once if their source's copies
allow and count nothing; a null source sorts last; rows that share a doc_id, null ids included, are documents of their own, and those of one source and size
get copies that differ by at most one (mix_sources gives the larger numbers to the texts with the smallest hashes, and what is left over among rows of one text to one of them); the same
input gives the same result on every run; extra columns are kept, whatever their names; a very long text is only counted; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import documents, small, written

BLOCK = 32
CANDIDATES = 8
MOST = 3
_ITEM = "struct<doc_id:bigint,size:bigint,p:double>"
_DONE = "struct<doc_id:bigint,size:bigint,up:bigint>"


def word_count(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n, target): targets in proportion to weights 1, 2, 3, ..., at most MOST times the source.

    Sources are filled in the order of the share at which they reach their cap: the first that stays below it
    fixes the share a weight for all after it.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = totals.withColumn("w", 1 + (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % 3)
    level = (MOST * F.col("source_size") / F.col("w")).alias("level")
    filled = Window.orderBy("level", F.asc_nulls_last("source"))
    before = F.coalesce(F.sum(MOST * F.col("source_size")).over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("w").over(filled.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    shares = ranked.select("*", level).withColumn("share", (total - before) / after)
    free = F.min(F.when(F.col("share") < F.col("level"), F.struct("level", "share"))).over(Window.partitionBy())["share"]
    target = F.when(F.col("share") < F.col("level"), free * F.col("w")).otherwise(MOST * F.col("source_size")).cast("double")
    return shares.select("source", "source_size", "n", target.alias("target"))


def _uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)


def _settle(level: int, seed: int):
    """A fold step: the item that goes on meets the next one, and one of them is settled."""

    def step(acc: Column, j: Column) -> Column:
        i = acc["left"]
        gain = F.least(i["size"] * (1 - i["p"]), j["size"] * j["p"])
        loss = F.least(i["size"] * i["p"], j["size"] * (1 - j["p"]))
        up = _uniform(F.lit(seed), F.lit(level), i["doc_id"], j["doc_id"], i["size"], j["size"]) * (gain + loss) < loss
        up = F.when(gain + loss > 0, up).otherwise(i["p"] >= 0.5)
        i_done = F.when(up, gain >= i["size"] * (1 - i["p"])).otherwise(loss >= i["size"] * i["p"])
        moved = F.when(up, gain).otherwise(-loss)
        done = F.when(i_done, F.struct(i["doc_id"], i["size"], up.cast("long")).cast(_DONE)).otherwise(F.struct(j["doc_id"], j["size"], (~up).cast("long")).cast(_DONE))
        on = F.when(i_done, F.struct(j["doc_id"], j["size"], j["p"] - moved / j["size"]).cast(_ITEM)).otherwise(F.struct(i["doc_id"], i["size"], i["p"] + moved / i["size"]).cast(_ITEM))
        on = F.struct(on["doc_id"], on["size"], F.greatest(F.lit(0.0), F.least(F.lit(1.0), on["p"]))).cast(_ITEM)
        return F.when(i.isNull(), F.struct(j.alias("left"), acc["done"].alias("done"))).otherwise(F.struct(on.alias("left"), F.concat(acc["done"], F.array(done)).alias("done")))

    return step


def rounded(sizes: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """(doc_id, size, source, source_size, target, rows, copies): for the rows of `sizes` (doc_id, source, size) that agree, how many they are and their copies together."""
    named = targets.withColumnsRenamed({"source": "k"})
    alike = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    each = alike.join(small(named), F.col("source").eqNullSafe(F.col("k")), "left").drop("k")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)) * F.col("rows")
    each = written(each.withColumns({"whole": F.floor(wanted), "p": wanted - F.floor(wanted)}), "wanted")
    start = F.struct(F.lit(None).cast(_ITEM).alias("left"), F.array().cast(f"array<{_DONE}>").alias("done"))
    rows = each.filter((F.col("size") > 0) & (F.col("p") > 0)).select("source", F.struct("doc_id", "size", "p").cast(_ITEM).alias("item"), F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("n") / BLOCK)).alias("block"))
    settled, blocks, level = [], -(-(targets.agg(F.max("n")).first()[0] or 0) // BLOCK), 0
    while True:
        folded = rows.groupBy("source", "block").agg(F.aggregate(F.array_sort(F.collect_list("item")), start, _settle(level, seed)).alias("f"))
        folded = written(folded.select("source", "block", "f.*"), "mixing")
        settled.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        if blocks <= 1:
            break
        rows = folded.select("source", F.col("left").alias("item"), F.expr(f"block div {BLOCK}").alias("block"))
        blocks, level = -(-blocks // BLOCK), level + 1
    up = folded.select("source", "left.doc_id", "left.size", (_uniform(F.lit(seed), F.lit(-1), F.col("left.doc_id"), F.col("left.size")) < F.col("left.p")).cast("long").alias("up"))
    for part in settled:
        up = up.union(part)
    up = up.withColumnsRenamed({"source": "u_source", "doc_id": "u_doc_id", "size": "u_size"})
    same = F.col("doc_id").eqNullSafe(F.col("u_doc_id")) & F.col("source").eqNullSafe(F.col("u_source")) & (F.col("size") == F.col("u_size"))
    # Texts without words count nothing: they are taken once at most.
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("up", F.lit(0))).otherwise(F.least(F.col("whole"), F.col("rows")))
    settled_ = each.join(up, same, "left").select("doc_id", "size", "source", "source_size", "target", "rows", copies.alias("copies"))
    return _made_up(_made_up(written(settled_, "rounded"), seed), seed + 1)


def _made_up(mix: DataFrame, seed: int) -> DataFrame:
    """`mix` with a few small documents of each source taken once more, or once less, to come nearer its target.

    Candidates are drawn with a probability that makes their words about CANDIDATES times what is missing, so
    that a hot source sends no more rows to the window than any other.
    """
    missing = mix.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("missing")).withColumnRenamed("source", "m_source")
    each = mix.join(small(written(missing, "missing")), F.col("source").eqNullSafe(F.col("m_source")), "left")
    low = F.floor(F.col("target") * F.col("rows") / F.col("source_size"))
    whole = F.col("target") * F.col("rows") == low * F.col("source_size")
    turn = F.when((F.col("missing") > 0) & (F.col("copies") == low) & ~whole, 1).when((F.col("missing") < 0) & (F.col("copies") == low + 1), -1).otherwise(0)
    drawn = _uniform(F.lit(seed), F.col("doc_id"), F.col("size")) * F.col("source_size") < CANDIDATES * F.abs("missing")
    may = (F.col("size") > 0) & (F.col("size") <= F.abs("missing")) & drawn & (turn != 0)
    each = each.withColumn("turn", F.when(F.coalesce(may, F.lit(False)), turn).otherwise(0))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "doc_id", "size"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    turned = each.filter("turn <> 0").withColumn("copies", F.when(upto <= F.abs("missing"), F.col("copies") + F.col("turn")).otherwise(F.col("copies")))
    return turned.union(each.filter("turn = 0")).select(mix.columns)


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(docs["text"]).alias("size"))


def _share(rows: Column, copies: Column, place: Column) -> Column:
    """The copies of the row at `place` (from 0) among rows that agree: as even as can be."""
    return (F.floor(copies / rows) + F.when(place < copies % rows, 1).otherwise(0)).cast("long")


def mix_sources(docs: DataFrame, seed: int = 7) -> DataFrame:
    """`docs` with all their columns, each row as often as the mix takes it."""
    sizes = written(_sizes(docs), "sizes")
    copies = written(rounded(sizes, written(source_targets(sizes), "targets"), seed).select("doc_id", "size", "source", "rows", "copies"), "copies")
    copies = copies.withColumnsRenamed({c: f"c_{c}" for c in copies.columns})
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).withColumn("size", word_count("row.text"))
    same = F.col("row.doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("size") == F.col("c_size")) & F.col("row.source").eqNullSafe(F.col("c_source"))
    joined = whole.join(copies.hint("shuffle_hash"), same).drop("c_doc_id", "c_size", "c_source")
    if copies.filter("c_rows > 1").isEmpty():
        taken = joined.withColumn("taken", F.col("c_copies"))
    else:
        # Rows that agree are placed by the hashes of their texts, within salts and with the salts' offsets, so that no key is hot.
        keys = ["id", "size", "source", "t"]
        alike = docs.select(F.col("doc_id").alias("id"), word_count(docs["text"]).alias("size"), docs["source"], F.xxhash64("text").alias("t")).join(copies.filter("c_rows > 1"), F.col("id").eqNullSafe(F.col("c_doc_id")) & (F.col("size") == F.col("c_size")) & F.col("source").eqNullSafe(F.col("c_source")))
        alike = alike.withColumn("salt", F.shiftright("t", 40) + (1 << 23)).withColumn("salt", F.floor(F.col("salt") * F.ceil(F.sqrt("c_rows")) / (1 << 24)))
        counts = written(alike.groupBy(*keys, "salt", "c_rows", "c_copies").agg(F.count(F.lit(1)).alias("m")), "alike")
        by_salt = counts.groupBy("id", "size", "source", "salt").agg(F.sum("m").alias("m"))
        before = by_salt.select("id", "size", "source", "salt", (F.sum("m").over(Window.partitionBy("id", "size", "source").orderBy("salt")) - F.col("m")).alias("before")).toDF("b_id", "b_size", "b_source", "b_salt", "before")
        within = F.sum("m").over(Window.partitionBy("id", "size", "source", "salt").orderBy("t")) - F.col("m")
        placed = counts.withColumn("within", within).join(before, F.col("id").eqNullSafe(F.col("b_id")) & (F.col("size") == F.col("b_size")) & F.col("source").eqNullSafe(F.col("b_source")) & (F.col("salt") == F.col("b_salt")))
        at = F.col("before") + F.col("within")
        # Of rows that agree in their text too, the first `more` are taken once more.
        more = F.greatest(F.lit(0), F.least(F.col("m"), F.col("c_copies") % F.col("c_rows") - at))
        placed = placed.select(F.col("id").alias("a_id"), F.col("size").alias("a_size"), F.col("source").alias("a_source"), F.col("t").alias("a_t"), F.col("m"), more.alias("more"))
        joined = joined.join(placed.hint("shuffle_hash"), F.col("row.doc_id").eqNullSafe(F.col("a_id")) & (F.col("size") == F.col("a_size")) & F.col("row.source").eqNullSafe(F.col("a_source")) & F.xxhash64("row.text").eqNullSafe(F.col("a_t")), "left")
        # Rows equal in id, source and text are all taken alike, and the rest of their copies goes to one of them.
        even = F.floor(F.col("c_copies") / F.col("c_rows")) + F.when(F.col("more") == F.col("m"), 1).otherwise(0)
        partly = (F.col("more") > 0) & (F.col("more") < F.col("m"))
        several = joined.filter(partly).withColumn("taken", F.floor(F.col("c_copies") / F.col("c_rows")))
        extra = several.dropDuplicates(["a_id", "a_size", "a_source", "a_t"]).withColumn("taken", F.col("more"))
        taken = joined.filter(~F.coalesce(partly, F.lit(False))).withColumn("taken", even).unionByName(several).unionByName(extra)
    return taken.filter("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("taken").cast("int")))).select("row.*")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = written(_sizes(documents(spark, sf_dir)), "sizes")
    out = rounded(sizes, written(source_targets(sizes), "targets"))
    # Rows that agree are dealt their copies again, a thousand to a row of the explode.
    many = out.withColumn("thousand", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(rows - 1) div 1000"))))
    place = F.explode(F.sequence(F.col("thousand") * 1000, F.least(F.col("rows"), F.col("thousand") * 1000 + 1000) - 1))
    out = many.withColumn("place", place).withColumn("copies", _share(F.col("rows"), F.col("copies"), F.col("place")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
