"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

The sketch of a metric is a table of counts by bucket, each bucket holding values within a fixed relative
error (a DDSketch). Such tables merge by adding counts, so they are built by a partial aggregation, rolled up
from (language, source) to language to everything by adding again, and do not depend on how rows are dealt. A group's
quantiles are read from its own sketch merged with its language's and everyone's, each of which weighs as much as PRIOR
documents: a small group follows the others, a large one its own documents, and nothing switches between the two. A
metric is refused above a high quantile plus SPREAD times its distance from the median (width also below a low one); there are no fixed cutoffs.

Most texts have no symbol, repeat or repeated line at all, so quantiles of their plain shares would be 0, and with them every limit. A text
without any shows only that its share is small for its size, so the sketches hold what a share may be, an upper estimate: by the rule of three for
symbols and words (three more than seen), by the rule of succession for lines, of which a text has few. Distances are taken between odds, so that a
limit stays below the whole, and count as one permille at least where quantiles are tied. A document is held to its plain share.

Defined results: a null text has no words; null languages and sources are groups of their own; null doc_ids are kept as they are; an empty table
gives an empty result; repeated rows each count and each get a verdict; ties share a bucket and so a verdict; a very long text is a
slice of its own and needs some 60 bytes of memory for each of its own; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm import kernels as K
from stratalake.llm.tables import documents, small, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = T.StructType([T.StructField(c, T.LongType()) for c in (*COUNTS, "n_lines")])
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Metrics in permille: numerator, denominator, the high quantile, the spread, the low quantile where small values are refused too, and for shares what an upper estimate adds above and below.
METRICS = {
    "symbols": ("n_symbols", "word_chars", 0.75, 3, None, (3, 3)),
    "repeats": ("n_repeat_words", "n_words", 0.99, 2, None, (3, 3)),
    "dups": ("n_dup_lines", "n_lines", 0.99, 1, None, (1, 2)),
    "width": ("word_chars", "n_words", 0.75, 6, 0.25, None),
}
#: Buckets per factor e: values of a bucket differ by at most half a percent.
BUCKETS = 200
#: As how many documents the sketches of the language and of everything weigh in a group's.
PRIOR = 100


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _same_before(codes: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of documents: is it equal to an earlier item of its document; is it equal to any other one."""
    order = np.argsort(K.mix(codes + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    same = (codes[order][1:] == codes[order][:-1]) & (own[order][1:] == own[order][:-1])
    again, shared = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    again[order[1:][same]] = True
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return again, shared


def count_text(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The five counts of each document (rows as in STATS)."""
    starts, ends, first = K.words(data, offsets)
    word = ~K.IS_SPACE[data]
    codes = K.span_hashes(data, starts, ends)
    trigrams, at = K.windows(codes, first, 3)
    _, shared = _same_before(trigrams, K.owner(at))
    covered = np.zeros(len(codes) + 3, bool)
    where = (np.arange(len(trigrams)) - at[K.owner(at)] + first[K.owner(at)])[shared]
    for j in range(3):
        covered[where + j] = True
    from_, to = K.spans(data != 10, offsets)
    seen = np.concatenate(([0], np.cumsum(word)))
    full = seen[to] > seen[from_]
    from_, to = from_[full], to[full]
    again, _ = _same_before(K.span_hashes(data, from_, to), np.searchsorted(offsets, from_, "right") - 1)
    lines = np.bincount(np.searchsorted(offsets, from_, "right") - 1, minlength=len(offsets) - 1)
    dup = np.bincount(np.searchsorted(offsets, from_[again], "right") - 1, minlength=len(offsets) - 1)
    return np.stack([np.diff(first), _per_document(word & ((data & 0xC0) != 0x80), offsets), _per_document(_SYMBOL[data], offsets), dup, _per_document(covered[: len(codes)], first), lines])


@F.arrow_udf(STATS)
def text_counts(texts: pa.Array) -> pa.Array:
    parts = [count_text(data, offsets) for _, _, data, offsets in K.slices(texts)]
    columns = np.concatenate(parts, axis=1) if parts else np.zeros((len(STATS), 0), np.int64)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=STATS.names)


#: Not to be repeated where several expressions use its result.
text_counts = text_counts.asNondeterministic()


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _permille(s: Column, metric: str) -> Column:
    over, under = METRICS[metric][:2]
    return F.when(s[under] > 0, F.floor(1000 * s[over] / s[under])).otherwise(F.lit(0)).cast("long")


def _upper(s: Column, metric: str) -> Column:
    """What the sketches hold: the metric itself, or for a share its upper estimate."""
    over, under, *_, more = METRICS[metric]
    return _permille(s, metric) if more is None else F.floor(1000 * (s[over] + more[0]) / (s[under] + more[1])).cast("long")


def _odds(permille: Column) -> Column:
    share = F.least(permille, F.lit(999.0))
    return share / (1000 - share)


def sketches(stats: DataFrame) -> DataFrame:
    """(metric, lang, source, bucket, n): the sketch of each metric in each group, over what the base rules keep; bucket -1 holds zeros."""
    each = stats.filter(~base_failed(F.col("s"))).select("lang", "source", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), _upper(F.col("s"), m).alias("value")) for m in METRICS])).alias("m"))
    bucket = F.when(F.col("m.value") <= 0, F.lit(-1)).otherwise(F.floor(F.log(F.col("m.value").cast("double")) * BUCKETS)).cast("int")
    return each.groupBy(F.col("m.metric").alias("metric"), "lang", "source", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _merged(sketch: DataFrame) -> DataFrame:
    """(metric, lang, source, total, sketch): each group's buckets with weights, in order, the language's and everyone's merged in."""
    levels = []
    for depth, keys in enumerate((["lang", "source"], ["lang"], [])):
        counts = sketch.groupBy("metric", *keys, "bucket").agg(F.sum("n").alias("n"))
        # A sketch has a few thousand buckets at most, whatever the size of its group.
        levels.append(counts.groupBy(F.col("metric").alias(f"m{depth}"), *[F.col(k).alias(f"{k}{depth}") for k in keys]).agg(F.sum("n").alias(f"n{depth}"), F.collect_list(F.struct("bucket", "n")).alias(f"b{depth}")))
    own, by_lang, all_ = levels
    joined = own.join(by_lang, (F.col("m0") == F.col("m1")) & F.col("lang0").eqNullSafe(F.col("lang1"))).join(F.broadcast(all_), F.col("m0") == F.col("m2"))
    weighed = lambda b, scale: F.transform(b, lambda x: F.struct(x["bucket"].alias("bucket"), (x["n"] * scale).alias("weight")))
    prior = F.lit(float(PRIOR))
    parts = F.concat(weighed("b0", F.lit(1.0)), weighed("b1", prior / F.col("n1")), weighed("b2", prior / F.col("n2")))
    return joined.select(F.col("m0").alias("metric"), F.col("lang0").alias("lang"), F.col("source0").alias("source"), (F.col("n0") + 2 * prior).alias("total"), F.array_sort(parts).alias("sketch"))


def _quantile(q: Column) -> Column:
    """The upper end of the bucket in which the share q of the weight is reached."""
    step = lambda acc, x: F.struct((acc["seen"] + x["weight"]).alias("seen"), F.when(acc["seen"] >= q * F.col("total") * (1 - 1e-9), acc["at"]).otherwise(x["bucket"]).alias("at"))
    at = F.aggregate("sketch", F.struct(F.lit(0.0).alias("seen"), F.lit(-1).alias("at")), step)["at"]
    return F.when(at < 0, F.lit(0.0)).otherwise(F.exp((at + 1) / F.lit(float(BUCKETS))))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(g_lang, g_source, and for each metric the least and the largest value that is kept) for every group."""
    pick = lambda i: F.coalesce(*[F.when(F.col("metric") == m, F.lit(v[i])) for m, v in METRICS.items()])
    found = _merged(sketch).select("metric", "lang", "source", pick(3).alias("spread"), _quantile(F.lit(0.5)).alias("middle"), _quantile(pick(2)).alias("high"), F.when(pick(4).isNotNull(), _quantile(F.coalesce(pick(4), F.lit(0.5)))).alias("low"))
    beyond = lambda near, far, one: F.col("spread") * F.greatest(far - near, F.lit(one))
    odds = _odds(F.col("high")) + beyond(_odds(F.col("middle")), _odds(F.col("high")), 0.001)
    share = F.col("metric").isin(*[m for m, v in METRICS.items() if v[5]])
    most = F.floor(F.when(share, 1000 * odds / (1 + odds)).otherwise(F.col("high") + beyond(F.col("middle"), F.col("high"), 1.0)))
    least = F.ceil(F.col("low") - beyond(F.col("low"), F.col("middle"), 1.0))
    each = found.select("metric", "lang", "source", most.alias("most"), F.coalesce(least, F.lit(0)).alias("least"))
    of = lambda c: [F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{c}_{m}") for m in METRICS]
    return each.groupBy(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).agg(*of("most"), *of("least"))


def verdicts(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """`stats` (lang, source, s, and any others) with base_failed and kept."""
    joined = stats.join(small(limits), F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left")
    fine = ~base_failed(F.col("s"))
    for m in METRICS:
        fine = fine & _permille(F.col("s"), m).between(F.col(f"least_{m}"), F.col(f"most_{m}"))
    return joined.withColumns({"base_failed": base_failed(F.col("s")), "kept": F.coalesce(fine, F.lit(False))}).drop(*limits.columns)


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the five counts, base_failed and kept."""
    stats = written(docs.select("doc_id", "lang", "source", text_counts("text").alias("s")), "quality")
    out = verdicts(stats, written(thresholds(sketches(stats)), "limits"))
    return out.select("doc_id", *[F.col(f"s.{c}").alias(c) for c in COUNTS], "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose verdict is to keep them, with all their columns; each text is counted once."""
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("lang"), F.col("source"), text_counts("text").alias("s"))
    whole = written(whole, "quality")
    kept = verdicts(whole, written(thresholds(sketches(whole)), "limits"))
    return kept.filter("kept").select("row.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir))


#: The same rules in DuckDB's SQL.
OP10_SQL = r"""
with d as (select doc_id, lang, source, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
grams as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from w, unnest(range(1, len(ws) - 1)) r(i)),
found as (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams),
covered as (select doc_id, count(distinct i + j) as n from found, unnest(range(0, 3)) x(j) where c >= 2 group by doc_id),
lines as (select doc_id, unnest(string_split(t, chr(10))) as line from d),
dup as (select doc_id, count(*) - count(distinct line) as n, count(*) as lines from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
s as (select w.doc_id, lang, source, len(ws)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words, coalesce(dup.lines, 0) as n_lines
    from w left join dup on w.doc_id = dup.doc_id left join covered on w.doc_id = covered.doc_id),
x(metric, high, spread, low, more, size) as (values ('symbols', 0.75::double, 3::double, null::double, 3, 3), ('repeats', 0.99, 2, null, 3, 3), ('dups', 0.99, 1, null, 1, 2), ('width', 0.75, 6, 0.25, null, null)),
r as (select doc_id, lang, source, metric, over, under, case when under > 0 then floor(1000 * over / under)::bigint else 0 end as v from (from s where not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)), lateral (
    select * from (values ('symbols', n_symbols, word_chars), ('repeats', n_repeat_words, n_words), ('dups', n_dup_lines, n_lines), ('width', word_chars, n_words)) y(metric, over, under))),
m as (select r.*, case when more is null then v else floor(1000 * (over + more) / (under + size))::bigint end as u from r join x using (metric)),
b as (select *, case when u <= 0 then -1 else floor(ln(u::double) * 200)::int end as bucket from m),
g as (select metric, lang, source, count(*) as n from b group by all),
weights as (
    select metric, lang, source, bucket, count(*)::double as w from b group by all
    union all select g.metric, g.lang, g.source, l.bucket, 100.0::double * l.n / l.total from g join (select metric, lang, bucket, count(*) as n, sum(count(*)) over (partition by metric, lang) as total from b group by metric, lang, bucket) l
        on g.metric = l.metric and g.lang is not distinct from l.lang
    union all select g.metric, g.lang, g.source, a.bucket, 100.0::double * a.n / a.total from g join (select metric, bucket, count(*) as n, sum(count(*)) over (partition by metric) as total from b group by metric, bucket) a on g.metric = a.metric),
upto as (select metric, lang, source, bucket, sum(sum(w)) over (partition by metric, lang, source order by bucket) as upto, sum(sum(w)) over (partition by metric, lang, source) as total from weights group by metric, lang, source, bucket),
q as (select metric, lang, source, spread, low, min(bucket) filter (where upto >= 0.5 * total * (1 - 1e-9)) as q_middle,
    min(bucket) filter (where upto >= high * total * (1 - 1e-9)) as q_high, min(bucket) filter (where upto >= low * total * (1 - 1e-9)) as q_low from upto join x using (metric) group by metric, lang, source, spread, low),
e as (select metric, lang, source, spread, low, case when q_middle < 0 then 0 else exp((q_middle + 1) / 200.0::double) end as middle,
    case when q_high < 0 then 0 else exp((q_high + 1) / 200.0::double) end as high, case when q_low < 0 then 0 else exp((q_low + 1) / 200.0::double) end as low_end from q),
o as (select *, least(high, 999.0::double) / (1000 - least(high, 999.0::double)) as o_high, least(middle, 999.0::double) / (1000 - least(middle, 999.0::double)) as o_middle from e),
z as (select *, o_high + spread * greatest(o_high - o_middle, 0.001::double) as odds from o),
limits as (select metric, lang, source, floor(case when metric = 'width' then high + spread * greatest(high - middle, 1) else 1000 * odds / (1 + odds) end) as most,
    case when low is null then 0 else ceil(low_end - spread * greatest(middle - low_end, 1)) end as least from z),
over_ as (select b.doc_id, bool_or(v > most or v < least) as bad from b join limits l on b.metric = l.metric and b.lang is not distinct from l.lang and b.source is not distinct from l.source group by b.doc_id)
select s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not coalesce(bad, false) as kept
from s left join over_ on s.doc_id = over_.doc_id
"""
