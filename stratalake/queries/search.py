"""Queries over full text, vectors and graphs."""

from pyspark.sql import functions as F

from stratalake.functions.rules import TOPICS
from stratalake.operators import catalogue, dictionary, search, vectors
from stratalake.operators.aggregates import fingerprint
from stratalake.operators.postings import Analyzer, TextIndex
from stratalake.plans.storage import new_folder
from stratalake.queries.base import Register, sql, table

Q = Register()
WORDS = "w as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') as ws from documents), u as (select doc_id, unnest(ws) as term from w)"
SHAPED = "select doc_id, 'DOC-' || (doc_id + 1) || ' and DOC-' || (doc_id + 1) || ' see DOC-' || (doc_id * 7 % 500) || ' DOC-' || doc_id as body from documents"


@Q("ts1_text_index", f"with {WORDS} select term, count(*) as df, sum(tf)::bigint as tf from (select term, doc_id, count(*) as tf from u group by 1, 2) p group by 1")
def ts1(spark, d):
    postings, _ = search.text_index(table(spark, d, "documents"), "doc_id", F.col("text"))
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))


BM25 = f"""with {WORDS}, n as (select count(*) as n_docs, avg(len(ws)) as mean from w),
p as (select doc_id, term, count(*) as tf from u where term in ('the', 'which', 'der') group by 1, 2), f as (select term, count(*) as df from p group by 1)
select p.doc_id, round(sum(ln(1 + (n_docs - df + 0.5e0) / (df + 0.5e0)) * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * len(w.ws) / mean))), 6) as score
from p join f on p.term = f.term join w on w.doc_id = p.doc_id join documents d on d.doc_id = p.doc_id, n"""
FIELDS = {"lang": "exact", "source": "contains"}


@Q("ts2_bm25_search", BM25 + " group by 1 order by score desc, doc_id limit 50")
def ts2(spark, d):
    found = search.full_text_search(table(spark, d, "documents"), "doc_id", "text", "the which DER the", FIELDS)
    return found.select("doc_id", F.round("score", 6).alias("score"))


@Q("ts2_bm25_from_index", BM25 + " group by 1 order by score desc, doc_id limit 50")
def ts2_index(spark, d):
    scored = search.bm25(*search.text_index(table(spark, d, "documents"), "doc_id", F.col("text")), "doc_id", ["the", "which", "der"])
    return scored.select("doc_id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(50)


@Q("ts2_search_with_predicates", BM25 + " where d.lang = 'en' and contains(lower(d.source), 'src1') and not contains(lower(d.text), 'trash') and contains(lower(d.text), 'of the') group by 1 order by score desc, doc_id limit 50")
def ts2_predicates(spark, d):
    found = search.full_text_search(table(spark, d, "documents"), "doc_id", "text", 'the which der lang:EN source:src1 -trash "of the"', FIELDS)
    return found.select("doc_id", F.round("score", 6).alias("score"))


@Q("ts2_field_only_search", "select doc_id, 1.0::double as score from documents where lang = 'de' and contains(lower(source), 'src2') order by doc_id limit 50")
def ts2_fields(spark, d):
    return search.full_text_search(table(spark, d, "documents"), "doc_id", "text", "lang:de source:src2", FIELDS)


PLAIN = Analyzer(stems=False, stop_words=frozenset())


def _text_index(spark, d, analyzer=PLAIN):
    """An index of older texts, some of them since gone, brought up to date; then also the counts of what was brought in and taken out."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    older = docs.filter("doc_id % 50 <> 0").withColumn("text", F.when(F.col("doc_id") % 49 == 0, F.concat(F.lit("since rewritten "), "text")).otherwise(F.col("text")))
    index = TextIndex(spark, new_folder(spark, "text-index"), analyzer)
    index.update(older.union(older.filter("doc_id % 60 = 1").withColumn("doc_id", -F.col("doc_id"))), digest=F.xxhash64(F.col("text").isNull(), "text"))
    return index, index.sync(docs)


@Q("ts1_stored_index", f"with {WORDS} select term, count(*) as df, sum(tf)::bigint as tf from (select term, doc_id, count(*) as tf from u group by 1, 2) p group by 1")
def ts1_stored(spark, d):
    """The postings of a stored index after an update and a merge of its segments."""
    index, _ = _text_index(spark, d)
    index.merge()
    return index.postings().groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))


@Q("ts2_search_stored_index", BM25 + " group by 1 order by score desc, doc_id limit 50")
def ts2_stored(spark, d):
    """From a stored index of two segments and tombstones."""
    index, _ = _text_index(spark, d)
    return index.search("the which DER the", 50).select(F.col("doc").alias("doc_id"), F.round("score", 6).alias("score"))


@Q("ts2_stemmed_search")
def ts2_stemmed(spark, d):
    """Inflected forms are found, and stop words are not asked for; tested by brute force."""
    index = TextIndex(spark, new_folder(spark, "text-index"))
    index.update(table(spark, d, "documents"))
    return index.search("the oned things and hehelies", 50).select(F.col("doc").alias("doc_id"), F.round("score", 6).alias("score"))


@Q("ts3_index_sync", "select count(*) filter (where doc_id % 50 = 0 or doc_id % 49 = 0) as added, (select count(*) from documents where doc_id % 50 <> 0 and doc_id % 60 = 1) as removed from documents")
def ts3_sync(spark, d):
    """How many documents an update of the index brings in and takes out."""
    return _text_index(spark, d)[1]


@Q("ts3_index_fingerprint", "select count(*) as rows, true as changed from documents")
def ts3(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.md5("text").alias("body"), "lang", "source")
    old = fingerprint(t, "index 1")
    new = fingerprint(t.withColumn("lang", F.when(F.col("doc_id") == 3, "xx").otherwise(F.col("lang"))), "index 1").select(F.col("hash_sum").alias("now"))
    return old.crossJoin(new).select("rows", (F.col("hash_sum") != F.col("now")).alias("changed"))


KEYWORDS = """with w as (select p_partkey, regexp_extract_all(lower(p_name), '[a-z0-9]+') as a, regexp_extract_all(lower(p_type), '[a-z0-9]+') as b from part),
s as (select p_partkey, greatest(case when len(list_filter(a, lambda x: starts_with(x, 'widget'))) > 0 then 4e0 when len(list_filter(a, lambda x: levenshtein(x, 'widget') <= 1)) > 0 then 2e0 else 0e0 end,
    case when len(list_filter(b, lambda x: starts_with(x, 'widget'))) > 0 then 2e0 when len(list_filter(b, lambda x: levenshtein(x, 'widget') <= 1)) > 0 then 1e0 else 0e0 end) as one,
    greatest(case when len(list_filter(a, lambda x: starts_with(x, 'cold'))) > 0 then 4e0 when len(list_filter(a, lambda x: levenshtein(x, 'cold') <= 0)) > 0 then 2e0 else 0e0 end,
    case when len(list_filter(b, lambda x: starts_with(x, 'cold'))) > 0 then 2e0 when len(list_filter(b, lambda x: levenshtein(x, 'cold') <= 0)) > 0 then 1e0 else 0e0 end) as two from w)
select p_partkey, one + two as score from s where one > 0 and two > 0"""


@Q("ts4_keyword_catalogue_search", KEYWORDS)
def ts4(spark, d):
    return search.keyword_search(table(spark, d, "part"), "p_partkey", {"p_name": 4.0, "p_type": 2.0}, ["widget", "cold"])


@Q("ts4_dictionary_search", KEYWORDS)
def ts4_dictionary(spark, d):
    """The same from a stored dictionary, by prefix ranges and words with letters left out."""
    path = new_folder(spark, "dictionary")
    dictionary.write_dictionary(table(spark, d, "part"), "p_partkey", ["p_name", "p_type"], path)
    return dictionary.dictionary_search(spark, path, "p_partkey", {"p_name": 4.0, "p_type": 2.0}, ["widget", "cold"])


@Q("ts5_id_lookup", "select c_name from customer where replace(replace(lower(c_name), '#', ''), ' ', '') = 'customer000000007'")
def ts5(spark, d):
    names = table(spark, d, "customer").select(F.regexp_replace("c_name", "#", "-").alias("shown"), "c_name")
    found = search.id_lookup(names, "shown", "CUSTOMER 000000007")
    return names.join(F.broadcast(found), "shown", "left_semi").select("c_name")


@Q("ts6_place_name_search", "select n_name, case when lower(n_name) = 'nation_1' then 0 when starts_with(lower(n_name), 'nation_1') then 1 else 2 end as rank from nation where contains(lower(n_name), 'nation_1') order by rank, n_name limit 5")
def ts6(spark, d):
    return search.place_search(table(spark, d, "nation"), "n_name", "Nation_1 County")


TOPIC_CASE = "case " + " ".join(f"when regexp_matches(lower(x), '{p}') then '{n}'" for n, p in TOPICS) + " else 'other' end"


@Q("ts7_search_corpus", f"""with a as (select doc_id, source, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from documents)
select id, volume, page, {TOPIC_CASE} as topic from (select 'D' || doc_id || '#' || i as id, source as volume, i + 1 as page, substr(line, 1, 40) || ' ' || substr(line, 1, 300) as x from a) t""")
def ts7(spark, d):
    """Documents as issues, whose lines are the articles."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(F.substring(x, 1, 40).alias("title"), (i + 1).cast("long").alias("page"), x.alias("text")))
    issues = table(spark, d, "documents").select(F.concat(F.lit("D"), "doc_id").alias("sid"), F.col("source").alias("volume"), lines.alias("articles"))
    return catalogue.article_corpus(issues).select("id", "volume", "page", "topic")


@Q("ts8_chunking")
def ts8(spark, d):
    return search.chunked(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "pos", F.length("chunk").alias("size"))


@Q("ts9_embed_incremental", "select doc_id, doc_id % 3 = 0 as reused from documents")
def ts9(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    cache = t.filter("doc_id % 3 = 0").select("doc_id", F.array(F.lit(-1.0).cast("float")).alias("emb"))
    return search.embed_incremental(t, cache, "doc_id", search.hashed_vector, "text").select("doc_id", (F.size("emb") == 1).alias("reused"))


NEAREST = """with e as (select vec_id, list_transform(embedding::double[], lambda v: v / sqrt(list_dot_product(embedding::double[], embedding::double[]))) as u from embeddings),
p as (select a.vec_id as query, b.vec_id, round(list_dot_product(a.u, b.u), 12) as s from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id)
select query, vec_id, round(1 - s, 6) as distance from (select *, row_number() over (partition by query order by s desc, vec_id) as r from p) t where r <= 20"""


@Q("ts10_vector_search", NEAREST)
def ts10(spark, d):
    """The queries are the vectors whose id is divisible by 100."""
    e = table(spark, d, "embeddings")
    near = search.nearest(e.filter("vec_id % 100 = 0"), e, "vec_id", "embedding", 20)
    return near.select(F.col("q").alias("query"), F.col("v").alias("vec_id"), F.round(1 - F.col("s"), 6).alias("distance"))


@Q("ts11_mean_pool", "with m as (select label, i, avg(embedding[i]::double) as v from embeddings, unnest(range(1, len(embedding) + 1)) t(i) group by 1, 2), n as (select label, sqrt(sum(v * v)) as n from m group by 1) select m.label, (i - 1)::int as pos, round(v / n, 6) as v from m join n on m.label = n.label")
def ts11(spark, d):
    return search.mean_pool(table(spark, d, "embeddings"), "label", "embedding").select("label", F.posexplode("emb").alias("pos", "v")).withColumn("v", F.round("v", 6))


SIMILAR = """with e as (select vec_id, list_transform(embedding::double[], lambda v: v / sqrt(list_dot_product(embedding::double[], embedding::double[]))) as u from embeddings),
p as (select a.vec_id as a, b.vec_id as b, round(list_dot_product(a.u, b.u), 12) as s from e a join e b on a.vec_id <> b.vec_id), r as (select *, row_number() over (partition by a order by s desc, b) as r from p)
select least(a, b) as src, greatest(a, b) as dst, round(max(s), 4) as weight from r where r <= 5 group by 1, 2"""


@Q("ts12_similar_edges", SIMILAR)
def ts12(spark, d):
    return search.similar_edges(table(spark, d, "embeddings"), "vec_id", "embedding", 5)


def _index(spark, d):
    path = new_folder(spark, "vector-index")
    vectors.write_index(table(spark, d, "embeddings"), "vec_id", "embedding", path)
    return path


@Q("ts10_index_search", NEAREST)
def ts10_index(spark, d):
    """The same, from a stored index: cells near a query first, then those that could hold a nearer vector."""
    asked = table(spark, d, "embeddings").filter("vec_id % 100 = 0")
    near = vectors.search_index(spark, _index(spark, d), asked, "vec_id", "embedding", 20, exact=True)
    return near.select(F.col("q").alias("query"), F.col("v").alias("vec_id"), F.round(1 - F.col("s"), 6).alias("distance"))


@Q("ts10_index_recall", "select (select count(*) from embeddings where vec_id % 100 = 0) * least(20, (select count(*) - 1 from embeddings)) as neighbours, true as enough")
def ts10_recall(spark, d):
    """How many of the exact neighbours the probed cells alone hold: 0.9 of them at least."""
    e = table(spark, d, "embeddings")
    asked = e.filter("vec_id % 100 = 0")
    found = vectors.search_index(spark, _index(spark, d), asked, "vec_id", "embedding", 20)
    return vectors.recall_of(found, search.nearest(asked, e, "vec_id", "embedding", 20)).select("neighbours", (F.col("recall") >= 0.9).alias("enough"))


@Q("ts12_edges_from_index", SIMILAR)
def ts12_index(spark, d):
    return vectors.index_edges(spark, _index(spark, d), 5, exact=True)


@Q("ts13_citation_edges", f"with x as (select 'DOC-' || doc_id as src, unnest(regexp_extract_all(body, 'DOC-[0-9]+')) as dst from ({SHAPED}) b) select src, dst, count(*) as weight from x where src <> dst and dst in (select 'DOC-' || doc_id from documents) group by 1, 2")
def ts13(spark, d):
    b = sql(spark, d, SHAPED, "documents").withColumn("id", F.concat(F.lit("DOC-"), "doc_id"))
    return search.citation_edges(b, "id", F.col("body"), "DOC-[0-9]+", b.select("id"))


@Q("ts14_author_nodes_edges", "with a as (select distinct conv_id as work, unnest(['Ann Lee', 'Bo Day Jr', role]) as a from conversations) select x.a, y.a as b, count(*) as works from a x join a y on x.work = y.work and x.a < y.a group by 1, 2")
def ts14(spark, d):
    c = table(spark, d, "conversations").withColumn("names", F.concat(F.lit("Ann Lee, Bo Day, Jr; "), "role"))
    authored = c.select("conv_id", F.explode(search.split_authors(F.col("names"))).alias("author"))
    return search.coauthor_edges(authored, "conv_id", "author").groupBy("a", "b").agg(F.count(F.lit(1)).alias("works"))


EDGES = "select doc_id::varchar as src, source as dst, 'in_series' as rel from documents union all select doc_id::varchar, t, 'has_topic' from (select doc_id, unnest([lang, 'all']) as t from documents) x"


@Q("ts15_series_topic_edges", EDGES)
def ts15(spark, d):
    t = table(spark, d, "documents")
    key = F.col("doc_id").cast("string")
    topics = F.explode(F.split(F.concat_ws(";", "lang", F.lit("all")), ";"))
    return t.select(key.alias("src"), F.col("source").alias("dst"), F.lit("in_series").alias("rel")).union(t.select(key, topics.alias("dst"), F.lit("has_topic")))


@Q("ts16_rel_counts", f"select rel, count(*) as n from ({EDGES}) e group by 1")
def ts16(spark, d):
    return ts15(spark, d).groupBy("rel").agg(F.count(F.lit(1)).alias("n"))


@Q("sk13_node_edge_export", f"select rel, count(*) as n from ({EDGES}) e group by 1")
def sk13(spark, d):
    from stratalake.plans.storage import written

    return written(ts15(spark, d), "edges").groupBy("rel").agg(F.count(F.lit(1)).alias("n"))
