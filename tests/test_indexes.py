"""Stored indexes of text and vectors against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.functions.stemming import porter
from stratalake.operators import dictionary, pages, postings, search, vectors
from stratalake.operators.postings import Analyzer, TextIndex

#: Published examples of the stemmer's steps.
STEMS = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration digitizer digit radically radic differently differ analogously analog
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formality formal sensitivity sensit sensibility sensibl triplicate triplic formative form formalize formal electricity electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt communism commun activate activ homologous homolog effective effect probate probat rate rate cease ceas controlling control rolling roll generalizations gener oscillators oscil""".split()


def test_stems():
    assert [porter(w) for w in STEMS[::2]] == STEMS[1::2]
    assert [porter(w) for w in ("", "is", "a1b2s", "été")] == ["", "is", "a1b2s", "été"]


def bm25_brute(docs: dict[int, str], query: str, k: int, analyzer: Analyzer) -> list[tuple[int, float]]:
    stop = analyzer.stop_words
    words = lambda t: [porter(w) if analyzer.stems else w for w in re.findall("[a-z0-9]+", (t or "").lower()) if w not in stop]
    bags = {d: Counter(words(t)) for d, t in docs.items()}
    mean = sum(sum(b.values()) for b in bags.values()) / max(len(bags), 1)
    scores: dict[int, float] = {}
    for q in set(words(query)):
        df = sum(q in b for b in bags.values())
        for d, b in bags.items():
            if b[q]:
                idf = math.log(1 + (len(bags) - df + 0.5) / (df + 0.5))
                scores[d] = scores.get(d, 0) + idf * b[q] * 2.2 / (b[q] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean))
    return sorted(((d, round(s, 9)) for d, s in scores.items()), key=lambda x: (-x[1], x[0]))[:k]


def prose(rng, n):
    return " ".join(rng.choice(["house", "houses", "Reading", "read", "the", "river", "rivers", "relational", "of", "walk", "walked", "zebra" if rng.random() < 0.05 else "stone"]) + str(rng.randrange(4)) * (rng.random() < 0.3) for _ in range(n))


def found(df):
    return [(r["doc"], round(r["score"], 9)) for r in df.collect()]


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(postings, "BUCKETS", 4)


def test_text_index_through_updates(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 8)
    analyzer = Analyzer()
    rng = random.Random(2)
    docs = {i: prose(rng, rng.randrange(1, 60)) for i in range(300)} | {300: None, 301: ""}
    frame = lambda d: spark.createDataFrame(list(d.items()), "doc_id long, text string")
    index = TextIndex(spark, f"file://{tmp_path}/index", analyzer)
    assert index.search("house").count() == 0
    index.sync(frame(docs))
    assert found(index.search("nothing")) == found(index.search("the of")) == []
    ask = lambda: [found(index.search(q, 10)) for q in ("houses zebra", "the reading of rivers")]
    want = lambda: [bm25_brute(docs, q, 10, analyzer) for q in ("houses zebra", "the reading of rivers")]
    assert ask() == want()
    for i in range(0, 30, 3):
        docs[i] = prose(rng, 20)
    docs |= {400: "zebra houses", 401: "zebra"}
    for i in (1, 2, 4):
        del docs[i]
    counts = index.sync(frame(docs)).first()
    assert (counts["removed"], counts["added"]) == (3, 12)
    assert ask() == want()
    docs[400] = "rewritten river"
    index.update(frame({400: docs[400]}), frame({401: ""}))
    del docs[401]
    assert ask() == want()
    before = {r["doc"] for r in index.documents().collect()}
    index.merge()
    assert ask() == want() and before == {r["doc"] for r in index.documents().collect()} == set(docs)


def test_sync_brings_in_what_changed(spark, tmp_path):
    index = TextIndex(spark, f"file://{tmp_path}/index")
    docs = spark.createDataFrame([(i, f"river house{i}", "a") for i in range(50)], "doc_id long, text string, f string")
    sync = lambda df: tuple(index.sync(df, "doc_id", "text", "f").first())
    assert sync(docs) == (50, 0) and sync(docs) == (0, 0)
    other = docs.withColumn("f", F.when(F.col("doc_id") == 7, "b").otherwise(F.col("f"))).filter("doc_id <> 9")
    assert sync(other) == (1, 1) and sync(other) == (0, 0)
    assert {r["doc"] for r in index.documents().collect()} == set(range(50)) - {9}
    assert found(index.search("house7"))[0][0] == 7 and found(index.search("house9")) == []


def test_an_update_writes_what_it_brings(spark, tmp_path):
    rng = random.Random(4)
    index = TextIndex(spark, f"file://{tmp_path}/index")
    index.update(spark.createDataFrame([(i, prose(rng, 100)) for i in range(4000)], "doc_id long, text string"))
    rows = lambda: sum(r["n"] for s in (tmp_path / "index/segments").iterdir() for r in spark.read.parquet(f"file://{s}/postings").select("n").collect())
    before = rows()
    index.update(spark.createDataFrame([(i, prose(rng, 100)) for i in range(40)], "doc_id long, text string"))
    assert 0 < rows() - before < 0.02 * before


def test_search_reads_its_buckets_and_skips_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 16)
    docs = {i: "common " * (1 + 20 * (i % 97 == 5)) + "filler " * (i % 40) for i in range(2000)}
    index = TextIndex(spark, f"file://{tmp_path}/index", Analyzer(stems=False, stop_words=frozenset()))
    index.update(spark.createDataFrame(list(docs.items()), "doc_id long, text string").coalesce(1))
    blocks = index.blocks(["common"])
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", blocks._jdf.queryExecution().toString())
    scored, kept = index._scored(index._state(), blocks, 10)
    assert kept.count() < blocks.count() / 2
    assert found(index.search("common", 10)) == bm25_brute(docs, "common", 10, index.analyzer)


@pytest.fixture(scope="module")
def embeddings(spark):
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(12, 16))
    rows = [(i, (middles[i % 12] + rng.normal(size=16) * 0.6).tolist()) for i in range(1500)] + [(2000, [0.0] * 16), (2001, None), (2002, middles[0].tolist()), (2003, middles[0].tolist())]
    return spark.createDataFrame(rows, "id long, e array<float>").repartition(5)


def test_vector_index(spark, embeddings, tmp_path):
    path = f"file://{tmp_path}/index"
    vectors.write_index(embeddings, "id", "e", path, cells=24, k=10, recall=0.95)
    asked = embeddings.filter("id % 10 = 0 or id > 1990")
    want = {tuple(r) for r in search.nearest(asked, embeddings, "id", "e", 10).collect()}
    assert {tuple(r) for r in vectors.search_index(spark, path, asked, "id", "e", 10, exact=True, block=64).collect()} == want
    fast = vectors.search_index(spark, path, asked, "id", "e", 10)
    assert 0.9 <= vectors.recall_of(fast, search.nearest(asked, embeddings, "id", "e", 10)).first()["recall"] <= 1
    assert spark.read.parquet(f"{path}/probes").first()["probes"] < 24
    edges = {tuple(r) for r in vectors.index_edges(spark, path, 5, exact=True).collect()}
    assert edges == {tuple(r) for r in search.similar_edges(embeddings, "id", "e", 5).collect()}


def test_probes_read_their_cells_only(spark, embeddings, tmp_path):
    path = f"file://{tmp_path}/index"
    vectors.write_index(embeddings, "id", "e", path, cells=24, k=10)
    one = embeddings.filter("id = 5")
    found = vectors.search_index(spark, path, one, "id", "e", 10, probes=1)
    assert "PartitionFilters" in found._jdf.queryExecution().toString()
    cells = {r["cell"] for r in found.join(vectors._vectors(spark, path).select(F.col("id").alias("v"), "cell"), "v").collect()}
    assert len(cells) == 1


def test_queries_are_sent_to_parts_not_to_cells(spark, tmp_path, monkeypatch):
    """Without clusters an exact search probes most of 32 cells; a query is still sent once to each of the few parts that hold them."""
    rng = np.random.default_rng(21)
    e = rng.normal(size=(1024, 12)).astype(np.float32)
    e[rng.random(1024) < 0.2] = e[0]  # a cell that several parts share
    df = spark.createDataFrame(list(enumerate(e.tolist())), "id long, e array<float>").repartition(3)
    path = f"file://{tmp_path}/index"
    vectors.write_index(df, "id", "e", path, cells=32, k=5)
    sent = []
    best = vectors._part_best
    monkeypatch.setattr(vectors, "_part_best", lambda parts, *a: sent.append(len(parts.ids)) or best(parts, *a))
    want = sorted(map(tuple, search.neighbours(df, "id", "e", 5).collect()))
    for block, least, most in ((None, 1, 1), (128, 8, 24)):
        sent.clear()
        assert sorted(map(tuple, vectors.search_index(spark, path, df, "id", "e", 5, exact=True, block=block).collect())) == want
        assert len(sent) == 2 and least <= min(sent) <= max(sent) <= most


def test_vector_index_of_nothing(spark, embeddings, tmp_path):
    path = f"file://{tmp_path}/index"
    with pytest.raises(Exception):
        vectors.search_index(spark, path, embeddings, "id", "e", 3)
    few = embeddings.filter("id in (2000, 2001, 2002)")
    vectors.write_index(few, "id", "e", path)
    assert vectors.search_index(spark, path, few, "id", "e", 3, exact=True).count() == 0
    assert {r["v"] for r in vectors.search_index(spark, path, embeddings.filter("id = 2003"), "id", "e", 3).collect()} == {2002}


def test_dictionary_finds_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(1)
    words = ["quadrangle", "quadrangles", "geology", "geologic", "hydrogeology", "salt", "salty", "map", "mpa", "24k", "stratigraphically", "é"]
    slip = lambda w: w[: (i := rng.randrange(len(w)))] + rng.choice(["", "x", w[i] * 2]) + w[i + 1 :]
    rows = [(i, " ".join(rng.choice([w, slip(w)]) for w in rng.choices(words, k=3)), rng.choice(words).upper()) for i in range(400)] + [(400, None, "")]
    items = spark.createDataFrame(rows, "id long, title string, kind string")
    path, fields = f"file://{tmp_path}/words", {"title": 4.0, "kind": 2.0}
    dictionary.write_dictionary(items, "id", list(fields), path)
    for query in (["geology"], ["quadrangle", "map"], ["stratigraphically"], ["salt", "geo"], ["24k"], ["nothing"]):
        want = {tuple(r) for r in search.keyword_search(items, "id", fields, query).collect()}
        assert {tuple(r) for r in dictionary.dictionary_search(spark, path, "id", fields, query).collect()} == want
    plan = dictionary.matching_words(spark, path, "geology")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(word,geology)" in plan and re.search(r"PushedFilters: \[[^\]]*In\(variant", plan)


def test_pages_at_any_depth(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, *range(9)])) for i in range(3000)]
    df, order = spark.createDataFrame(rows, "id long, v int"), [("v", False), ("id", True)]
    path = f"file://{tmp_path}/pages"
    pages.write_pages(df, order, path, 400)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for offset, limit in ((0, 5), (390, 30), (2980, 50), (5000, 5)):
        assert [tuple(r) for r in pages.read_page(spark, path, limit, offset).collect()] == want[offset : offset + limit]
    assert pages.total(spark, path) == 3000
    one = pages.read_page(spark, path, 5, 1000)
    assert re.search(r"PartitionFilters: \[[^\]]*_block", one._jdf.queryExecution().executedPlan().toString()) and len(one.inputFiles()) >= 1
    for at in (0, 1, 399, 1700, 2999):
        assert pages.place_of(spark, path, order, dict(zip(("id", "v"), want[at]))) == at


def test_many_blocks_come_from_few_ranges(spark, tmp_path):
    """The tasks that write pages, and the rows sampled for their bounds, don't grow with the blocks."""
    path, order = f"file://{tmp_path}/pages", [("v", False), ("id", True)]
    df = spark.range(20000).select("id", (F.col("id") * 7919 % 20000 % 9000).alias("v"))
    pages.write_pages(df, order, path, 20)
    stored = spark.read.parquet(f"{path}/rows")
    blocks = stored.groupBy("_block").count()
    assert blocks.count() >= 1000 and blocks.agg(F.max("count")).first()[0] <= 20
    tasks = {re.search(r"part-([0-9]+)", f)[1] for f in stored.inputFiles()}
    assert len(tasks) <= pages.RANGES
    want = sorted(((r["id"], r["v"]) for r in df.collect()), key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in pages.read_page(spark, path, 45, 12345).collect()] == want[12345:12390]
    assert pages.place_of(spark, path, order, {"id": want[17003][0], "v": want[17003][1]}) == 17003


def test_words_are_counted_without_a_shuffle(spark, monkeypatch):
    """The counts of each text, whatever is counted at a time, with no shuffle of its words."""
    monkeypatch.setattr(search, "BATCH_WORDS", 5)
    texts = [(1, "b a b"), (2, None), (3, ""), (4, "a " * 9 + "c"), (5, "Running runs b")]
    df = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    found, _ = search.text_index(df, "id", F.col("text"))
    want = {(w, i, n) for i, t in texts for w, n in Counter((t or "").lower().split()).items()}
    assert {tuple(r) for r in found.collect()} == want
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    stems = search.word_counts(df, "id", search.terms(F.col("text")), porter).filter("id = 5")
    assert {tuple(r) for r in stems.collect()} == {(5, "run", 2), (5, "b", 1)}
    hashed = search.hashed_vector(F.col("text"), 4)
    assert str(hashed).count("regexp_extract_all") == 1
    assert [sum(r[0]) for r in df.select(hashed).collect()] == [3, 0, 0, 10, 3]


def test_probes_come_in_bounded_batches(monkeypatch):
    import pyarrow as pa

    class Cells:
        ids = np.arange(50)

        def order(self, e):
            return np.zeros((len(e), 50)), np.zeros((len(e), 50))

    monkeypatch.setattr(vectors, "PROBE_ROWS", 1000)
    queries = pa.record_batch({"id": pa.array(range(700)), "e": pa.array([[1.0, 2.0]] * 700), "least": pa.array([0.0] * 700)})
    sizes = [b.num_rows for b in vectors._prober(Cells(), lambda order, angles, least: np.ones(order.shape, bool))(iter([queries]))]
    assert sum(sizes) == 700 * 50 and max(sizes) <= 1000


def test_neighbours_in_few_large_blocks(spark, monkeypatch):
    """A vector is sent once to each block, and blocks are as large as a task can hold: 98 of 2,048 vectors would have made 98 copies of each."""
    _, n, _ = search.blocked(spark.range(200_000).withColumn("e", F.array(F.lit(1.0), F.col("id") + 1.0)), "id", "e", None)
    assert n == 1
    rng = np.random.default_rng(12)
    e = rng.integers(-2, 3, (400, 4)).astype(np.float32)
    e[rng.random(400) < 0.3] = [1, 2, 0, 0]  # a vector that many have
    e[~e.any(1)] = 1
    ids = rng.permutation(400) * 3
    unit = e.astype(float) / np.sqrt((e.astype(float) ** 2).sum(1, keepdims=True))
    s = np.round(np.einsum("ij,kj->ik", unit, unit), 12)
    np.fill_diagonal(s, -np.inf)
    want = sorted((int(ids[x]), int(ids[y]), s[x, y]) for x in range(400) for y in np.lexsort((ids, -s[x]))[:5])
    df = spark.createDataFrame(list(zip(ids.tolist(), e.tolist())), "id long, e array<float>")
    monkeypatch.setattr(search, "TILE", 50)
    monkeypatch.setattr(search, "EXACT_PAIRS", 300)
    for block in (None, 70, 1000):
        for got in (search.neighbours(df, "id", "e", 5, block), search.nearest(df, df, "id", "e", 5, block)):
            got = sorted(map(tuple, got.collect()))
            assert [g[:2] for g in got] == [w[:2] for w in want] and [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_block_best_is_that_of_a_full_sort():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    e = rng.integers(-2, 3, (300, 3)).astype(np.float32)  # many ties
    e[~e.any(1)] = 1
    ids = rng.permutation(300)
    block = pa.table({"id": pa.array(ids), "e": pa.array(e.tolist(), pa.list_(pa.float32()))})
    unit = e[np.argsort(ids)].astype(float)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    s = np.round(unit @ unit.T, 12)
    np.fill_diagonal(s, -np.inf)
    for k in (5, 299, 400):
        want = [(q, v, s[q, v]) for q in range(300) for v in np.argsort(-s[q], kind="stable")[:k] if v != q]
        got = search.block_best(k)(block, block)
        assert list(zip(*(got[c].to_pylist() for c in ("q", "v", "s")))) == want
