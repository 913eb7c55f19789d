"""Each operator on the small corpus against brute force, and on empty and odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import components, digests, jaccard, kernels, language, lines, lm, mixing, packing, personal, quality, repeats

W = re.compile(r"[^\x20\x09-\x0D]+")
low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t)
ODD = {
    "repeats": repeats.repeated_spans, "lm": lm.backoff_scores, "language": lambda d: language.identify(d.select("doc_id", "text"), language.train(d)), "packing": packing.pack_documents,
    "lines": lines.dedup_lines, "jaccard": jaccard.component_ids, "keep_one": jaccard.keep_one, "personal": personal.personal_data, "digests": digests.compare_edited, "quality": quality.quality_verdicts,
    "keep_good": quality.keep_good, "mixing": mixing.mix_sources, "rounded": lambda d: mixing.rounded(mixing._sizes(d), mixing.source_targets(mixing._sizes(d))),
}


@pytest.mark.parametrize("name", sorted(ODD))
def test_empty_table(empty, name):
    assert ODD[name](empty).count() == 0


@pytest.mark.parametrize("name", sorted(ODD))
def test_odd_table(odd, name):
    out = ODD[name](odd)
    rows = out.collect()
    if name in ("lm", "language", "jaccard", "personal", "digests", "quality", "lines"):
        assert len(rows) == odd.count()
    if name == "rounded":
        assert sum(r["rows"] for r in rows) == odd.count()
    if name in ("lines", "keep_one", "keep_good", "mixing"):
        assert out.columns == odd.columns


@pytest.fixture(scope="module")
def very_long(spark):
    """A text of more than 10 MB among short ones, with a passage that they share."""
    rng = np.random.default_rng(6)
    words = ["".join(chr(97 + x) for x in w) for w in rng.integers(0, 26, (5000, 5))]
    passage = " ".join(words[:80])
    text = " ".join(words[i] for i in rng.integers(0, 5000, 1_800_000)) + " " + passage
    rows = [(1, text, "en", "a", len(text))] + [(i, f"{passage} own{i} {' '.join(words[j] for j in rng.integers(0, 5000, 60))}", "en", "a", 0) for i in range(2, 12)]
    assert len(text) > 10_000_000
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()


@pytest.mark.parametrize("name", sorted(set(ODD) - {"rounded", "keep_good", "keep_one"}))
def test_very_long_text(very_long, name):
    ids = {r["doc_id"] for r in ODD[name](very_long).select("doc_id").collect()}
    assert 1 in ids and (name == "mixing" or ids == set(range(1, 12)))


def test_repeats_are_found_and_survive_insertions(spark, corpus):
    passage = " ".join(f"passage{i % 17} word{i}" for i in range(40))
    rows = [(i, f"{'abcdefghijklmnopqrstuvwxyz'[i:]}{t[1][:400]} {passage if i in (3, 8, 11) else ''} {t[1][400:]}") for i, t in enumerate(corpus[20:40])]
    found = repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == {3, 8, 11}
    for r in found:
        span = dict(rows)[r["doc_id"]].encode()[r["start"] : r["end"]].decode()
        assert len(set(span.split()) & set(passage.split())) >= 10 and r["first_doc_id"] == 3
        assert (r["n_copies"] == 0) == (r["doc_id"] == 3)


def test_copies_are_dropped_from_texts(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöé") for _ in range(rng.randrange(3, 8))) for _ in range(n))
    passage, rows = prose(80), []
    for i in range(6):
        a, b = prose(30), prose(30)
        rows.append((i, f"{a} {passage} {b}" if i < 4 else f"{a} {b}", i, a, b))
    rows += [(9, None, 1, "", ""), (10, "", 1, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int, a string, b string")
    got = {r["doc_id"]: r for r in repeats.deduplicated(docs).collect()}
    assert got[0]["text"] == rows[0][1] and got[5]["text"] == rows[5][1] and got[9]["text"] is None and got[10]["text"] == ""
    assert repeats.deduplicated(docs).columns == docs.columns and got[3]["spans"] == 3
    for i in (1, 2, 3):
        left = got[i]["text"]
        assert len(left) < len(rows[i][1]) - len(passage) + 20 and left.startswith(rows[i][3][:-1]) and left.endswith(rows[i][4][1:])


def test_short_passages_are_found_to_their_ends(spark):
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 8))) for _ in range(n))
    rows, want = [], {}
    for i in range(300):
        passage = prose(51 + i % 10)
        for j in (2 * i, 2 * i + 1):
            before = prose(60) + " "
            rows.append((j, before + passage + " " + prose(60)))
            want[j] = (len(before), len(before) + len(passage))
    got = defaultdict(list)
    for r in repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r["doc_id"]].append((r["start"], r["end"]))
    whole = sum(any(s <= a and b <= e and e - s <= b - a + 12 for s, e in got[d]) for d, (a, b) in want.items())
    assert whole >= 0.99 * len(want)
    assert sum(len(v) for v in got.values()) <= 1.01 * len(want)


def test_extension_goes_on_where_chunks_do_not_agree(spark):
    """Without cuts by content, chunks before the common end fall at different places in both texts."""
    dull, tail = "a" * 1500, "".join(chr(97 + x % 26) for x in np.random.default_rng(3).integers(0, 1 << 20, 400))
    rows = [(0, "Z" * 40 + dull + tail), (1, "Q" * 77 + dull + tail)]
    found = repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in found) == [(0, 40, 1940), (1, 77, 1977)]


def test_chunk_ends_do_not_depend_on_neighbours(corpus):
    texts = [(t[1] or "").encode() for t in corpus]
    alone = [repeats.chunk_ends(np.frombuffer(t, np.uint8), np.array([0, len(t)])).tolist() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    together = repeats.chunk_ends(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert sorted(x + o for a, o in zip(alone, offsets) for x in a) == together.tolist()


def backoff_brute(texts, order):
    """(n_words, log_score) of each text, every one a document of its own."""
    grams = lambda w: Counter(tuple(w[j : j + n]) for n in range(1, order + 1) for j in range(len(w) - n + 1))
    words = [W.findall(t or "") for t in texts]
    all_, out = Counter(), []
    for w in words:
        all_.update(grams(w))
    for w in words:
        own, score = grams(w), 0.0
        left = lambda g: all_[g] - own[g]
        for j in range(len(w)):
            n = most = min(order, j + 1)
            while n > 1 and not left(tuple(w[j - n + 1 : j + 1])):
                n -= 1
            g = tuple(w[j - n + 1 : j + 1])
            over = left(g[:-1]) if n > 1 else max(sum(map(len, words)) - len(w), 1)
            score += (most - n) * math.log(0.4) + math.log(max(left(g), 0.5) / over)
        out.append((len(w), score if w else None))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_scores_of_any_order(docs, corpus, order, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 20_000)  # several chunks and buckets
    monkeypatch.setattr(lm, "BUCKET_BYTES", 30_000)
    got = {r["doc_id"]: r for r in lm.backoff_scores(docs, order).collect()}
    for (doc_id, *_), (n, score) in zip(corpus, backoff_brute([t[1] for t in corpus], order)):
        assert got[doc_id]["n_words"] == n and (got[doc_id]["log_score"] is None) == (n == 0)
        assert not n or got[doc_id]["log_score"] == pytest.approx(score) and got[doc_id]["mean_log_score"] == pytest.approx(score / n)


@pytest.mark.parametrize("n", [1, 4])
def test_backoff_scores_of_repeated_rows(spark, corpus, n, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 5000)
    rows = [(t[0] if t[0] % 7 else None, t[1]) for t in corpus[:20]]
    one = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
    got = lm.backoff_scores(one.union(one)).collect()
    want = backoff_brute([t for _, t in rows * 2], lm.ORDER)
    key = lambda v: sorted((x is None, x) for x in v)
    assert lm.ORDER >= 3 and key([r["n_words"] for r in got]) == key([x[0] for x in want])
    assert [x for _, x in key([r["log_score"] for r in got])] == pytest.approx([x for _, x in key([x[1] for x in want])])


def test_ngram_counts_are_those_of_the_texts(docs, corpus):
    got = lm.ngram_counts(docs, 2).groupBy("n").agg(F.count("*").alias("kinds"), F.sum("total").alias("all")).collect()
    words = [W.findall(t[1] or "") for t in corpus]
    one, two = Counter(x for w in words for x in w), Counter(p for w in words for p in zip(w, w[1:]))
    assert {r["n"]: (r["kinds"], r["all"]) for r in got} == {1: (len(one), sum(one.values())), 2: (len(two), sum(two.values()))}


def test_language_model_scores_are_exact(spark, corpus):
    """The tabulated code lengths equal a plain walk down the orders."""
    sample = spark.createDataFrame([(t[2], t[1]) for t in corpus[:9]], "lang string, text string")
    model = language.Model(language.gram_counts(sample, language.ORDER).toArrow(), language.ORDER)
    counts = defaultdict(Counter)
    for _, text, lang, *_ in corpus[:9]:
        data = (language.START + text).encode()
        for i in range(3, len(data)):
            for k in range(4):
                counts[lang, data[i - k : i]][data[i]] += 1
    for text in ("the green river", "über den fluß \x01", "zzz", ""):
        data = (language.START + text).encode()
        bits = model.code_lengths(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
        for j, lang in enumerate(model.langs):
            total = 0.0
            for i in range(3, len(data)):
                for k in range(3, -1, -1):
                    c = counts.get((lang, data[i - k : i]))
                    if c is None:
                        continue
                    if c[data[i]]:
                        total -= math.log2(c[data[i]] / (sum(c.values()) + len([v for v in c.values() if v])))
                        break
                    total -= math.log2(len([v for v in c.values() if v]) / (sum(c.values()) + len([v for v in c.values() if v])))
                else:
                    total += 8
            assert bits[j] == pytest.approx(total, rel=1e-4, abs=1e-3)


def test_language_is_predicted(docs, corpus):
    got = {r["doc_id"]: r for r in language.identify(docs.select("doc_id", "text"), language.train(docs)).collect()}
    assert sum(got[t[0]]["lang_pred"] == t[2] for t in corpus[:60]) >= 58
    assert {got[i]["lang_pred"] for i in (200, 201, 202, 302)} == {"und"} and all(0 <= r["score"] <= 1 for r in got.values())


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + i)}{chr(0x5E00 + i)} " * 50, f"l{i:03}") for i in range(80)] + [(200 + i, "one of a few long texts " * 400, "long") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").filter((language.fold(F.col("doc_id")) != 2))
    want = {r["lang"] for r in docs.select("lang").distinct().collect()}
    assert {r["lang"] for r in language.training_sample(docs, 100_000).select("lang").distinct().collect()} == want
    assert {r["lang"] for r in language.training_sample(docs, 1).select("lang").distinct().collect()} == want


def test_mix_comes_near_its_targets_and_repeats(docs):
    run = lambda: sorted((r["doc_id"], r["size"], r["source"] or "", r["source_size"], r["target"], r["copies"]) for r in mixing.rounded(mixing._sizes(docs), mixing.source_targets(mixing._sizes(docs))).collect())
    rows = run()
    assert rows == run()
    total = sum(r[1] for r in rows)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[2]].append(r)
        assert 0 <= r[5] <= 3
    assert sum(v[0][4] for v in by_source.values()) == pytest.approx(total)
    for source, v in by_source.items():
        assert v[0][3] == sum(r[1] for r in v) and v[0][4] <= 3 * v[0][3] + 1e-9
        assert abs(sum(r[1] * r[5] for r in v) - v[0][4]) <= max(r[1] for r in v)


def targets_brute(totals):
    """Water filling by bisection: each source gets its weight's share, but at most three times what it has."""
    order = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    low, high, want = 0.0, 4.0 * sum(totals.values()), sum(totals.values())
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(level * weight[s], 3 * totals[s]) for s in order) < want else (low, level)
    return {s: min(high * weight[s], 3 * totals[s]) for s in order}


@pytest.mark.parametrize("totals", [{"a": 100, "b": 900, "c": 10}, {"a": 5, "b": 1, None: 1000}, {"a": 7, "b": 7, "c": 7, "d": 7, "e": 400, None: 3}, {"a": 12}])
def test_targets_are_those_of_water_filling(spark, totals):
    rows = [(i, s, n) for i, (s, n) in enumerate(totals.items())]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    assert got == pytest.approx(targets_brute(totals))


def test_rows_that_agree_share_their_copies(spark):
    """Hot ids: many rows without one, and repeated rows, fill no block and keep the mix whole."""
    rows = [(None, "alpha beta gamma", "a")] * 70 + [(None, f"w{i} beta gamma", "a") for i in range(70)] + [(i, "one two three four", "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    sizes = mixing._sizes(docs)
    out = mixing.rounded(sizes, mixing.source_targets(sizes)).collect()
    assert sum(r["rows"] for r in out) == len(rows) and max(r["rows"] for r in out) == 140
    want = {r["source"]: r["target"] for r in out}
    taken = Counter()
    for r in out:
        taken[r["source"]] += r["copies"] * r["size"]
        assert abs(r["copies"] - r["rows"] * r["target"] / r["source_size"]) < 2
    mix = mixing.mix_sources(docs).collect()
    assert Counter({s: sum(len(r["text"].split()) for r in mix if r["source"] == s) for s in want}) == taken
    each = Counter(r["text"] for r in mix if r["source"] == "a" and r["text"].startswith("w"))
    assert max(each.values()) - min(each.get(f"w{i} beta gamma", 0) for i in range(70)) <= 1


def test_copies_are_unbiased(spark):
    sizes = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 200, "a").otherwise("b").alias("source"), (1 + F.col("id") % 37).alias("size"))
    targets = mixing.source_targets(sizes)
    mean = np.mean([[r["copies"] for r in sorted(mixing.rounded(sizes, targets, seed).collect(), key=lambda r: r["doc_id"])] for seed in range(6)], axis=0)
    want = {r["source"]: r["target"] / r["source_size"] for r in targets.collect()}
    assert mean[:200].mean() == pytest.approx(want["a"], abs=0.08) and mean[200:].mean() == pytest.approx(want["b"], abs=0.08)


def test_packing(docs, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, used, places = defaultdict(list), defaultdict(int), defaultdict(list)
    for r in packing.pack_documents(docs).collect():
        pieces[r["doc_id"]].append(r)
        used[r["sequence_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text, *_ in corpus:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and all(r["length"] == 2048 for r in own[1:])
        at = 0
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for s, v in places.items():
        assert used[s] <= 2048 and all(o == sum(n for p, n in v if p < o) for o, _ in v)
    assert len(used) <= -(-sum(used.values()) // 2048) + 1


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "a \nb\n\n c", "x  y", "it's 12 'll <|endoftext|> end", "über  ß\t z", "", "a　 b  c"])
def test_remembered_words_give_the_tokenizers_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    paths = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]
    assert np.frombuffer(packing._encoder(*paths)(text), "<u4").tolist() == Tokenizer.from_file(paths[0]).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(8))
def test_reduction_never_costs_a_sequence(seed):
    """On small instances the plan is as good as an exhaustive search."""
    rng = np.random.default_rng(seed)
    items = rng.integers(1, 21, 8).tolist()

    def best(rest: list[int], bins: list[int]) -> int:
        if not rest:
            return len(bins)
        out, seen = len(bins) + len(rest), set()
        for i, b in enumerate(bins):
            if b + rest[0] <= 20 and b not in seen:
                seen.add(b)
                out = min(out, best(rest[1:], [*bins[:i], b + rest[0], *bins[i + 1 :]]))
        return min(out, best(rest[1:], [*bins, rest[0]]))

    plan = packing.Plan(dict(Counter(items)), 20)
    assert sum(m for _, m in plan.groups) <= best(sorted(items, reverse=True), []) + 1
    assert Counter(x for g, m in plan.groups for x, k in g for _ in range(k * m)) == Counter(items)
    reduced = packing.Plan.__new__(packing.Plan)
    reduced.capacity, reduced.left, reduced.groups = 20, dict(Counter(items)), []
    reduced.reduce()
    rest = [x for x, n in reduced.left.items() for _ in range(n)]
    assert sum(m for _, m in reduced.groups) + best(sorted(rest, reverse=True), []) == best(sorted(items, reverse=True), [])


def kept_lines(corpus, min_docs=5):
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t, *_ in corpus:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                held[key(x)].add(i)
    return {i: [x for x in (t or "").split("\n") if len(held[key(x)]) < min_docs or max(held[key(x)]) == i] for i, t, *_ in corpus}


def test_line_dedup(docs, corpus, monkeypatch):
    want = kept_lines(corpus)
    assert sum((t or "") != "\n".join(want[i]) for i, t, *_ in corpus) == 14
    for salt in (500, 2):  # with few documents a salt, several rounds are needed
        monkeypatch.setattr(lines, "SALT_DOCS", salt)
        got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
        assert {i: t or "" for i, t in got.items()} == {i: "\n".join(v) for i, v in want.items()}


def jaccard_brute(corpus):
    sets = {}
    for i, t, *_ in corpus:
        w = W.findall(low(t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    forest = components.Forest()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                forest.join(a, b)
    return {i: (len(s), forest.find(i)) for i, s in sets.items()}


def test_jaccard_join(docs, corpus, monkeypatch):
    want = jaccard_brute(corpus)
    assert {want[i][1] for i in (7, 100, 101, 102)} == {7}
    for most, block in ((1000, 500), (2, 2), (1, 1)):  # small limits make longer prefixes, pivots and blocks
        monkeypatch.setattr(jaccard, "CLUSTER_DOCS", most)
        monkeypatch.setattr(jaccard, "BLOCK_DOCS", block)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.component_ids(docs).collect()} == want
    kept = {r["doc_id"] for r in jaccard.keep_one(docs).collect()}
    assert kept == {i for i, (_, c) in want.items() if c == i}


def test_jaccard_deals_shingles_in_batches(spark, docs):
    """A row for each bucket of a task, not for each shingle; what several hold comes back with their ids."""
    known = docs.filter("doc_id is not null and text is not null").coalesce(1)
    dealt = jaccard.prefixes(known, 8, 4)
    assert 0 < dealt.count() <= 4
    ids = np.array([-(1 << 62), 5, 5, 1 << 62, -1, 0])
    assert jaccard._from_planes(jaccard._planes(ids)).tolist() == ids.tolist()
    token = np.array([3 << 40, 7, 3 << 40, 9 << 33, 7, 7], np.uint64)
    batch = pa.Table.from_batches([jaccard._dealt(token, ids, 4)])
    assert batch.column("bucket").to_pylist() == [0, 2]
    held = [jaccard._held_by_several(batch.slice(x, 1)).to_pydict() for x in (0, 1)]
    by_token = defaultdict(list)
    for doc, tok in zip(held[0]["doc"], held[0]["tok"]):
        by_token[tok].append(doc)
    assert [by_token[t] for t in sorted(by_token)] == [ids[[0, 2]].tolist(), ids[[1, 4, 5]].tolist()]  # the rarer one first
    assert held[1] == {"doc": [], "tok": []}


def test_jaccard_blocks_meet_where_sizes_can_link(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    rows = [(n, " ".join(words[:n])) for n in range(8, 400, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    large = spark.createDataFrame([(n, 8, n - 4) for n, _ in rows], "doc long, cluster long, n long")
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 3)
    none = spark.createDataFrame([], "u bigint, v bigint")
    placed = []
    monkeypatch.setattr(jaccard, "pivot_links", lambda *a: none)
    monkeypatch.setattr(jaccard, "links", lambda docs, df, k: placed.extend(df.collect()) or none)
    jaccard.large_links(docs, large, 2).collect()
    blocks = {}
    for r in placed:
        blocks.setdefault(r["b"], []).append(r["doc"] - 4)
    met = {(r["doc"] - 4, n) for r in placed for o in r["others"] for n in blocks.get(o, [])}
    assert {(x - 4, y - 4) for x, _ in rows for y, _ in rows if 4 * min(x - 4, y - 4) >= 3 * max(x - 4, y - 4)} <= met
    assert all(min(p) * 16 >= max(p) * 8 for p in met) and len(placed) == len(rows)


def test_jaccard_on_chains_and_hot_groups(spark, monkeypatch):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[: 60 + i])) for i in range(60)] + [(100 + i, " ".join(base[:60]) + f" own{i} tail{i}") for i in range(40)]
    want = {i: v[1] for i, v in jaccard_brute(rows).items()}
    for pivots in (16, 2):
        monkeypatch.setattr(jaccard, "CLUSTER_DOCS", 20)
        monkeypatch.setattr(jaccard, "BLOCK_DOCS", 7)
        monkeypatch.setattr(jaccard, "PIVOTS", pivots)
        assert {r["doc_id"]: r["component_id"] for r in jaccard.component_ids(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want


def test_rows_without_an_id_are_kept(spark):
    text = lambda x: " ".join(f"{x}{j}" for j in range(30))
    rows = [(1, text("a")), (2, text("b")), (2, text("c")), (3, text("a")), (None, text("d")), (None, text("e")), (None, text("e")), (None, text("b")), (None, None), (None, "")]
    run = lambda n: sorted(((r["doc_id"] or 0, r["text"] or "") for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()))
    got = run(1)
    assert got == sorted([(0, ""), (0, ""), (0, text("d")), (0, text("e")), (1, text("a")), (2, text("b")), (2, text("c"))]) == run(5)


@pytest.mark.parametrize("few", [0, 100_000])
def test_components(spark, few):
    rng = np.random.default_rng(few)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(30)]
    forest = components.Forest()
    for a, b in pairs:
        forest.join(a, b)
    got = {r["u"]: r["v"] for r in components.components(spark.createDataFrame(pairs, "a long, b long").repartition(6), few).collect()}
    assert got == dict(forest.links())


def test_verified_agrees_with_sets():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 40, 80).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(80) < 0.93], rng.integers(0, 1 << 40, rng.integers(0, 20)).astype(np.uint64)))) for _ in range(60)]
    forest = components.Forest()
    for a in range(60):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                forest.join(a, b)
    for share in jaccard.SHARES:
        assert dict(jaccard.verified(list(range(60)), sets, share)) == dict(forest.links())
    both = components.Forest()
    for part in (range(30), range(30, 60)):
        for u, v in jaccard.verified(list(part), [sets[x] for x in part], 8):
            both.join(u, v)
    for u, v in jaccard.verified(list(range(60)), sets, 8, [int(x >= 30) for x in range(60)]):
        both.join(u, v)
    assert dict(both.links()) == dict(forest.links())


def test_personal_data_rules():
    import random

    rng = random.Random(3)
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda s: re.sub("[^0-9]", "", s)
    for n in range(20000):
        t = "".join(rng.choice("1234567890.@-+ ab.c(é") for _ in range(rng.randint(0, 40)))
        want = [(m.start(), 0, m.end()) for m in email.finditer(t)] + [(m.start(), 1, m.end()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
        want += [(m.start(), 2, m.end()) for m in card.finditer(t) if 12 <= len(digits(m.group())) <= 19 and personal.luhn(digits(m.group()))]
        want += [(m.start(), 3, m.end()) for m in phone.finditer(t) if 9 <= len(digits(m.group())) <= 15]
        assert personal.base_spans(t) == sorted(want)
    assert personal.luhn("4111111111111111") and not personal.luhn("4111111111111112")
    assert personal.base_spans("9" * 200_000 + "@" * 1000) == []


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"filler words before. please phone me under +1 (555) 010-{1000 + i} today {'and more text ' * (i % 3)}") for i in range(12)]
    rows += [(50, "again please phone me under 555-0177-22 at noon"), (51, "the year 20201-5 is no number to find"), (52, None)]
    got = {r["doc_id"]: r for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)[50]
    at = text.index("555")
    assert got[50]["spans"] == f"phone:{at}:{at + 11}" and got[50]["n_phone"] == 0
    assert got[51]["spans"] == "" and got[52]["spans"] == "" and got[3]["spans"] == got[3]["base"]


def test_identifiers_in_groups_are_discovered(spark):
    rows = [(i, f"please phone me under +1 (555) 010-{1000 + i} today") for i in range(30)]
    cards = [c for c in (f"4111 1111 1111 {n}" for n in range(1000, 1400)) if personal.luhn(c.replace(" ", ""))][:20]
    rows += [(100 + i, f"from my credit card {c} please") for i, c in enumerate(cards)]
    new = {200: ("phone", "555 867 5309"), 201: ("phone", "(555) 867-5309"), 202: ("phone", "555.867.5309"), 203: ("card", "4111 1111 1111 1112"), 204: ("phone", "5" * 70)}
    rows += [(i, f"{'please phone me under' if k == 'phone' else 'from my credit card'} {x} or so") for i, (k, x) in new.items()]
    got = {r["doc_id"]: r["spans"] for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (k, x) in new.items():
        at = dict(rows)[i].index(x)
        assert got[i] == f"{k}:{at}:{at + len(x)}"


def test_held_out_identifiers_are_recovered(spark):
    """Seeds are hidden by a change that the rules do not take; their contexts and shapes give them away, and decoys stay."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    card = lambda: next(c for c in iter(lambda: f"4{n(3)} {n(4)} {n(4)} {n(4)}", None) if personal.luhn(c.replace(" ", "")))
    wrong = lambda c: c[:-1] + str((int(c[-1]) + 1) % 10)
    secret = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    kinds = {
        "phone": (["call me at", "reach us under", "phone number is"], lambda: f"+1 ({n(3)}) 555-{n(4)}", lambda: rng.choice([f"({n(3)}) 555-{n(4)}", f"{n(3)}-555-{n(4)}", f"{n(3)} 555 {n(4)}"])),
        "card": (["charge my card", "visa number is", "pay with card"], card, lambda: wrong(card())),
        "email": (["write to", "email me at", "contact address is"], lambda: f"{word()}@mail{n(1)}.example.com", lambda: f"{word()}@mailhost{n(1)}"),
        "ip": (["connect to host", "server address is", "ping host"], lambda: f"10.{rng.randint(0, 99)}.{rng.randint(0, 99)}.{rng.randint(0, 99)}", lambda: f"10.{rng.randint(0, 99)}.{rng.randint(300, 999)}.{rng.randint(0, 99)}"),
        "secret": (["token =", "api key", "password is"], secret, lambda: secret()[:24]),
    }
    rows, hidden, decoys = [], {}, set()
    for i in range(3000):
        kind = list(kinds)[i % 5]
        contexts, seen, changed = kinds[kind]
        hide = rng.random() < 0.15
        value = changed() if hide else seen()
        text = f"{' '.join(word() for _ in range(rng.randint(3, 20)))} {rng.choice(contexts)} "
        if hide:
            hidden[i] = f"{kind}:{len(text)}:{len(text) + len(value)}"
        rows.append((i, text + value + " " + " ".join(word() for _ in range(5))))
    for i in range(3000, 3300):
        decoys.add(i)
        rows.append((i, f"{' '.join(word() for _ in range(8))} {rng.choice(['order', 'invoice', 'parcel'])} {rng.choice([n(9), 'x' + n(7), n(4) + '/' + n(4)])} {word()} {word()}"))
    got = {r["doc_id"]: r["spans"] for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    recall = {k: np.mean([s in got[i].split(",") for i, s in hidden.items() if s.startswith(k)]) for k in kinds}
    assert len(hidden) > 400 and min(recall.values()) >= 0.9, recall
    assert sum(bool(got[i]) for i in decoys) <= 3


def test_chains_of_patterns_are_followed_to_their_end(spark):
    phones = [f"+1 (555) 010-{1000 + i}" for i in range(16)]
    level = lambda k: [f"555-0{k}-77{i}" for i in range(4)]
    rows = []
    for k in range(7):
        for x in [*(phones[:12] + level(k) if k else phones), *level(k + 1)]:
            rows.append((len(rows), f"w{len(rows)} alpha{k} {x} end"))
    got = {r["doc_id"]: r["spans"] for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].startswith("phone:") for i, _ in rows)


@pytest.mark.parametrize("bucket", [8 << 20, 2000])
def test_fingerprints(docs, corpus, monkeypatch, bucket):
    monkeypatch.setattr(digests, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(digests, "RANGES", 1000 if bucket > 5000 else 3)
    monkeypatch.setattr(digests, "RANGE_BYTES", 500)
    got = {r["doc_id"]: r for r in digests.compare_edited(docs).collect()}
    order = sorted(corpus, key=lambda t: t[0])
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[doc_id]["n_chars"] == len(text)
        assert 0 <= got[doc_id]["near_edited"] <= 1 and 0 <= got[doc_id]["near_next"] <= 1
        if edited == text:
            assert got[doc_id]["near_edited"] == 1 and got[doc_id]["edited_fingerprint"] == got[doc_id]["fingerprint"]
    assert got[7]["fingerprint"] == got[100]["fingerprint"] and got[100]["near_next"] > 0.7
    assert np.mean([got[i]["near_next"] for i in range(50)]) < 0.2 < np.mean([got[i]["near_edited"] for i in range(50)])


def test_hot_and_missing_ids_are_followed(spark, monkeypatch):
    """Many rows of one id or of none, in buckets of a few rows: each is followed by the next in the order (nulls first, id, hash of the text)."""
    monkeypatch.setattr(digests, "BUCKET_BYTES", 300)
    monkeypatch.setattr(digests, "RANGE_BYTES", 100)
    rows = [(None, f"none {i}") for i in range(40)] + [(7, f"seven {i}") for i in range(40)] + [(i, f"other {i}") for i in range(8, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = df.withColumn("t", F.xxhash64("text")).orderBy(F.asc_nulls_first("doc_id"), "t").collect()
    want = {}
    for r, after in zip(order, order[1:] + order[:1]):
        half = len(r["text"]) // 2
        want[r["text"]] = hashlib.sha256((r["text"][: len(r["text"]) - half] + after["text"][:half]).encode()).hexdigest()
    got = Counter(r["edited_sha256"] for r in digests.compare_edited(df).collect())
    assert got == Counter(want.values())


def test_entropy_depends_on_the_window_alone():
    rng = np.random.default_rng(1)
    x = rng.integers(97, 110, 3000).astype(np.uint8)
    bins = digests.entropy_bins(x)
    for i in range(0, len(bins), 101):
        assert sum(int(digests._SUM[v]) for v in Counter(x[i : i + 64].tolist()).values()) * digests.BINS // digests._MOST == bins[i]
    assert digests.entropy_bins(np.tile(x, 60))[3000 * 41 + 5] == bins[5]


def test_likeness_in_blocks(monkeypatch):
    """Blocks don't change a likeness, and the chains of texts of 100 MB (118 filters a MB) are compared in bounded memory."""
    import tracemalloc

    rng = np.random.default_rng(4)
    chain = lambda n: rng.integers(0, 1 << 63, (n, digests.FILTER_BYTES // 8), dtype=np.uint64) & rng.integers(0, 1 << 63, (n, digests.FILTER_BYTES // 8), dtype=np.uint64)
    a, b = chain(37), chain(61)
    b[5:20] = a[10:25]
    whole = digests.likeness(a, b)
    monkeypatch.setattr(digests, "PAIRS", 100)
    assert digests.likeness(a, b) == whole == digests.likeness(b, a) and whole > 15 / 37
    monkeypatch.undo()
    long = chain(11_800)
    tracemalloc.start()
    assert digests.likeness(long, long[::-1]) == 1
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_quality_counts(docs, corpus):
    got = {r["doc_id"]: r for r in quality.quality_verdicts(docs).collect()}
    for doc_id, text, *_ in corpus:
        t = text or ""
        w = W.findall(t)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count = Counter(grams)
        inside = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(3)}
        full = [x for x in t.split("\n") if W.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), len(inside))
        assert tuple(got[doc_id][c] for c in quality.COUNTS) == want
        assert got[doc_id]["base_failed"] == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (got[doc_id]["kept"] and got[doc_id]["base_failed"])
    assert all(got[i]["kept"] for i in range(1, 60)) and not got[302]["kept"]


def test_limits_adapt_to_the_group(spark):
    """What is usual in one source is refused in another; a small group follows its language."""
    rng = random.Random(2)
    prose = lambda marks: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) + ("#" if rng.random() < marks else "") for _ in range(120))
    rows = [(i, prose(0.2), "en", "code") for i in range(400)] + [(1000 + i, prose(0), "en", "news") for i in range(400)]
    rows += [(2000, prose(0.2), "en", "news"), (2001, prose(0), "en", "news"), (2002, prose(0.9), "en", "code"), (2003, prose(0), "en", "tiny"), (2004, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(docs).collect()}
    assert sum(got[i] for i in range(400)) >= 396 and sum(got[1000 + i] for i in range(400)) >= 396
    assert [got[i] for i in range(2000, 2005)] == [False, True, False, True, False]
    stats = docs.select("lang", "source", quality.text_counts("text").alias("s"))
    limits = {r["g_source"]: r for r in quality.thresholds(quality.sketches(stats)).collect()}
    # The language as a whole is spread over both sources, and so is the limit of the small one.
    assert limits["tiny"]["most_symbols"] > limits["code"]["most_symbols"] > limits["news"]["most_symbols"]
    assert sorted(r["doc_id"] for r in quality.keep_good(docs).collect()) == sorted(i for i, k in got.items() if k)


def test_limits_where_nearly_all_are_zero(spark):
    """Quartiles of 0 don't make limits of 0: a few symbols, repeats and repeated lines stay, and all limits are inside their range."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 7)))
    line = lambda: " ".join(word() for _ in range(25))
    rows = [(i, "\n".join(line() for _ in range(8)), "en", "a") for i in range(300)]
    rows += [(1000, rows[0][1][:-1] + "##", "en", "a"), (1001, rows[1][1] + " " + " ".join(rows[1][1].split()[:3]), "en", "a"), (1002, rows[2][1] + "\nthe same\nthe same", "en", "a")]
    rows += [(2000, " ".join(word() + "#" for _ in range(100)), "en", "a"), (2001, " ".join([line() for _ in range(5)] + [rows[0][1][:300].replace("\n", " ")] * 2), "en", "a")]
    rows += [(3000 + i, " ".join(word() for _ in range(60)), "de", "single lines") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    counts = {r["doc_id"]: r for r in quality.quality_verdicts(docs).collect()}
    assert 1000 * counts[1000]["n_symbols"] // counts[1000]["word_chars"] in (1, 2) and counts[1001]["n_repeat_words"] and counts[1002]["n_dup_lines"] == 1
    assert all(counts[i]["kept"] for i in counts if i not in (2000, 2001))
    assert not counts[2000]["kept"] and not counts[2001]["kept"] and not counts[2001]["base_failed"]
    for limits in quality.thresholds(quality.sketches(docs.select("lang", "source", quality.text_counts("text").alias("s")))).collect():
        assert all(1 < limits[f"most_{m}"] < 900 for m in ("symbols", "repeats", "dups")) and 0 < limits["least_width"] <= 5000 <= limits["most_width"]


def test_slices_cut_between_documents():
    import pyarrow as pa

    texts = pa.array(["ab", None, "", "cdé" * 10, "x"])[1:]
    parts = list(kernels.slices(texts, 5))
    assert b"".join(p[2].tobytes() for p in parts) == ("cdé" * 10 + "x").encode() and [p[:2] for p in parts][-1][1] == 4
