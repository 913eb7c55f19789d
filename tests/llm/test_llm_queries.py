"""The registered queries themselves on a small folder of tables: columns, types, contracts, and SQL where there is any."""

import hashlib
import re
import zlib

import duckdb
import pytest

from stratalake.llm import personal, registry

COLUMNS = {
    "op1_substring_dedup": {"doc_id": "bigint", "start": "bigint", "end": "bigint", "n_chunks": "bigint", "n_copies": "bigint", "first_doc_id": "bigint"},
    "op2_lm_scoring": {"doc_id": "bigint", "n_words": "bigint", "log_score": "double", "mean_log_score": "double"},
    "op3_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op7_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op8_personal_data": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op9_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op10_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op11_ranked_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op13_secret_scans": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
}


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"file://{path}/documents.parquet")
    items = docs.filter("doc_id < 12").selectExpr("doc_id div 2 as item_id", "substring(text, 1, 200) as text")
    items.write.parquet(f"file://{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def results(spark, folder):
    out = {}
    for name, query in registry.QUERIES.items():
        df = query(spark, f"file://{folder}")
        out[name] = dict(df.dtypes), [r.asDict() for r in df.collect()]
    return out


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(results, corpus, name):
    types, rows = results[name]
    assert list(COLUMNS[name].items()) == list(types.items())[: len(COLUMNS[name])]
    if name not in ("op1_substring_dedup", "op5_best_fit_packing", "op11_ranked_search"):
        assert sorted(r["doc_id"] for r in rows) == sorted(t[0] for t in corpus)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(results, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
    found = con.sql(registry.ORACLES[name])
    want = sorted(map(str, (dict(sorted(zip(found.columns, r)).__iter__()) for r in found.fetchall())))
    assert sorted(str(dict(sorted(r.items()))) for r in results[name][1]) == want


def test_held_out_is_the_fold(results, corpus):
    for r in results["op3_language_id"][1]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in results["op3_language_id"][1]} <= {t[2] for t in corpus} - {None} | {"und"}


def test_mix_keeps_its_limits(results, corpus):
    from test_ops import targets_brute

    size = {t[0]: len(re.findall(r"[^\x20\x09-\x0D]+", t[1] or "")) for t in corpus}
    source, totals = {t[0]: t[3] for t in corpus}, {}
    for i, n in size.items():
        totals[source[i]] = totals.get(source[i], 0) + n
    want, taken = targets_brute(totals), dict.fromkeys(totals, 0)
    for r in results["op4_mix_sources"][1]:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], totals[s]) and r["target"] == pytest.approx(want[s])
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= max(n for i, n in size.items() if source[i] == s) for s in totals)


def test_base_spans_are_digested(results, corpus):
    texts = {t[0]: t[1] or "" for t in corpus}
    for r in results["op8_personal_data"][1]:
        base = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in personal.base_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(r["spans"].split(","))
