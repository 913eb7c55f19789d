"""The pipeline's stages, each on what the one before kept."""

from collections import Counter

import pytest

from stratalake.llm import tables


@pytest.fixture(scope="module")
def stages(spark, docs):
    import corpus_pipeline

    at, out = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        at = tables.written(stage(spark, at, ""), name)
        out[name] = at
    return out


def test_stages(stages, corpus, docs):
    assert list(stages) == ["quality_rules", "line_dedup", "jaccard_join", "mix_sources", "best_fit_packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == docs.columns
    ids = {n: Counter(r["doc_id"] for r in stages[n].select("doc_id").collect()) for n in stages}
    assert set(range(1, 60)) <= set(ids["quality_rules"]) and not {200, 201, 203, 302} & set(ids["quality_rules"])
    assert ids["line_dedup"] == ids["quality_rules"]
    assert 7 in ids["jaccard_join"] and not {100, 101, 102} & set(ids["jaccard_join"])
    assert set(ids["mix_sources"]) <= set(ids["jaccard_join"]) and max(ids["mix_sources"].values()) <= 3
    assert set(ids["best_fit_packing"]) == set(ids["mix_sources"])


def test_run_equals_the_stages(spark, stages, docs, tmp_path):
    import corpus_pipeline

    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    key = lambda df: sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, f"file://{tmp_path}")) == key(stages["best_fit_packing"])


def test_stages_on_an_empty_table(spark, empty):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, "")
        assert out.columns == empty.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").count() == 0


def test_stages_on_odd_rows(spark, odd):
    """Each stage on repeated rows, missing and repeated ids, and columns with clashing names."""
    import corpus_pipeline

    rows = [tuple(r) for r in odd.collect()]
    key = lambda df: Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    before = Counter((r[0], r[1]) for r in rows)
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, odd, "")
        assert df.columns == odd.columns
        out[name] = key(df)
    # Short texts fail the base rules; both rows of a repeated one have the same verdict.
    assert set(out["quality_rules"]) <= {k for k in before if len((k[1] or "").split()) >= 50} and len(out["quality_rules"]) >= 9
    assert all(n == before[k] for k, n in out["quality_rules"].items())
    assert sum(out["line_dedup"].values()) == len(rows) and Counter(k[0] for k in out["line_dedup"].elements()) == Counter(r[0] for r in rows)
    # Of a repeated row one stays; unlike texts of one id, and a row without an id, stay.
    assert out["jaccard_join"] == Counter(dict.fromkeys(before, 1))
    assert all(k in before for k in out["mix_sources"])
    packed = Counter(r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, odd, "").collect())
    assert packed == Counter(r[0] for r in rows)
