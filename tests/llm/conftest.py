import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs() -> list[tuple]:
    """A small corpus with nulls, empty and long texts, ties, copies, near copies, shared lines and repeated rows."""
    rng = random.Random(5)
    words = {"en": ["the", "of", "river", "house", "green", "walk", "under"], "de": ["der", "und", "haus", "grün", "gehen", "über", "fluß"]}
    prose = lambda lang, n: " ".join(rng.choice(words[lang]) + str(rng.randrange(300)) * (rng.random() < 0.5) for _ in range(n))
    shared = "this long line is shared by many documents of the corpus"
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        text = prose(lang, 60 + i)
        if i % 4 == 0:
            text += f"\n  {shared.upper() if i % 8 else shared}\t\n" + prose(lang, 12)
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    base = rows[7][1].split(" ")
    rows += [(100, rows[7][1], "en", "s0", 0), (101, " ".join([*base[:-3], "edited", "words", "here"]), "en", "s0", 0), (102, " ".join(["new", *base[:-1]]), "en", None, 0)]
    rows += [(200, None, "en", "s1", 0), (201, "", None, "s2", 0), (202, " \n\t ", "de", "s2", 0), (203, "one", "en", "s1", 3), (204, "a,b!", None, None, 4)]
    rows += [(300, prose("en", 6000), "en", "s0", 0), (301, "x" * 5000, "en", "s0", 5000), (302, "12345 " * 900, "en", "s0", 0)]
    rows += [(400, "ties are equal", "en", "s1", 14), (401, "ties are equal", "en", "s1", 14)]
    return rows


@pytest.fixture(scope="session")
def corpus():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark, corpus):
    """Repeated rows, a null id, and extra columns whose names clash with those that the operators use inside."""
    from pyspark.sql import functions as F

    rows = [*corpus[:12], *corpus[:2], (None, "no id here at all", "en", "s0", 5), (5, "another text of the same id", "en", "s0", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = {c: F.lit(1) for c in ("size", "s", "row", "t", "keep", "n", "doc", "cluster", "copies", "taken", "kept", "n_words", "bucket", "length", "g_lang")}
    return df.withColumns(extra)
