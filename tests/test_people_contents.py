"""Names of authors, and tables of contents."""

from pyspark.sql import functions as F

from stratalake.functions import contents, people
from stratalake.functions import text as fx


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def test_cited_authors(spark):
    cases = {
        "Larry M. Trimble; Hellmut H. Doelling": ["Larry M. Trimble", "Hellmut H. Doelling"], "A. Bee, C. Dee, and E. Eff": ["A. Bee", "C. Dee", "E. Eff"], "Thomas C. Chidsey, Jr": ["Thomas C. Chidsey Jr"],
        "Sanchez, J.D., Bee, A.": ["Sanchez, J.D.", "Bee, A."], "Bee, Jr., A. and Dee, C. D.": ["Bee, Jr., A.", "Dee, C. D."], "Rock Maps, Inc.": ["Rock Maps, Inc."], "Bee, Anna": ["Bee, Anna"], "  ": [], "Solo": ["Solo"], "and  Anna Bee,": ["Anna Bee"],
    }
    assert [(r["names"], r["ambiguous"]) for r in values(spark, cases, people.cited_authors)] == [(n, False) for n in cases.values()]
    unclear = ["Mapped by A. Bee", "A. Bee & C. Dee", "Bee, A., Dee", "Anna Bee, Dee, Eff", "Bee (1999)", "A., Bee, C."]
    assert [(r["names"], r["ambiguous"]) for r in values(spark, unclear, people.cited_authors)] == [([u], True) for u in unclear]
    assert values(spark, [None], people.cited_authors)[0]["names"] == []


def test_authors_of_two_fields(spark):
    cases = [("A. Bee", "C. Dee, Jr, and E. Eff & G. Aitch; a bee", ["A. Bee", "C. Dee, Jr", "E. Eff", "G. Aitch"]), (None, "Jr, Anna Bee", ["Anna Bee"]), ("Tom Sea", "VIII, B. Ay", ["Tom Sea, VIII", "B. Ay"]), (" ", None, []), ("--", "X", ["X"])]
    df = spark.createDataFrame(cases, "p string, s string, want array<string>")
    assert [r["got"] for r in df.select(people.authors(F.col("p"), F.col("s")).alias("got")).collect()] == [c[2] for c in cases]


def test_short_author(spark):
    cases = {"Larry M. Trimble; Hellmut H. Doelling": "Trimble et al.", "Sanchez, J.D.": "Sanchez", "Thomas C. Chidsey, Jr": "Chidsey", "Thomas Chidsey Jr.; B": "Chidsey et al.", "Madonna": "Madonna", " ; ": None}
    assert values(spark, cases, people.short_author) == list(cases.values()) and values(spark, [None], people.short_author) == [None]


def test_shown_dates(spark):
    cases = {"1999-01-01": "1999", "1999-03-01T00:00:00Z": "Mar 1999", "1999-03-05T10:00:00Z": "1999-03-05", "1999": "1999", "1999-03": "Mar 1999", "": None, "soon": None}
    assert values(spark, cases, fx.shown_date) == list(cases.values()) and values(spark, [None], fx.shown_date) == [None]


TOC = "Contents\nThe  Intro ..... 1\r\n• Faults. . . 3\nTHE INTRO ... 7\nMaps .. 9\nIndex .... 99\nDirector ..... 4\nAge ... 5\nSurvey news...Back Cover\nState parks . ..12  "


def test_entries_of_contents(spark):
    assert [tuple(e) for e in values(spark, [TOC], contents.entries)[0]] == [("The Intro", 1), ("Faults", 3), ("Survey news", None), ("State parks", 12)]
    assert values(spark, [None, "", "no dots 3", "." * 5000 + "x"], contents.entries) == [[], [], [], []]
    df = spark.createDataFrame([(["cover", "Abcd ... 1\nBcde ... 2", TOC, TOC.replace("Faults", "Floods")],), (["Abcd ... 1\nBcde ... 2"],), ([],), (None,), (["a", "b", "c", "d", TOC],)], "pages array<string>")
    got = [[e["title"] for e in r[0]] for r in df.select(contents.toc(F.col("pages"))).collect()]
    assert got == [["The Intro", "Faults", "Survey news", "State parks"], [], [], [], []]


def test_articles_are_the_pages_up_to_the_next(spark):
    pages = ["Beta beta ... 3\nAlpha one ... 2\nGamma ray ... 3\nDelta dam ... 9\nCover shot ... back cover", "two", "three\n 3", "four", "five"]
    df = spark.createDataFrame([("s", 1, pages), ("t", 2, None)], "sid string, volume int, pages array<string>")
    got = contents.issues(df).collect()
    # Beta shares its page with Gamma, so that it goes on; Delta's page isn't there.
    assert [tuple(a) for a in got[0]["articles"]] == [("Alpha one", 2, "two"), ("Beta beta", 3, "three 3 four five"), ("Gamma ray", 3, "three 3 four five"), ("Delta dam", 9, "")]
    assert got[1]["articles"] == []
