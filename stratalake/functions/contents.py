"""Tables of contents, and the articles that they divide an issue into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Beginnings of lines that are no articles; the last page that an issue has; the shortest title; how many entries make a table; where it can be; how much text of an article is shown.
NOISE = ("cover ", "design", "issn", "state of utah", "director", "chair", "administration", "executive", "governor", "ex officio", "deputy")
LAST_PAGE, SHORTEST, FEWEST, EARLY_PAGES, SHOWN = 60, 4, 3, 4, 20_000
ENTRIES = "array<struct<title: string, page: int>>"


def entries(text: Column, noise: tuple[str, ...] = NOISE) -> Column:
    """(title, page) of lines like "Title ..... 12" in their order: three dots at least, then a page or "back cover", whose page is null.

    Noise, pages beyond the last and titles that came before, whatever their case, are left out. Null has none.
    """
    leader = r"(?i)^(.*?)\s*\.\s*\.\s*\.[.\s]*(\d{1,3}|back cover)$"
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"), lambda x: F.trim(x)), lambda x: x.rlike(leader))
    title = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_extract(x, leader, 1), r"\s+", " "), r"^[ .,•·]+|[ .,•·]+$", "")
    rows = F.transform(lines, lambda x: F.struct(title(x).alias("title"), F.try_to_number(F.regexp_extract(x, leader, 2), F.lit("999")).cast("int").alias("page")))
    quiet = lambda r: ~F.exists(F.array(*map(F.lit, noise)), lambda n: F.startswith(F.lower(r["title"]), n)) if noise else F.lit(True)
    kept = F.filter(rows, lambda r: (F.length(r["title"]) >= SHORTEST) & (r["page"].isNull() | (r["page"] <= LAST_PAGE)) & quiet(r))
    first = lambda found, r: F.when(F.exists(found, lambda f: F.lower(f["title"]) == F.lower(r["title"])), found).otherwise(F.concat(found, F.array(r)))
    return F.aggregate(kept, F.array().cast(ENTRIES), first)


def toc(pages: Column) -> Column:
    """The entries of that early page which has most of them, the first of several; none if there are fewer than three."""
    parsed = F.transform(F.slice(F.coalesce(pages, F.array().cast("array<string>")), 1, EARLY_PAGES), lambda p: entries(p))
    none = F.array().cast(ENTRIES)
    return F.aggregate(parsed, none, lambda best, e: F.when(F.size(e) > F.size(best), e).otherwise(best), lambda best: F.when(F.size(best) >= FEWEST, best).otherwise(none))


def ranges(table: Column) -> Column:
    """(title, page, last) of entries with a page, by page: each ends before the next begins, the last (null) with the issue, as does one that shares its page with the next."""
    placed = F.transform(table, lambda e, i: F.struct(e["page"].alias("page"), i.alias("place"), e["title"].alias("title")))
    paged = F.sort_array(F.filter(placed, lambda e: e["page"].isNotNull()), asc=False)  # from the last, so that each knows the next one's page
    start = F.struct(F.array().cast("array<struct<title: string, page: int, last: int>>").alias("done"), F.lit(None).cast("int").alias("next"))
    one = lambda acc, e: F.struct(e["title"].alias("title"), e["page"].alias("page"), F.when(acc["next"] > e["page"], acc["next"] - 1).alias("last"))
    step = lambda acc, e: F.struct(F.concat(acc["done"], F.array(one(acc, e))).alias("done"), e["page"].alias("next"))
    return F.aggregate(paged, start, step, lambda acc: F.reverse(acc["done"]))


def article_texts(pages: Column, shown: int = SHOWN) -> Column:
    """(title, page, text) of the articles that an issue's pages hold by its table of contents, their spaces folded; the text is cut to what is shown, a search takes the pages."""
    join = lambda r: F.array_join(F.slice(pages, r["page"], F.greatest(F.coalesce(r["last"], F.size(pages)) - r["page"] + 1, F.lit(0))), " ")
    text = lambda r: F.when(r["page"] >= 1, F.substring(F.trim(F.regexp_replace(join(r), r"\s+", " ")), 1, shown)).otherwise("")
    return F.transform(ranges(toc(pages)), lambda r: F.struct(r["title"].alias("title"), r["page"].alias("page"), text(r).alias("text")))


def issues(volumes: DataFrame, pages: str = "pages") -> DataFrame:
    """`volumes` with `articles` in place of their pages, as `catalogue.article_corpus` takes them."""
    return volumes.withColumn("articles", article_texts(F.col(pages))).drop(pages)
