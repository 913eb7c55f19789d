"""Names of authors: split from free text, and shortened."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.text import bound, slug

#: What follows a person's or a firm's name after a comma, what initials look like, and what tells that a text is more than a list of names.
PERSON_SUFFIX, NUMBERED_SUFFIX, FIRM_SUFFIX = r"(?i)^(jr|sr|ii|iii|iv)\.?$", r"(?i)^(jr|sr|iii?|iv|vi{0,3})\.?$", r"(?i)^(inc|co|corp|ltd|llc)\.?$"
INITIALS = r"^([A-Z]\.\s*)+$|^[A-Z]$"
PROSE = r"(?i)[()?\d&]|\b(assisted|modified|compiled|by)\b"
AND = r"(?i),?\s+and\s+"


def _strings() -> Column:
    return F.array().cast("array<string>")


def _but_last(a: Column) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))


def authors(primary: Column, others: Column) -> Column:
    """The first author and those of a list at commas, semicolons, "&" and "and"; a suffix belongs to the name before it, and each name counts once, whatever its case and signs."""
    listed = F.transform(F.split(F.coalesce(others, F.lit("")), rf"{AND}|\s*[;,&]\s*"), lambda n: F.trim(n))
    all_ = F.filter(F.concat(F.array(F.trim(F.coalesce(primary, F.lit("")))), listed), lambda n: n != "")
    folded = F.aggregate(
        all_, _strings(),
        lambda acc, n: F.when(n.rlike(NUMBERED_SUFFIX), F.when(F.size(acc) > 0, F.concat(_but_last(acc), F.array(F.concat(F.get(acc, F.size(acc) - 1), F.lit(", "), n)))).otherwise(acc)).otherwise(F.concat(acc, F.array(n))),
    )
    first = lambda all_, keys: F.filter(all_, lambda n, i: (F.get(keys, i) != "") & (F.array_position(keys, F.get(keys, i)) == i + 1))
    return bound(folded, lambda names: bound(F.transform(names, lambda n: slug(n)), lambda keys: first(names, keys)))


def _names(segment: Column) -> Column:
    """The names of one part of a list, or null if it can't be told how it is to be read."""
    tokens = F.filter(F.transform(F.split(segment, ","), lambda t: F.trim(t)), lambda t: t != "")
    one = lambda t, suffix: F.array(F.struct(t.alias("t"), suffix.alias("suffix")))
    last = lambda acc: F.get(acc, F.size(acc) - 1)
    nothing = F.lit(None).cast("string")
    fold = lambda acc, t: (
        F.when((F.size(acc) > 0) & t.rlike(PERSON_SUFFIX), F.concat(_but_last(acc), one(last(acc)["t"], t)))
        .when((F.size(acc) > 0) & t.rlike(FIRM_SUFFIX), F.concat(_but_last(acc), one(F.concat(last(acc)["t"], F.lit(", "), t), last(acc)["suffix"])))
        .otherwise(F.concat(acc, one(t, nothing)))
    )
    return bound(F.aggregate(tokens, F.array().cast("array<struct<t: string, suffix: string>>"), fold), _read)


def _read(folded: Column) -> Column:
    """Names of the parts between commas, suffixes taken in."""
    n = F.size(folded)
    shown = lambda k: F.concat(k["t"], F.coalesce(F.concat(F.lit(" "), k["suffix"]), F.lit("")))
    initial = lambda k: k["t"].rlike(INITIALS)
    spots = F.sequence(F.lit(0), F.greatest(F.floor(n / 2).cast("int") - 1, F.lit(0)))
    pair = lambda i: F.concat_ws(", ", F.get(folded, 2 * i)["t"], F.coalesce(F.get(folded, 2 * i + 1)["suffix"], F.get(folded, 2 * i)["suffix"]), F.get(folded, 2 * i + 1)["t"])
    turned = (n % 2 == 0) & F.forall(spots, lambda i: ~initial(F.get(folded, 2 * i)) & initial(F.get(folded, 2 * i + 1)))
    two = F.concat(F.get(folded, F.lit(0))["t"], F.lit(", "), F.get(folded, F.lit(1))["t"])
    return (
        F.when(n == 0, _strings())
        .when(F.exists(F.slice(folded, 2, F.greatest(n - 1, F.lit(0))), initial), F.when(turned, F.transform(spots, pair)))
        .when(n == 1, F.transform(folded, shown))
        .when((n == 2) & F.forall(folded, lambda k: k["t"].rlike(r"^[^\s.]+$")), F.array(two))
        .when(F.forall(folded, lambda k: k["t"].rlike(r"\s")), F.transform(folded, shown))
    )


def cited_authors(raw: Column) -> Column:
    """(names, ambiguous) of a text: names in order, at semicolons and "and", as First Last or as Last, F.; blank has none.

    What is prose or can't be read in one way is a single name, and `ambiguous`.
    """
    return bound(F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), r"\s+", " ")), _cited)


def _cited(whole: Column) -> Column:
    parts = F.transform(F.split(whole, rf";|{AND}"), lambda s: F.trim(F.regexp_replace(F.regexp_replace(F.trim(s), r"(?i)^and\s+", ""), "^,+|,+$", "")))
    each = F.when(~whole.rlike(PROSE), F.transform(F.filter(parts, lambda s: s != ""), lambda s: _names(s)))
    names = F.when(whole == "", _strings()).otherwise(bound(each, lambda n: F.flatten(n)))  # null if one of the parts is
    return bound(names, lambda n: F.struct(F.coalesce(n, F.array(whole)).alias("names"), n.isNull().alias("ambiguous")))


def short_author(raw: Column) -> Column:
    """The family name of the first author of a list at semicolons, with "et al." for more; null for none."""
    people = F.filter(F.transform(F.split(raw, ";"), lambda p: F.trim(p)), lambda p: p != "")
    return bound(people, _short)


def _short(people: Column) -> Column:
    cut = F.transform(F.split(F.get(people, F.lit(0)), ","), lambda p: F.trim(p))
    head, tail = F.get(cut, F.lit(0)), F.coalesce(F.get(cut, F.lit(1)), F.lit(""))
    words = F.filter(F.split(head, r"\s+"), lambda w: ~w.rlike(PERSON_SUFFIX.replace("|iv", "")))
    name = F.when((tail != "") & ~tail.rlike(PERSON_SUFFIX.replace("|iv", "")), head).otherwise(F.coalesce(F.get(words, F.size(words) - 1), head))
    more = F.when(F.size(people) > 1, " et al.").otherwise("")
    return F.when(F.size(people) > 0, F.concat(F.regexp_replace(name, "[.,]+$", ""), more))
