"""Search results: how they are sorted, ranked by a search area and chosen for drawing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Area = tuple[float, float, float, float]

#: How much the covered part of the area counts in a score, how many areas a drawn footprint may be large, and how large without an area (square degrees).
AREA_SHARE, LARGEST_IN_AREAS, LARGEST_DEG2 = 0.25, 4, 4.0
SORTS = ("relevance", "title", "newest", "oldest")


def sort_order(sort: str, rank: str = "rank", title: str = "title", published: str = "published", loaded: str = "loaded") -> list[Column]:
    """The columns to order results by; `rank` is their place by relevance, which decides all ties and has to be distinct.

    Dates of publication come first, those of loading only order the rows without one, and a row without either is last, whichever the direction. Titles are compared without regard to case, blank ones last.
    """
    if sort not in SORTS:
        raise ValueError(f"{sort} is none of {', '.join(SORTS)}")
    if sort == "relevance":
        return [F.col(rank)]
    if sort == "title":
        name = F.nullif(F.trim(title), F.lit(""))
        return [F.lower(name).asc_nulls_last(), name.asc_nulls_last(), F.col(rank)]
    one, two = F.col(published), F.when(F.col(published).isNull(), F.col(loaded))
    dates = [one.desc_nulls_last(), two.desc_nulls_last()] if sort == "newest" else [one.asc_nulls_last(), two.asc_nulls_last()]
    return [*dates, F.col(rank)]


def sorted_results(items: DataFrame, sort: str, limit: int, **columns: str) -> DataFrame:
    """The first `limit` items in one of the orders; Spark keeps that many a partition, so nothing is sorted as a whole."""
    return items.orderBy(*sort_order(sort, **columns)).limit(limit)


def _square(box: Area) -> float:
    return (box[2] - box[0]) * (box[3] - box[1])


def valid_area(area: Area) -> Area:
    """`area`, which has to be ordered and to have an extent."""
    if not (area[0] < area[2] and area[1] < area[3]):
        raise ValueError(f"an area without an extent: {area}")
    return area


def overlap_score(area: Area, xmin: str = "xmin", ymin: str = "ymin", xmax: str = "xmax", ymax: str = "ymax") -> Column:
    """How well a footprint matches an area, 0 to 1: the share of the area that it covers, and, weighing more, its own share within.

    A point or line within the area lies in it whole. A footprint that is apart, incomplete or not in order scores 0.
    """
    w, s, e, n = (F.lit(float(v)) for v in valid_area(area))
    across, up = F.least(F.col(xmax), e) - F.greatest(F.col(xmin), w), F.least(F.col(ymax), n) - F.greatest(F.col(ymin), s)
    own = (F.col(xmax) - F.col(xmin)) * (F.col(ymax) - F.col(ymin))
    inside = F.when(own == 0, 1.0).otherwise(F.try_divide(across * up, own))
    score = AREA_SHARE * (across * up / F.lit(_square(area))) + (1 - AREA_SHARE) * inside
    whole = F.col(xmin).isNotNull() & F.col(ymin).isNotNull() & F.col(xmax).isNotNull() & F.col(ymax).isNotNull()  # least and greatest pass over nulls
    return F.when(whole & (F.col(xmin) <= F.col(xmax)) & (F.col(ymin) <= F.col(ymax)) & (across >= 0) & (up >= 0), score).otherwise(0.0)


def by_overlap(items: DataFrame, area: Area, key: str, limit: int) -> DataFrame:
    """The best matches of an area with their `score`, ties by key; the box is compared first, so that the scan can skip what is apart."""
    w, s, e, n = valid_area(area)
    near = items.filter((F.col("xmin") <= e) & (F.col("xmax") >= w) & (F.col("ymin") <= n) & (F.col("ymax") >= s))
    return near.withColumn("score", F.round(overlap_score(area), 9)).orderBy(F.desc("score"), key).limit(limit)


def drawable(items: DataFrame, area: Area | None = None) -> DataFrame:
    """Items whose footprint isn't far larger than what is looked at: at most four times the area, or four square degrees where there is none."""
    largest = LARGEST_IN_AREAS * _square(valid_area(area)) if area else LARGEST_DEG2
    return items.filter((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) <= largest)


def most_detailed(items: DataFrame, group: list[str], scale: str, key: str) -> DataFrame:
    """The row of the smallest scale denominator in each group, unknown scales last, ties by key."""
    order = F.struct(F.col(scale).isNull(), F.col(scale), F.col(key))
    best = items.groupBy(*group).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in items.columns if c not in group]), order).alias("_row"))
    return best.select(*group, "_row.*")
