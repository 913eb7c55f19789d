"""A catalogue's index entries, and reports on what it holds: what can be drawn, what is doubled, stale, pending or still to be copied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Properties and asset fields that an index entry keeps, and the links that draw something.
PROPERTIES = ("title", "datetime", "series_id", "series", "pub_type", "topic", "scale", "scale_denominator", "author", "county", "schema", "layer", "layer_kind", "row_count", "volume", "keywords")
MAP_LINKS = ("pmtiles", "cog")
#: What a footprint is called that stands in for a missing one, and kinds of layers that have none of their own.
PLACEHOLDER, NO_PLACE = "utah-bbox", ("table", "supporting")
#: Beginnings of outcome codes, in the order in which they are tried, and what they mean; all others ask for attention.
OUTCOMES = [("skip:too_large", "attention"), ("skip", "expected")]


def has_footprint(geometry: Column, source: Column, kind: Column) -> Column:
    """Whether an item lies where its geometry says: it has one, and it isn't a stand-in or that of the publication that a table belongs to."""
    return geometry.isNotNull() & ~F.coalesce(source == PLACEHOLDER, F.lit(False)) & ~F.coalesce(kind.isin(*NO_PLACE), F.lit(False))


def has_cog(assets: Column) -> Column:
    """Whether one of an item's assets, a map of (href, type, roles), is a cloud-optimised raster."""
    word = F.lit("cloud-optimized")
    one = lambda a: F.coalesce(F.contains(a["type"], word), F.lit(False)) | F.coalesce(F.array_contains(a["roles"], word), F.lit(False)) | F.coalesce(F.endswith(a["href"], F.lit(".cog.tif")), F.lit(False))
    return F.coalesce(F.exists(F.map_values(assets), one), F.lit(False))


def mappable(assets: Column, links: Column, geometry: Column, source: Column, kind: Column) -> Column:
    """Whether there is something to draw, a raster or tiles, and a place to draw it."""
    drawn = F.coalesce(F.exists(links, lambda x: F.coalesce(x["rel"].isin(*MAP_LINKS), F.lit(False))), F.lit(False))
    return has_footprint(geometry, source, kind) & (has_cog(assets) | drawn)


def index_entries(items: DataFrame, properties: tuple[str, ...] = PROPERTIES) -> DataFrame:
    """(id, bbox, properties, assets, links): what a list shows of each item.

    `items` has (id, collection, geometry, bbox, properties, assets, links); properties are a map of texts, of which those named stay if they aren't empty. An
    item without a footprint has no bbox. Links are the one to the item itself, then those that draw.
    """
    known = F.coalesce("properties", F.create_map().cast("map<string,string>"))
    kept = F.map_filter(known, lambda k, v: k.isin(*properties) & v.isNotNull() & ~v.isin("", "[]"))
    place = has_footprint(F.col("geometry"), F.try_element_at(known, F.lit("footprint_source")), F.try_element_at(known, F.lit("layer_kind")))
    own = F.struct(F.lit("self").alias("rel"), F.concat(F.lit("./"), F.coalesce(F.concat("collection", F.lit("/")), F.lit("")), "id", F.lit("/"), "id", F.lit(".json")).alias("href"))
    maps = F.transform(F.filter("links", lambda x: x["rel"].isin(*MAP_LINKS)), lambda x: F.struct(x["rel"].alias("rel"), x["href"].alias("href")))
    links = F.concat(F.array(own), F.coalesce(maps, F.array().cast("array<struct<rel: string, href: string>>")))
    summary = F.transform_values("assets", lambda _, a: F.struct(a["href"].alias("href"), a["type"].alias("type"), a["roles"].alias("roles")))
    return items.select("id", F.when(place, F.col("bbox")).alias("bbox"), kept.alias("properties"), summary.alias("assets"), links.alias("links"))


def is_error_layer(label: Column) -> Column:
    """Whether a layer holds the errors of a validation: T_1_LineErrors, after any folder."""
    return F.coalesce(label.rlike(r"(^|/)T_[0-9]+_\w*Errors$"), F.lit(False))


def coverage(publications: DataFrame, items: DataFrame) -> DataFrame:
    """(group, series, publications, migrated, pending, items) of each series.

    `publications` has (group, series, id, moved, raster): whether it has its collection, and whether a raster lies on it; `items` (publication, id, raster). A series switches as a whole: until
    all of its publications moved it isn't migrated, and only what is pending counts. A raster on a publication is an item of it.
    """
    counts = items.groupBy(F.col("publication").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    each = publications.join(counts, F.col("id") == F.col("_p"), "left")
    held = F.coalesce("_n", F.lit(0)) + F.coalesce(F.col("raster").cast("int"), F.lit(0))
    out = each.groupBy("group", "series").agg(F.count(F.lit(1)).alias("publications"), F.count_if(~F.col("moved")).alias("pending"), F.sum(held).alias("items"))
    done = F.col("pending") == 0
    return out.select("group", "series", F.when(done, F.col("publications")).otherwise(0).alias("publications"), done.alias("migrated"), "pending", F.when(done, F.col("items")).otherwise(0).alias("items"))


def coverage_rasters(publications: DataFrame, items: DataFrame, covered: DataFrame) -> DataFrame:
    """(group, series, raster): the ids of the rasters that a summary's migrated series hold, on publications and among their items, a row each."""
    done = covered.filter("migrated").select("group", "series")
    pubs = publications.join(done, ["group", "series"], "left_semi")
    of_items = items.filter("raster").select("publication", F.col("id").alias("_r")).join(pubs, F.col("publication") == F.col("id"))
    return pubs.filter("raster").select("group", "series", F.col("id").alias("raster")).unionAll(of_items.select("group", "series", F.col("_r").alias("raster")))


def duplicate_ids(items: DataFrame) -> DataFrame:
    """(id, paths) of the ids that more than one collection holds, or one holds more than once; paths are collection/id, in order. `items` has (collection, id).

    Counts by collection come first, so that an id of very many rows is a short list.
    """
    each = items.filter("id is not null").groupBy("id", "collection").agg(F.count(F.lit(1)).alias("n"))
    path = F.concat(F.coalesce("collection", F.lit("")), F.lit("/"), F.col("id").cast("string"))
    found = each.groupBy("id").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct(path.alias("path"), "n"))).alias("paths"))
    return found.filter("n > 1").select("id", "paths")


def representative(items: DataFrame, collection: str = "collection", when: str = "datetime", key: str = "id", picture: str = "thumbnail") -> DataFrame:
    """The newest item with a picture of each collection, undated ones last, ties by the larger key."""
    order = F.struct(F.col(when).isNotNull(), F.col(when), F.col(key))
    rest = [F.col(f"`{c}`") for c in items.columns if c != collection]
    return items.filter(F.coalesce(F.col(picture).cast("string"), F.lit("")) != "").groupBy(collection).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(collection, "_row.*")


def series_counts(ids: DataFrame, series: Column) -> DataFrame:
    """(series, n) of all series, the most frequent first."""
    return ids.groupBy(series.alias("series")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "series")


def outcome(code: Column, rules: list[tuple[str, str]] = OUTCOMES) -> Column:
    """ok, expected or attention: what the outcome code of a run means; a run without one asks for attention."""
    out = F.when(code == "ok", "ok")
    for start, meaning in rules:
        out = out.when(F.startswith(code, F.lit(start)), meaning)
    return out.otherwise("attention")


def tally(runs: DataFrame, code: str) -> DataFrame:
    """(outcome, n) of all runs."""
    return runs.groupBy(outcome(F.col(code)).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def mirror_plan(pubs: DataFrame, attachments: DataFrame, target: Column, selected: DataFrame | None = None, present: DataFrame | None = None) -> DataFrame:
    """(id, url, target): the files to copy, each target once, for the first id in order, its own files before what is attached, by url.

    `pubs` and `attachments` have (id, url), of which attachments count for known publications only; ids are compared without regard to case and spaces. `selected` has the ids to copy, all if None,
    `present` the targets that are there. `target` is made from the column url; a url without one isn't copied.
    """
    key = F.upper(F.trim("id"))
    rows = lambda df, rank: df.select(F.nullif(key, F.lit("")).alias("id"), F.lit(rank).alias("rank"), "url").filter("id is not null")
    own, more = rows(pubs, 0), rows(attachments, 1)
    if selected is not None:
        own = own.join(selected.select(key.alias("id")), "id", "left_semi")
    both = own.unionAll(more.join(own.select("id"), "id", "left_semi")).withColumn("target", target).filter("coalesce(target, '') <> ''")
    first = both.groupBy("target").agg(F.min(F.struct("id", "rank", "url")).alias("f")).select("f.id", "f.url", "target")
    return first if present is None else first.join(present.select("target"), "target", "left_anti").select("id", "url", "target")


def stale(published: DataFrame, built: DataFrame, keys: tuple[str, ...] = ("collection", "id")) -> DataFrame:
    """Published items that a build didn't make, of those collections that it made at all: what it didn't touch isn't stale."""
    touched = built.select(*keys[:-1]).distinct()
    return published.join(touched, list(keys[:-1]), "left_semi").join(built.select(*keys), list(keys), "left_anti")
