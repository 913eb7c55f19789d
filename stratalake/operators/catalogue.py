"""Items of a catalogue and the publications behind them: categories, kinds, formats, articles, bundles and harvests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import series_code, topic

#: Categories in the order in which they are tried, each with the serving schema and the root collection that it takes.
CATEGORIES = [
    ("hazards", "hazards", None), ("energy-minerals", "emp", None), ("geologic-maps", "mapping", "geologic-maps"), ("wetlands", "wetlands", None), ("groundwater", "groundwater", None),
    ("rasters", None, "rasters"), ("mining-district-files", None, "mining-district-files"),
]
#: Root collections of publications, and the labels of formats.
PUBLICATION_ROOTS = ("publications", "external")
FORMATS = {"cog": "COG", "zarr": "Datacube", "threeD": "3D", "pdf": "PDF", "image": "Image", "parquet": "GeoParquet", "text": "Text", "tiles": "Web map"}
#: Endings of the files that only accompany others.
SIDECARS = ("shx", "dbf", "prj", "cpg", "sbn", "sbx", "xml", "tfw", "aux", "ovr", "lyr")


def is_publication(root: Column, pub_type: Column, series: Column) -> Column:
    return F.coalesce(root.isin(*PUBLICATION_ROOTS), F.lit(False)) | pub_type.isNotNull() | series.isNotNull()


def category(schema: Column, root: Column, publication: Column, taxonomy: list = CATEGORIES) -> Column:
    """An item's one category: the first whose schema or root it has, then publications, then other."""
    out = None
    for key, of_schema, of_root in taxonomy:
        hit = F.lit(False)
        if of_schema:
            hit = hit | F.coalesce(schema == of_schema, F.lit(False))
        if of_root:
            hit = hit | F.coalesce(root == of_root, F.lit(False))
        out = F.when(hit, key) if out is None else out.when(hit, key)
    return (F.when(publication, "publications") if out is None else out.when(publication, "publications")).otherwise("other")


def item_kind(publication: Column, schema: Column, assets: Column) -> Column:
    """publication, raster, vector or other, from the kinds of an item's assets."""
    has = lambda *kinds: F.coalesce(F.arrays_overlap(assets, F.array(*map(F.lit, kinds))), F.lit(False))
    return F.when(publication, "publication").when(has("cog", "raster-tiles"), "raster").when(schema.isNotNull() | has("tiles", "parquet", "zarr"), "vector").otherwise("other")


def formats_of(assets: Column) -> Column:
    """The labels of the formats of an item's assets, each once, in their order."""
    label = F.create_map(*[F.lit(x) for pair in FORMATS.items() for x in pair])
    return F.array_distinct(F.array_compact(F.transform(F.coalesce(assets, F.array().cast("array<string>")), lambda a: F.try_element_at(label, a))))


def article_corpus(issues: DataFrame) -> DataFrame:
    """(id, sid, volume, title, page, text, topic): a row an article of the issues (sid, volume, articles of title, page and text).

    Ids count the articles of an issue, as two can share a page; the topic comes from the title and the first 300 characters.
    """
    each = issues.select("sid", "volume", F.posexplode("articles").alias("i", "a")).select("sid", "volume", "i", "a.*")
    text = F.coalesce("text", F.lit(""))
    return each.select(F.concat_ws("#", "sid", "i").alias("id"), "sid", "volume", "title", "page", text.alias("text"), topic(F.col("title"), F.substring(text, 1, 300)).alias("topic"))


def bundle_kind(name: Column) -> Column:
    """What a file of a bundle is, by its name."""
    low = F.lower(name)
    ending = F.regexp_extract(low, r"\.([a-z0-9]+)$", 1)
    base = F.when(low.rlike("basemap|topo|hillshade"), "basemap").otherwise("geotiff")
    return F.when(ending == "pdf", "pdf").when(ending.isin("tif", "tiff"), base).when(ending == "shp", "shapefile").when(ending.isin(*SIDECARS), "sidecar").otherwise("other")


def unused_files(found: DataFrame, used: DataFrame) -> DataFrame:
    """(bundle, name, reason): the data files of bundles that weren't used, and why; files that accompany others or document them have no say.

    `found` has (bundle, name, georeferenced), null where that wasn't looked at; `used` has (bundle, tier, plate, shapefile), a row a bundle: source, geo-pdf or another tier, and the names that were used.
    """
    both = found.withColumn("kind", bundle_kind(F.col("name"))).join(used, "bundle", "left")
    base = F.element_at(F.split("name", "/"), -1)
    taken = (base == F.element_at(F.split("plate", "/"), -1)) | ((F.col("kind") == "shapefile") & (F.col("name") == F.col("shapefile")))
    kind, tier, placed = F.col("kind"), F.col("tier"), F.col("georeferenced")
    of_pdf = F.when(placed, "could not be rendered").when(~placed, "no coordinate system").otherwise("not looked at, a plate was chosen")
    of_raster = F.when(tier == "geo-pdf", "superseded by a georeferenced PDF").otherwise("unused raster")
    reason = (
        F.when((tier == "source") & kind.isin("pdf", "geotiff"), "superseded by the source raster").when(kind == "pdf", of_pdf).when(kind == "geotiff", of_raster).when(kind == "basemap", "a base map, not the map itself")
        .when(kind == "shapefile", "secondary shapefile").when(F.lower(base).rlike(r"\.mpk$"), "unsupported package")
    )
    return both.filter(~F.coalesce(taken, F.lit(False)) & (kind != "sidecar")).select("bundle", "name", reason.alias("reason")).filter("reason is not null")


def harvest_status(pubs: DataFrame, harvested: DataFrame, archives: DataFrame, series: str = "", status: str = "", text: str = "") -> DataFrame:
    """(id, title, status) of publications (id, title): placeholder, harvested, pdf_only without an archive, or pending; filtered by series, status and text.

    `harvested` and `archives` have a column id; ids are compared without regard to case, and publications without one are left out.
    """
    key = F.upper(F.trim("id"))
    rows = pubs.filter(F.coalesce(F.trim("id"), F.lit("")) != "").withColumn("_k", key)
    rows = rows.filter(series_code(F.col("_k")) == series.strip().upper()) if series.strip() else rows
    if text.strip():
        want = F.lit(text.strip().upper())
        rows = rows.filter(F.contains("_k", want) | F.contains(F.upper(F.coalesce("title", F.lit(""))), want))
    mark = lambda df, name: df.select(key.alias("_k")).distinct().withColumn(name, F.lit(True))
    rows = rows.join(mark(harvested, "_h"), "_k", "left").join(mark(archives, "_a"), "_k", "left")
    state = F.when(F.contains("_k", F.lit("XXXX")), "placeholder").when(F.col("_h"), "harvested").when(F.col("_a").isNull(), "pdf_only").otherwise("pending")
    rows = rows.select(F.trim("id").alias("id"), "title", state.alias("status"))
    return rows.filter(F.col("status") == status.strip().lower()) if status.strip() else rows
