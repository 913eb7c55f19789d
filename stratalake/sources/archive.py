"""Archives: Hilbert-ordered Parquet with box columns, and reading features of an area from them."""

from __future__ import annotations

import datetime
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans.storage import row_bytes

#: Fixed values of the layout.
BLOCK_BYTES, LEAST_ROWS, MOST_ROWS = 8 << 20, 128, 122_880
GEOMETRY_NAMES = ("geom", "geometry", "wkb_geometry")
WKB_NAMES = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")


def castable(df: DataFrame) -> DataFrame:
    """`df` with the types that Parquet readers elsewhere can't hold as text."""
    kinds = (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType, T.VariantType)
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`") for f in df.schema])


def write_archive(df: DataFrame, path: str, order: str, day: datetime.date | None = None, rows: int | None = None, geometry: str | None = None) -> str:
    """Write points sorted by `order` with flat and struct box columns as a dated copy, and then the pointer that makes it the latest; returns its folder.

    A copy is never written over, also not on the same day, and readers see the old latest until the new one is whole. Files hold `rows` rows, or as many as make up
    a block of the layout. With each copy goes its sidecar document, from the WKB column `geometry`, or as points.
    """
    spark = df.sparkSession
    flat = df.withColumns({"xmin": F.col("x"), "ymin": F.col("y"), "xmax": F.col("x"), "ymax": F.col("y")})
    out = castable(flat.withColumn("bbox", F.struct("xmin", "ymin", "xmax", "ymax")))
    rows = rows or block_rows(out)
    version = f"{time.time_ns():020}-{uuid.uuid4().hex}"
    folder = f"dt={(day or datetime.date.today()):%Y%m%d}/{version}"
    writer = out.repartitionByRange(order).sortWithinPartitions(order).write.option("compression", "zstd").option("parquet.page.size", 256 << 10).option("parquet.block.size", BLOCK_BYTES)
    writer.option("maxRecordsPerFile", rows).parquet(f"{path}/{folder}")
    written = spark.read.parquet(f"{path}/{folder}")
    # Little-endian WKB of a point begins like this.
    shape = F.col(geometry) if geometry else F.when(F.col("x").isNotNull(), F.unhex(F.lit("0101000000")))
    sidecars(written.select("x", "y", shape.alias("g")), "g", []).coalesce(1).write.text(f"{path}/sidecars/{version}")
    spark.createDataFrame([(version, folder)], "version string, folder string").coalesce(1).write.json(f"{path}/pointers/{version}")
    return f"{path}/{folder}"


def block_rows(df: DataFrame) -> int:
    """Rows that make up a block, by the average bytes of all columns."""
    return df.agg(_rows_of(row_bytes(df)).alias("n")).first()["n"] or MOST_ROWS


def _newest(spark: SparkSession, path: str, day: datetime.date | None) -> str:
    pointers = spark.read.schema("version string, folder string").json(f"{path}/pointers/*")
    pointers = pointers.filter(F.startswith("folder", F.lit(f"dt={day:%Y%m%d}/"))) if day else pointers
    newest = pointers.agg(F.max(F.struct("version", "folder"))).first()[0]
    if newest is None:
        raise ValueError(f"there is no archive of {day}")
    return newest["folder"]


def read_latest(spark: SparkSession, path: str, day: datetime.date | None = None) -> DataFrame:
    """The newest copy, or the newest of a day."""
    return spark.read.parquet(f"{path}/{_newest(spark, path, day)}")


def read_sidecar(spark: SparkSession, path: str, day: datetime.date | None = None) -> DataFrame:
    """(version, primary_column, columns): the sidecar document of a copy."""
    version = _newest(spark, path, day).rpartition("/")[2]
    return spark.read.text(f"{path}/sidecars/{version}").select(F.from_json("value", SIDECAR).alias("m")).select("m.*")


def covering(df: DataFrame) -> tuple[str, ...]:
    """The four box columns of a table: a struct `bbox`, or flat ones."""
    kinds = dict(df.dtypes)
    if kinds.get("bbox", "").startswith("struct"):
        return tuple(f"bbox.{c}" for c in ("xmin", "ymin", "xmax", "ymax"))
    for names in (("bbox_xmin", "bbox_ymin", "bbox_xmax", "bbox_ymax"), ("xmin", "ymin", "xmax", "ymax")):
        if all(n in kinds for n in names):
            return names
    raise ValueError("no box columns")


def geometry_column(df: DataFrame) -> str:
    for name in GEOMETRY_NAMES:
        if name in df.columns:
            return name
    raise ValueError("no geometry column")


def feature_query(df: DataFrame, box: tuple[float, ...]) -> DataFrame:
    """Features whose box meets `box` (4 or 6 numbers), without the box columns; filters reach the scan."""
    if len(box) == 6:
        box = (box[0], box[1], box[3], box[4])
    xmin, ymin, xmax, ymax = covering(df)
    found = df.filter((F.col(xmin) <= box[2]) & (F.col(xmax) >= box[0]) & (F.col(ymin) <= box[3]) & (F.col(ymax) >= box[1]))
    return found.drop("bbox", "xmin", "ymin", "xmax", "ymax", "bbox_xmin", "bbox_ymin", "bbox_xmax", "bbox_ymax")


def rows_per_file(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that make up a block, from the average size of the named columns; column statistics, not a head of rows."""
    size: Column = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in columns), F.lit(0))
    return df.agg(_rows_of(size).alias("rows_per_file"))


def _rows_of(size: Column) -> Column:
    return F.greatest(F.lit(LEAST_ROWS), F.least(F.lit(MOST_ROWS), F.floor(BLOCK_BYTES / F.nullif(F.avg(size), F.lit(0.0))))).cast("long")


#: The layout of an archive's sidecar document.
SIDECAR = "version string, primary_column string, columns struct<geom: struct<encoding: string, geometry_types: array<string>, bbox: array<double>, covering: struct<bbox: struct<xmin: array<string>, ymin: array<string>, xmax: array<string>, ymax: array<string>>>>>"


def geometry_type(wkb: Column) -> Column:
    """The type of a WKB geometry, with " Z" for three dimensions."""
    code = F.conv(F.hex(F.reverse(F.substring(wkb, 2, 4).cast("string")).cast("binary")), 16, 10).cast("int")
    return F.concat(F.element_at(F.array(*map(F.lit, WKB_NAMES)), code % 1000), F.when(code >= 1000, " Z").otherwise(""))


def sidecars(df: DataFrame, geometry: str, by: list[str]) -> DataFrame:
    """(by, value): the sidecar document of each archive, from its rows with x and y: distinct types, box and covering."""
    found = df.filter(F.col(geometry).isNotNull()).groupBy(*by).agg(F.sort_array(F.collect_set(geometry_type(F.col(geometry)))).alias("types"), *[f(c).alias(n) for n, f, c in (("w", F.min, "x"), ("s", F.min, "y"), ("e", F.max, "x"), ("n", F.max, "y"))])
    covering = F.struct(F.struct(*[F.array(F.lit("bbox"), F.lit(c)).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("bbox"))
    geom = F.struct(F.lit("WKB").alias("encoding"), F.col("types").alias("geometry_types"), F.array("w", "s", "e", "n").alias("bbox"), covering.alias("covering"))
    return found.select(*by, F.to_json(F.struct(F.lit("1.1.0").alias("version"), F.lit("geom").alias("primary_column"), F.struct(geom.alias("geom")).alias("columns"))).alias("value"))
