"""Sources: discovered tables, partitioned scans, feeds, documents, catalogues, delimited tables and paged services."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stratalake.plans.storage import row_bytes, written

HEADER_ROWS = 10
FOOTERS = "path string, row_group int, rows bigint, bytes bigint, xmin double, ymin double, xmax double, ymax double"


def discover(tables: DataFrame, suffix: str, schemas: list[str]) -> DataFrame:
    """(schema, layer, stem) of tables whose name ends in the suffix and is a plain identifier, in order."""
    plain = F.col("name").rlike("^[a-z_][a-z0-9_]*$")
    found = tables.filter(F.endswith("name", F.lit(suffix)) & plain & F.col("schema").isin(schemas))
    return found.select("schema", F.col("name").alias("layer"), F.expr(f"substring(name, 1, length(name) - {len(suffix)})").alias("stem")).orderBy("schema", "layer")


def ranges(key: str, low: int, high: int, n: int) -> list[str]:
    """Predicates that split a key into n disjoint ranges; the first has no lower end and takes nulls, the last no upper end."""
    return _between(key, sorted({low + (high - low) * i // n for i in range(1, n)}))


#: A table under this many bytes is read by one scan; sizes are told apart in this many steps of a range's share.
LEAST_BYTES, STEPS = 64 << 20, 16
#: Parts that a stretch of keys is cut into before it is looked at again.
FANOUT = 64


def byte_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """Up to n - 1 bounds of a whole-number key between which rows have about equal bytes.

    Stretches of keys are weighed by mergeable histograms: those that weigh more than a small part of a range's share are cut into FANOUT stretches and weighed again, each time for
    all such stretches in one pass, until they are light or of one key. What comes to the driver are the heavy stretches' parts, some n * STEPS * FANOUT numbers a pass.
    """
    sized = written(df.select(F.col(key).cast("long").alias("k"), row_bytes(df).alias("b")).filter("k is not null"), "row-sizes")
    low, high, total = sized.agg(F.min("k"), F.max("k"), F.sum("b")).first()
    if low is None or not total:
        return []
    light, done, heavy = total / (n * STEPS), [], [(low, high + 1)]
    while heavy:
        width = {a: max(1, -(-(b - a) // FANOUT)) for a, b in heavy}
        cuts = sized.sparkSession.createDataFrame([(a, b, width[a]) for a, b in heavy], "a long, z long, w long")
        found = sized.join(F.broadcast(cuts), (F.col("k") >= F.col("a")) & (F.col("k") < F.col("z"))).groupBy((F.col("a") + (F.expr("(k - a) div w")) * F.col("w")).alias("start"), "w", "z").agg(F.sum("b").alias("b")).collect()
        heavy = []
        for r in found:
            end = min(r["start"] + r["w"], r["z"])
            if r["b"] > light and r["w"] > 1:
                heavy.append((r["start"], end))
            else:
                done.append((r["start"], r["b"]))
    bounds, weight = [], 0
    for start, b in sorted(done):
        if weight + b / 2 >= total * (len(bounds) + 1) / n and weight and len(bounds) < n - 1:
            bounds.append(start)
        weight += b
    return bounds


def byte_ranges(df: DataFrame, key: str, n: int, least_bytes: int = LEAST_BYTES) -> list[str]:
    """Predicates that split a table into up to n disjoint ranges of about equal bytes; rows that come later fall into the last, null keys into the first.

    A small table, or one whose key is no whole number, is one scan.
    """
    whole = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    if not whole or (df.agg(F.sum(row_bytes(df))).first()[0] or 0) < least_bytes:
        return ["1 = 1"]
    return _between(key, byte_bounds(df, key, n))


def _between(key: str, bounds: list[int]) -> list[str]:
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {a} and {key} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"({key} < {bounds[0]} or {key} is null)", *inner, f"{key} >= {bounds[-1]}"]


def partitioned_scan(read: Callable[[str], DataFrame], key: str, low: int, high: int, n: int) -> DataFrame:
    """One table as the union of its ranges; `read` gets a predicate. For a database, pass the predicates to spark.read.jdbc."""
    out = None
    for predicate in ranges(key, low, high, n):
        part = read(predicate)
        out = part if out is None else out.unionAll(part)
    return out


def typed_json(df: DataFrame, column: str, schema: str, lists: tuple[str, ...] = ()) -> DataFrame:
    """`df` with `column` parsed; a field in `lists` that isn't an array is an error."""
    checks = [F.when(F.get_json_object(column, f"$.{c}").isNotNull() & ~F.startswith(F.get_json_object(column, f"$.{c}"), F.lit("[")), F.raise_error(F.lit(f"{c} must be a list"))) for c in lists]
    parsed = F.from_json(F.coalesce(*[c.cast("string") for c in checks], F.col(column)) if checks else F.col(column), schema)
    return df.withColumn(column, parsed)


def as_text(df: DataFrame) -> DataFrame:
    """Every value as text: null is empty, arrays are joined by ", "."""
    text = lambda c, t: F.concat_ws(", ", F.col(f"`{c}`").cast("array<string>")) if t.startswith("array") else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return df.select(*[text(c, t).alias(c) for c, t in df.dtypes])


def document_scan(spark: SparkSession, path: str) -> DataFrame:
    """(the folder's partition columns, id, body) of text files: the id is the file's stem in upper case; blank ones are left out."""
    files = spark.read.text(path, wholetext=True)
    folders = [c for c in files.columns if c != "value"]
    rows = files.select(*folders, F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("f"), F.col("value").alias("body"))  # Spark gives names encoded
    return rows.filter(F.col("body").rlike(r"\S")).select(*folders, F.upper(F.regexp_replace("f", r"\.[^.]*$", "")).alias("id"), "body")


def catalogue_scan(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON documents (one a line) with their folder's partition columns, and those that can't be read as (file, problem)."""
    lines = spark.read.text(path).withColumn("file", F.col("_metadata.file_name"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_problem"}
    parsed = lines.withColumn("doc", F.from_json("value", f"{schema}, _problem string", options))
    folders = [c for c in lines.columns if c not in ("value", "file")]
    good = parsed.filter("doc._problem is null").select(*folders, "doc.*").drop("_problem")
    return good, parsed.filter("doc._problem is not null").select(*folders, "file", F.col("value").alias("problem"))


def header_rows(grids: DataFrame, sheet: str = "sheet") -> DataFrame:
    """(sheet, row_no, cells) of `grids` (sheet, row_no, cells): of each sheet's first ten rows, the first that is mostly distinct words and at least half as wide as the widest."""
    filled = F.filter("cells", lambda c: F.trim(c) != "")
    words = F.filter(filled, lambda c: ~F.regexp_like(c, F.lit(r"^\s*-?[0-9.,]+\s*$")))
    rows = grids.filter(F.col("row_no") < HEADER_ROWS).select(sheet, "row_no", "cells", F.size(filled).alias("n"), F.size(words).alias("w"), F.size(F.array_distinct(F.transform(filled, F.lower))).alias("d"))
    widest = rows.withColumn("widest", F.max("n").over(Window.partitionBy(sheet)))  # ten rows a sheet at most
    fine = (F.col("n") > 0) & (F.col("w") * 10 >= F.col("n") * 8) & (F.col("d") * 2 >= F.col("n")) & (F.col("n") * 2 >= F.col("widest"))
    return widest.filter(fine).groupBy(sheet).agg(F.min_by(F.struct("row_no", "cells"), "row_no").alias("h")).select(sheet, "h.*")


def sniff_delimiter(lines: DataFrame) -> Column:
    """The delimiter that occurs most in the first lines, as an aggregate over (value)."""
    counts = [F.struct(F.sum(F.length("value") - F.length(F.replace(F.col("value"), F.lit(d)))).alias("n"), F.lit(d).alias("d")) for d in (",", ";", "\t", "|")]
    return F.greatest(*counts)["d"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of text files, in UTF-8 or, where they aren't that, in cp1252; a byte order mark goes."""
    lines = spark.read.text(path)
    if lines.filter(~F.is_valid_utf8("value")).isEmpty():
        return lines.select(F.regexp_replace("value", "^\ufeff", "").alias("value"))
    # cp1252 is Latin-1 but for the bytes from 80 to 9f.
    others = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    known = {k: v for k, v in others.items() if v}
    return lines.select(F.translate(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), "".join(known), "".join(known.values())).alias("value"))


def csv_table(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """A delimited table as it is found: each column is whole numbers, numbers or text, and ragged rows are left out and counted.

    The header is the first of the first ten lines that looks like one (see `header_rows`), or else the first line; lines before it are left out, and so are repeats of
    these. A row of units below it, all in brackets or blank, is folded into the names. Names are made up for blank columns and repeated ones are numbered. Numbers with leading zeros are ids and stay text.
    """
    lines = _lines(spark, path)
    head = lines.limit(HEADER_ROWS)
    top = [r["value"] for r in head.collect()]
    if not top:
        return spark.createDataFrame([], "value string"), 0
    delimiter = head.agg(sniff_delimiter(head).alias("d")).first()["d"] or ","
    cells = F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(max(x.count(delimiter) for x in top) + 1))), {"sep": delimiter})
    grid = spark.createDataFrame([(0, i, v) for i, v in enumerate(top)], "sheet int, row_no int, value string")
    grid = grid.select("sheet", "row_no", F.array_compact(F.transform(F.array(*[cells[f"c{i}"] for i in range(max(x.count(delimiter) for x in top) + 1)]), lambda c: c)).alias("cells"))
    found_at = header_rows(grid).first()
    at = found_at["row_no"] if found_at else 0
    names = [n or "" for n in spark.createDataFrame([(top[at],)], "value string").select(F.array(*[cells[f"c{i}"] for i in range(top[at].count(delimiter) + 1)]).alias("n")).first()["n"]]
    units = [u.strip() for u in top[at + 1].split(delimiter)] if at + 1 < len(top) else []
    has_units = len(units) == len(names) and any(units) and all(not u or re.fullmatch(r"[(\[].*[)\]]", u) for u in units)
    names = _distinct_names([f"{n.strip()} {u}".strip() if has_units else n.strip() for n, u in zip(names, units if has_units else names)])
    schema = ", ".join(f"`{n}` string" for n in names) + ", _bad string"
    left_out = top[: at + 1 + has_units]
    parsed = lines.filter(~F.col("value").isin(left_out) & (F.trim("value") != "")).select(F.from_csv("value", F.lit(schema), {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    rows = parsed.select("r.*")
    text = lambda n: F.when(F.col("_bad").isNull(), F.nullif(F.trim(F.col(f"`{n}`")), F.lit("")))
    shaped = lambda n, pattern: F.bool_and(F.coalesce(text(n).rlike(pattern), F.lit(True)))
    zeros = lambda n: F.coalesce(F.bool_or(text(n).rlike("^0[0-9]")), F.lit(False))
    kind = lambda n: F.when(zeros(n), "string").when(shaped(n, r"^-?[0-9]{1,18}$"), "bigint").when(shaped(n, r"^-?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?$"), "double").otherwise("string")
    found = rows.agg(F.count("_bad").alias("_ragged"), *[kind(n).alias(n) for n in names]).first()
    return rows.filter("_bad is null").select(*[F.nullif(F.col(f"`{n}`"), F.lit("")).cast(found[n]).alias(n) if found[n] != "string" else F.col(f"`{n}`").alias(n) for n in names]), found["_ragged"]


def _distinct_names(names: list[str]) -> list[str]:
    """Names without backquotes; blank ones are made up, repeats are numbered, whatever their case."""
    out: list[str] = []
    for i, n in enumerate(names):
        n = base = n.replace("`", "'") or f"column_{i + 1}"
        k = 2
        while n.lower() in (x.lower() for x in out):
            n, k = f"{base}_{k}", k + 1
        out.append(n)
    return out


class Page(InputPartition):
    def __init__(self, offset: int):
        self.offset = offset


class PagedSource(DataSource):
    """A paged service as a table, a partition a page. Options: total, page, fetch: an importable "module:function", and source, which is handed to it."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id bigint, name string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.total, self.page, self.fetch, self.source = int(options["total"]), int(options["page"]), options["fetch"], options["source"]

    def partitions(self) -> list[Page]:
        return [Page(at) for at in range(0, self.total, self.page)]

    def read(self, part: Page) -> Iterator[tuple]:
        """A page, in halves when it fails; too few rows are an error."""
        import importlib

        module, function = self.fetch.split(":")
        fetch = getattr(importlib.import_module(module), function)
        wanted, at, size = min(self.page, self.total - part.offset), part.offset, self.page
        end = part.offset + wanted
        while at < end:
            try:
                rows = fetch(self.source, at, min(size, end - at))
            except OSError:
                if size == 1:
                    raise
                size = max(1, size // 2)
                continue
            if not rows:
                raise ValueError(f"no rows from {at}; {self.total} were declared")
            yield from rows
            at += len(rows)


def footers(spark: SparkSession, path: str, box: tuple[str, str, str, str]) -> DataFrame:
    """Rows, bytes and box of each row group, from the statistics in the footers of Parquet files.

    Files are listed by Spark and opened where they lie, so that only their footers are read, whatever their size.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("row_group", pa.int32()), ("rows", pa.int64()), ("bytes", pa.int64()), *((c, pa.float64()) for c in ("xmin", "ymin", "xmax", "ymax"))])
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                store, place = FileSystem.from_uri(name)
                with store.open_input_file(place) as f:
                    meta = pq.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
                    ends = [getattr(stats.get(c), "min" if k < 2 else "max", None) for k, c in enumerate(box)]
                    out.append(dict(zip(schema.names, (name, g, group.num_rows, group.total_byte_size, *ends))))
            yield pa.RecordBatch.from_pylist(out, schema)

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(F.regexp_replace("path", "^file:/(?!/)", "file:///").alias("path"))
    return listed.mapInArrow(read, FOOTERS)
