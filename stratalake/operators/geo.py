"""Points, boxes, Hilbert order, clipping and generalisation."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HILBERT_BITS = 16
EARTH = 6378137.0
ENVELOPE = T.StructType([*(T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")), T.StructField("vertices", T.IntegerType())])


def crs_gate(df: DataFrame, epsg: str = "epsg") -> DataFrame:
    """Rows in longitude and latitude: 0 is an error, 4326 passes, 3857 is projected back."""
    gate = F.when(F.col(epsg) == 0, F.raise_error(F.lit("unknown reference system")).cast("double"))
    lon = F.degrees(F.col("x") / EARTH)
    lat = F.degrees(2 * F.atan(F.exp(F.col("y") / EARTH)) - F.lit(np.pi / 2))
    return df.withColumns({"x": gate.when(F.col(epsg) == 4326, F.col("x")).otherwise(lon), "y": gate.when(F.col(epsg) == 4326, F.col("y")).otherwise(lat)}).withColumn(epsg, F.lit(4326))


def utm_to_lonlat(easting: Column, northing: Column, zone: int) -> tuple[Column, Column]:
    """Transverse Mercator on WGS84, northern half, in closed form to about a metre."""
    a, f, k0 = EARTH, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    e1 = (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    mu = northing / k0 / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    phi = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu)
    n1 = a / F.sqrt(1 - e2 * F.sin(phi) ** 2)
    t1, c1 = F.tan(phi) ** 2, ep2 * F.cos(phi) ** 2
    r1 = a * (1 - e2) / (1 - e2 * F.sin(phi) ** 2) ** 1.5
    d = (easting - 500000.0) / (n1 * k0)
    lat = phi - (n1 * F.tan(phi) / r1) * (d**2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1**2 - 9 * ep2) * d**4 / 24)
    lon = (d - (1 + 2 * t1 + c1) * d**3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1**2 + 8 * ep2 + 24 * t1**2) * d**5 / 120) / F.cos(phi)
    return F.degrees(lon) + (zone * 6 - 183), F.degrees(lat)


def extent(df: DataFrame) -> DataFrame:
    """The box of all points, null without any."""
    return df.agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))


def hilbert_key(x: Column, y: Column, bits: int = HILBERT_BITS) -> Column:
    """The place of cell (x, y) along the Hilbert curve of 2**bits cells a side, folded over its bits."""
    n = 1 << bits
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(acc: Column, s: Column) -> Column:
        rx, ry = acc["x"].bitwiseAND(s) > 0, acc["y"].bitwiseAND(s) > 0
        quadrant = F.when(rx & ~ry, 3).when(rx, 2).when(ry, 1).otherwise(0)
        fx, fy = F.when(rx & ~ry, n - 1 - acc["x"]).otherwise(acc["x"]), F.when(rx & ~ry, n - 1 - acc["y"]).otherwise(acc["y"])
        return F.struct(F.when(ry, acc["x"]).otherwise(fy).alias("x"), F.when(ry, acc["y"]).otherwise(fx).alias("y"), (acc["d"] + s * s * quadrant).alias("d"))

    return F.aggregate(F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, -1, -1)]), start, step)["d"]


def with_hilbert(df: DataFrame, name: str = "h", bits: int = HILBERT_BITS) -> DataFrame:
    """`df` with the Hilbert key of its points over their own extent; a side without width is widened."""
    e = extent(df).withColumnsRenamed({c: f"_{c}" for c in ("xmin", "ymin", "xmax", "ymax")})
    top = (1 << bits) - 1
    cell = lambda v, low, high: F.floor((F.col(v) - F.col(low)) / F.greatest(F.col(high) - F.col(low), F.lit(1e-9)) * top)
    return df.crossJoin(F.broadcast(e)).withColumn(name, hilbert_key(cell("x", "_xmin", "_xmax"), cell("y", "_ymin", "_ymax"), bits)).drop("_xmin", "_ymin", "_xmax", "_ymax")


def overlaps(box: tuple[float, float, float, float]) -> Column:
    """Whether a row's box meets `box`, as four comparisons that reach a Parquet scan."""
    return (F.col("xmin") <= box[2]) & (F.col("xmax") >= box[0]) & (F.col("ymin") <= box[3]) & (F.col("ymax") >= box[1])


def within(box: tuple[float, float, float, float]) -> Column:
    return F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])


def multi_area(df: DataFrame, areas: list[tuple[float, float, float, float]]) -> DataFrame:
    """Rows that meet any area, each once, from a branch an area that leaves out the areas before it."""
    branches = []
    for i, box in enumerate(areas):
        earlier = reduce(lambda a, b: a | b, [overlaps(x) for x in areas[:i]], F.lit(False))
        branches.append(df.filter(overlaps(box) & ~earlier))
    return reduce(DataFrame.unionAll, branches)


def valid_bbox(box: Column) -> Column:
    """[w, s, e, n] of a box of 4 or 6 numbers; null if it isn't finite or not on the globe."""
    flat = F.when(F.size(box) == 6, F.array(box[0], box[1], box[3], box[4])).when(F.size(box) == 4, box)
    finite = F.forall(flat, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(1e300)))
    fine = finite & (flat[0] >= -180) & (flat[2] <= 180) & (flat[1] >= -90) & (flat[3] <= 90) & (flat[0] <= flat[2]) & (flat[1] <= flat[3])
    return F.when(fine, flat)


def outward(df: DataFrame, area: tuple[float, float, float, float]) -> DataFrame:
    """The extent of finite points, rounded outward to 6 places, and whether it lies outside `area`."""
    e = extent(df.filter("not (isnan(x) or isnan(y) or abs(x) > 1e300 or abs(y) > 1e300)"))
    e = e.select(*[(F.floor(F.col(c) * 1e6) / 1e6).alias(c) for c in ("xmin", "ymin")], *[(F.ceil(F.col(c) * 1e6) / 1e6).alias(c) for c in ("xmax", "ymax")])
    return e.withColumn("outside", (F.col("xmin") < area[0]) | (F.col("ymin") < area[1]) | (F.col("xmax") > area[2]) | (F.col("ymax") > area[3]))


def thinned_specks(df: DataFrame, t: float) -> DataFrame:
    """The ids of boxes under t both ways that are the largest in their cell of t."""
    specks = df.withColumns({"w": F.col("xmax") - F.col("xmin"), "h": F.col("ymax") - F.col("ymin")}).filter((F.col("w") < t) & (F.col("h") < t))
    best = F.max_by("id", F.struct(F.col("w") * F.col("h"), -F.col("id")))
    return specks.groupBy(F.floor(F.col("xmin") / t).alias("cx"), F.floor(F.col("ymin") / t).alias("cy")).agg(best.alias("id"), F.count(F.lit(1)).alias("n"))


def block_merge(df: DataFrame, size: float, kind: str) -> DataFrame:
    """One row a block and class: the attributes of the largest box, the box of all, and how many there are."""
    area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    return df.groupBy(F.floor(F.col("xmin") / size).alias("bx"), F.floor(F.col("ymin") / size).alias("by"), kind).agg(
        F.max_by("id", F.struct(area, -F.col("id"))).alias("id"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"), F.count(F.lit(1)).alias("parts")
    )


def point_wkb(x: Column, y: Column) -> Column:
    """Well-known binary of a point; null without coordinates."""

    @F.pandas_udf("binary")
    def wkb(a: pd.Series, b: pd.Series) -> pd.Series:
        rows = np.zeros(len(a), np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")]))
        rows["order"], rows["kind"], rows["x"], rows["y"] = 1, 1, a.astype(float), b.astype(float)
        data, missing = rows.tobytes(), np.isnan(rows["x"]) | np.isnan(rows["y"])
        return pd.Series([None if gone else data[21 * i : 21 * i + 21] for i, gone in enumerate(missing)], dtype=object)

    return wkb(x, y)


def _coordinates(wkb: bytes) -> np.ndarray:
    """All coordinates of a 2D or Z geometry, at any depth."""
    out: list[np.ndarray] = []

    def read(at: int) -> int:
        order = "<" if wkb[at] else ">"
        kind = struct.unpack_from(order + "I", wkb, at + 1)[0]
        dims = 3 if kind // 1000 == 1 or kind & 0x80000000 else 2
        kind = (kind & 0xFFFF) % 1000
        at += 5

        def run(at: int, n: int) -> int:
            out.append(np.frombuffer(wkb, order + "f8", n * dims, at).reshape(n, dims)[:, :2])
            return at + 8 * n * dims

        if kind == 1:
            return run(at, 1)
        n = struct.unpack_from(order + "I", wkb, at)[0]
        at += 4
        if kind == 2:
            return run(at, n)
        for _ in range(n):
            if kind == 3:
                m = struct.unpack_from(order + "I", wkb, at)[0]
                at = run(at + 4, m)
            else:
                at = read(at)
        return at

    read(0)
    return np.concatenate(out) if out else np.zeros((0, 2))


@F.pandas_udf(ENVELOPE)
def envelope(wkb: pd.Series) -> pd.DataFrame:
    """The box and vertex count of each geometry; null where it is null or empty."""
    rows = []
    for g in wkb:
        c = _coordinates(g) if g is not None else np.zeros((0, 2))
        rows.append((*c.min(0), *c.max(0), len(c)) if len(c) else (None,) * 5)
    return pd.DataFrame(rows, columns=["xmin", "ymin", "xmax", "ymax", "vertices"])


def simplify(lines: DataFrame, tolerance: float | Column) -> DataFrame:
    """`lines` (id, xs, ys) by Douglas-Peucker, with how many vertices are left; a ring that would collapse keeps four."""

    def keep(p: np.ndarray, t: float) -> np.ndarray:
        marked, stack = np.zeros(len(p), bool), [(0, len(p) - 1)]
        marked[[0, -1]] = True
        while stack:
            a, b = stack.pop()
            if b - a < 2:
                continue
            away = _off_chord(p, a, b)
            if away.max() > t:
                k = a + 1 + int(away.argmax())
                marked[k] = True
                stack += [(a, k), (k, b)]
        if len(p) > 3 and (p[0] == p[-1]).all():
            while marked.sum() < 4:  # the vertex that is furthest from what is kept
                at = np.flatnonzero(marked)
                far = [(float(_off_chord(p, a, b).max()), a + 1 + int(_off_chord(p, a, b).argmax())) for a, b in zip(at, at[1:]) if b - a > 1]
                marked[max(far)[1]] = True
        return marked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, xs, ys, t in zip(*(batch.column(c).to_pylist() for c in ("id", "xs", "ys", "t"))):
                p = np.column_stack((xs, ys)).astype(float)
                m = keep(p, t) if len(p) > 2 else np.ones(len(p), bool)
                rows.append((i, p[m, 0].tolist(), p[m, 1].tolist(), int(m.sum())))
            yield pa.RecordBatch.from_pylist([dict(zip(("id", "xs", "ys", "n"), r)) for r in rows], pa.schema([("id", pa.int64()), ("xs", pa.list_(pa.float64())), ("ys", pa.list_(pa.float64())), ("n", pa.int32())]))

    t = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    return lines.select(F.col("id").cast("long"), "xs", "ys", t.cast("double").alias("t")).mapInArrow(run, "id bigint, xs array<double>, ys array<double>, n int")


def _off_chord(p: np.ndarray, a: int, b: int) -> np.ndarray:
    """How far the vertices between a and b are from the line through both; from the point where they are one."""
    d, inner = p[b] - p[a], p[a + 1 : b] - p[a]
    length = float(np.hypot(*d))
    return np.abs(d[0] * inner[:, 1] - d[1] * inner[:, 0]) / length if length else np.hypot(inner[:, 0], inner[:, 1])


#: A layer gets overviews from so many vertices, and keeps a level under this share of the one before.
OVERVIEW_VERTICES, LEVEL_SHARE = 1_000_000, 0.7


def overview(shapes: DataFrame, t: float) -> DataFrame:
    """`shapes` (id, xs, ys) generalised to a tolerance: of the specks (under t both ways) of a cell the widest stays, the rest is simplified.

    A ring narrower than t (twice its area over its length) gets a quarter of the tolerance; empty shapes are dropped.
    """
    ends = shapes.filter(F.size("xs") > 0).withColumns({"x0": F.array_min("xs"), "x1": F.array_max("xs"), "y0": F.array_min("ys"), "y1": F.array_max("ys")})
    wide = (F.col("x1") - F.col("x0")) + (F.col("y1") - F.col("y0"))
    speck = (F.col("x1") - F.col("x0") < t) & (F.col("y1") - F.col("y0") < t)
    shown = ends.filter(speck).groupBy(F.floor(F.col("x0") / t), F.floor(F.col("y0") / t)).agg(F.max_by("id", F.struct(wide, -F.col("id"))).alias("s_id")).select("s_id")
    kept = ends.filter(~speck).unionByName(ends.filter(speck).join(shown, F.col("id") == F.col("s_id"), "left_semi"))
    corner = F.sequence(F.lit(1), F.size("xs") - 1)
    x, y = (lambda i: F.get("xs", i)), (lambda i: F.get("ys", i))
    total = lambda f: F.aggregate(F.transform(corner, f), F.lit(0.0), lambda s, v: s + v)
    ring = (F.size("xs") > 3) & (F.element_at("xs", 1) == F.element_at("xs", -1)) & (F.element_at("ys", 1) == F.element_at("ys", -1))
    area = F.abs(total(lambda i: x(i - 1) * y(i) - x(i) * y(i - 1))) / 2
    length = total(lambda i: F.hypot(x(i) - x(i - 1), y(i) - y(i - 1)))
    thin = F.when(ring, 2 * area < t * length).otherwise(False)
    return simplify(kept, F.when(thin, t / 4).otherwise(t))


def overview_gate(df: DataFrame, vertices: Column, point: Column, by: list[str] = (), least: int = OVERVIEW_VERTICES) -> DataFrame:
    """(by, vertices, build): a layer gets overviews if it has enough vertices and isn't all points."""
    layers = df.groupBy(*by).agg(F.coalesce(F.sum(vertices), F.lit(0)).cast("long").alias("vertices"), F.coalesce(F.bool_and(point), F.lit(True)).alias("points"))
    return layers.select(*by, "vertices", (~F.col("points") & (F.col("vertices") >= least)).alias("build"))


def kept_levels(sizes: Column) -> Column:
    """Which levels are written, from the sizes of the data and of its levels: those under LEVEL_SHARE of the last one that was."""
    start = F.struct(F.get(sizes, F.lit(0)).alias("last"), F.array().cast("array<boolean>").alias("kept"))
    step = lambda acc, s: F.struct(F.when(s < LEVEL_SHARE * acc["last"], s).otherwise(acc["last"]).alias("last"), F.concat(acc["kept"], F.array(s < LEVEL_SHARE * acc["last"])).alias("kept"))
    return F.aggregate(F.slice(sizes, F.lit(2), F.size(sizes)), start, step)["kept"]
