"""Joins of points and boxes by grid cell.

Rows of equal coordinates meet the other side once: they are gathered first, and written out as pairs only where they hit, in tasks of about equal numbers of
pairs. What asks for one row a point decides it for each place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.plans.storage import small, written

#: Rows of equal coordinates that stand in one row, about, and pairs that a task writes out.
MEMBERS, TASK_PAIRS = 1024, 4_000_000
BOX = ["xmin", "ymin", "xmax", "ymax"]


def cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def gathered(df: DataFrame, value: list[str], name: str) -> DataFrame:
    """`df` with its rows of equal `value` columns as one, the other columns in an array `name`; those of more than MEMBERS rows have several, told apart by `name`_part."""
    hot = df.groupBy(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(value)]).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MEMBERS)
    same = F.lit(True)
    for i, c in enumerate(value):
        same = same & F.col(c).eqNullSafe(F.col(f"_v{i}"))
    part = F.coalesce(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("_n") / MEMBERS)), F.lit(0))
    parted = df.join(small(hot), same, "left").withColumn(f"{name}_part", part)
    return parted.groupBy(*value, f"{name}_part").agg(F.collect_list(F.struct(*[c for c in df.columns if c not in value])).alias(name))


def spread(met: DataFrame, left: str, right: str) -> DataFrame:
    """Rows with two arrays of gathered rows, in as many partitions as their pairs need."""
    met = written(met, "met")
    pairs = met.agg(F.sum(F.size(left).cast("long") * F.size(right))).first()[0] or 0
    return met.repartition(-(-pairs // TASK_PAIRS) or 1, F.xxhash64(left, right))


def paired(met: DataFrame, left: str, right: str) -> DataFrame:
    """A row for each pair of the rows gathered in two arrays, with the columns that both met by."""
    others = [c for c in met.columns if c not in (left, right, f"{left}_part", f"{right}_part")]
    pairs = spread(met, left, right).select(*others, F.explode(left).alias(left), right).select(*others, left, F.explode(right).alias(right))
    return pairs.select(*others, f"{left}.*", f"{right}.*")


def paired_once(met: DataFrame, left: str, right: str, same: Column, key: str) -> DataFrame:
    """(a, b): each unordered pair of keys of the rows gathered in two arrays, the smaller first; `same` tells that both are one."""
    pairs = spread(met.select(left, right, same.alias("_same")), left, right)
    pairs = pairs.select("_same", F.explode(F.col(f"{left}.{key}")).alias("_a"), right).select("_same", "_a", F.explode(F.col(f"{right}.{key}")).alias("_b"))
    once = (F.col("_a") < F.col("_b")) | (~F.col("_same") & (F.col("_a") > F.col("_b")))
    return pairs.filter(once).select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))


def _in_cells(points: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    placed = boxes.withColumn("_cx", F.explode(cells(F.col("xmin"), F.col("xmax"), size))).withColumn("_cy", F.explode(cells(F.col("ymin"), F.col("ymax"), size)))
    keyed = points.withColumns({"_cx": F.floor(F.col("x") / size), "_cy": F.floor(F.col("y") / size)})
    inside = F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    return keyed.join(placed, ["_cx", "_cy"]).filter(inside).drop("_cx", "_cy")


def on_grid(points: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """Points joined to the boxes that hold them (edges included), by an equi-join on the cells of a grid.

    A box stands in each cell it touches and a point in one, so a pair meets once; a crowded cell is an ordinary
    skewed key, which Spark splits.
    """
    met = _in_cells(gathered(points.filter("x is not null and y is not null"), ["x", "y"], "_l"), gathered(boxes, BOX, "_r"), size)
    return paired(met, "_l", "_r").select(*points.columns, *boxes.columns)


def top_at(points: DataFrame, boxes: DataFrame, value: Column, order: Column, size: float, pick: Callable[[Column, Column], Column] = F.min_by) -> DataFrame:
    """(x, y, value): for each place of a point that boxes hold, the value of the box that is first by `order` (with F.max_by: last)."""
    own = F.struct(order.alias("o"), value.alias("v"))
    each = boxes.groupBy(*BOX).agg(pick(own, order).alias("_b"))
    met = _in_cells(points.select("x", "y").distinct(), each, size)
    return met.groupBy("x", "y").agg(pick("_b", "_b.o").alias("_b")).select("x", "y", F.col("_b.v").alias("value"))


def _boxes_met(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    a = a.withColumn("_cx", F.explode(cells(F.col("xmin"), F.col("xmax"), size))).withColumn("_cy", F.explode(cells(F.col("ymin"), F.col("ymax"), size)))
    b = b.withColumn("_cx", F.explode(cells(F.col("rxmin"), F.col("rxmax"), size))).withColumn("_cy", F.explode(cells(F.col("rymin"), F.col("rymax"), size)))
    x, y = F.greatest("xmin", "rxmin"), F.greatest("ymin", "rymin")
    meet = (x <= F.least("xmax", "rxmax")) & (y <= F.least("ymax", "rymax"))
    return a.join(b, ["_cx", "_cy"]).filter(meet & (F.col("_cx") == F.floor(x / size)) & (F.col("_cy") == F.floor(y / size))).drop("_cx", "_cy")


def box_pairs(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs of overlapping boxes; each pair is kept in the cell of the corner that its overlap begins at.

    The right side's box columns are rxmin, rymin, rxmax and rymax.
    """
    met = _boxes_met(gathered(left, BOX, "_l"), gathered(right, [f"r{c}" for c in BOX], "_r"), size)
    return paired(met, "_l", "_r").select(*left.columns, *right.columns)


def _doubled(rows: DataFrame, value: list[str], names: list[str]) -> tuple[DataFrame, DataFrame, Column, Column]:
    """Gathered rows as both sides of a join with themselves, whether a pair's left comes first, and whether both are one."""
    left = gathered(rows, value, "_l")
    right = left.select(*[F.col(c).alias(n) for c, n in zip(value, names)], F.col("_l_part").alias("_r_part"), F.col("_l").alias("_r"))
    here, there = F.struct(*value, "_l_part"), F.struct(*[F.col(n).alias(c) for c, n in zip(value, names)], F.col("_r_part").alias("_l_part"))
    return left, right, here <= there, here == there


def overlapping(boxes: DataFrame, key: str, size: float) -> DataFrame:
    """(a, b): the pairs of overlapping boxes of one table, the smaller key first."""
    rows = written(boxes.select(key, *BOX), "boxes")
    left, right, first, same = _doubled(rows, BOX, [f"r{c}" for c in BOX])
    return paired_once(_boxes_met(left, right, size).filter(first), "_l", "_r", same, key)


def _near(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    reach = radius * (1 + 1e-9) + 1e-9  # the distance decides, not the rounding of a box
    boxes = right.withColumns({"xmin": F.col("ox") - reach, "xmax": F.col("ox") + reach, "ymin": F.col("oy") - reach, "ymax": F.col("oy") + reach})
    near = _in_cells(left, boxes, max(radius * 2, 1e-9)).drop(*BOX)
    return near.filter((F.col("x") - F.col("ox")) ** 2 + (F.col("y") - F.col("oy")) ** 2 <= radius**2)


def near_points(points: DataFrame, others: DataFrame, radius: float) -> DataFrame:
    """Pairs of points (x, y) and others (ox, oy) at most `radius` apart."""
    met = _near(gathered(points.filter("x is not null and y is not null"), ["x", "y"], "_l"), gathered(others, ["ox", "oy"], "_r"), radius)
    return paired(met, "_l", "_r").select(*points.columns, *others.columns)


def near_pairs(points: DataFrame, key: str, radius: float) -> DataFrame:
    """(a, b): the pairs of points of one table at most `radius` apart, the smaller key first."""
    rows = written(points.filter("x is not null and y is not null").select(key, "x", "y"), "points")
    left, right, first, same = _doubled(rows, ["x", "y"], ["ox", "oy"])
    return paired_once(_near(left, right, radius).filter(first), "_l", "_r", same, key)


def ring(points: DataFrame, radius: Column, n: int = 8) -> DataFrame:
    """`points` once for each of n places on a circle around them."""
    turns = F.array(*[F.lit(k) for k in range(n)])
    placed = points.withColumn("_k", F.explode(turns))
    angle = F.col("_k") * F.lit(6.283185307179586 / n)
    return placed.withColumns({"x": F.col("x") + radius * F.cos(angle), "y": F.col("y") + radius * F.sin(angle)}).drop("_k")


#: How far a line can be off, as a share of the scale's denominator (in metres), and the metres of a degree of latitude.
OFF_BY, DEGREE_METRES = 0.0005, 111_320.0


def ring_metres(points: DataFrame, metres: Column, n: int = 8) -> DataFrame:
    """`points` (degrees) once for each of n places on a circle of so many metres around them."""
    up = metres / DEGREE_METRES
    across = up / F.cos(F.radians("y"))
    angle = F.col("_k") * F.lit(6.283185307179586 / n)
    placed = points.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in range(n)])))
    return placed.withColumns({"x": F.col("x") + across * F.cos(angle), "y": F.col("y") + up * F.sin(angle)}).drop("_k")


def near_contacts(points: DataFrame, key: str, units: DataFrame, size: float) -> DataFrame:
    """(key, unit, scale, metres, other): the unit at each point, on its most detailed map, and another unit within that map's tolerance, if any.

    `units` has (unit, scale, feature, xmin, ymin, xmax, ymax); maps of unknown scale come last and have no tolerance, ties are decided by feature. A unit without
    a name is none. Points without a unit are left out; of several others the first by name is told.
    """
    named = units.filter("unit is not null")
    order = F.struct(F.col("scale").isNull(), F.col("scale"), F.col("feature"))
    here = top_at(points, named, F.struct("unit", "scale"), order, size).select("x", "y", F.col("value.unit").alias("unit"), F.col("value.scale").alias("scale"), (F.col("value.scale") * OFF_BY).alias("metres"))
    here = written(here, "units-at")  # a row a place
    around = ring_metres(here.filter("metres is not null").select("x", "y", F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("unit").alias("_own"), "metres"), F.col("metres"))
    # Of the units of equal boxes, the first two by name: one of them is not the point's own.
    kinds = written(named.select("unit", *BOX).distinct(), "unit-boxes")
    first = kinds.groupBy(*BOX).agg(F.min("unit").alias("_first"))
    second = kinds.join(first, BOX).filter("unit <> _first").groupBy(*BOX).agg(F.min("unit").alias("unit"))
    two = first.withColumnRenamed("_first", "unit").unionByName(second)
    others = _in_cells(around, two, size).filter("unit <> _own").groupBy(F.col("_x").alias("x"), F.col("_y").alias("y")).agg(F.min("unit").alias("other"))
    return points.select(key, "x", "y").join(here.join(others, ["x", "y"], "left"), ["x", "y"]).select(key, "unit", "scale", "metres", "other")


def in_ring(x: Column, y: Column, xs: Column, ys: Column) -> Column:
    """Even-odd test of a point in a closed ring of coordinates, as a fold over its edges."""
    edges = F.arrays_zip(F.slice(xs, 1, F.size(xs) - 1).alias("x0"), F.slice(ys, 1, F.size(ys) - 1).alias("y0"), F.slice(xs, 2, F.size(xs) - 1).alias("x1"), F.slice(ys, 2, F.size(ys) - 1).alias("y1"))
    crosses = lambda e: ((e["y0"] > y) != (e["y1"] > y)) & (x < (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"])
    return F.aggregate(edges, F.lit(False), lambda odd, e: F.when(F.coalesce(crosses(e), F.lit(False)), ~odd).otherwise(odd))


def ring_meets(xs: Column, ys: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a closed ring meets a box: an edge passes through it, or the box lies inside the ring."""
    w, s, e, n = (F.lit(float(v)) for v in box)
    edges = F.arrays_zip(F.slice(xs, 1, F.size(xs) - 1).alias("x0"), F.slice(ys, 1, F.size(ys) - 1).alias("y0"), F.slice(xs, 2, F.size(xs) - 1).alias("x1"), F.slice(ys, 2, F.size(ys) - 1).alias("y1"))

    def passes(edge: Column) -> Column:
        # The part of the edge between the box's sides, across and up; a level or upright edge gets the least slope.
        dx = F.when(edge["x1"] == edge["x0"], 1e-300).otherwise(edge["x1"] - edge["x0"])
        dy = F.when(edge["y1"] == edge["y0"], 1e-300).otherwise(edge["y1"] - edge["y0"])
        ax, bx, ay, by = (w - edge["x0"]) / dx, (e - edge["x0"]) / dx, (s - edge["y0"]) / dy, (n - edge["y0"]) / dy
        return F.greatest(F.least(ax, bx), F.least(ay, by), F.lit(0.0)) <= F.least(F.greatest(ax, bx), F.greatest(ay, by), F.lit(1.0))

    return F.exists(edges, passes) | in_ring(w, s, xs, ys)


def diamond_meets(cx: Column, cy: Column, a: Column, b: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a diamond of half axes a and b meets a box, from its centre: corners computed from it may round to the other side of a box that they touch."""
    w, s, e, n = (F.lit(float(v)) for v in box)
    return F.greatest(F.lit(0.0), w - cx, cx - e) / a + F.greatest(F.lit(0.0), s - cy, cy - n) / b <= 1


def boxed(shapes: DataFrame, margin: float = 0.0) -> DataFrame:
    """`shapes` (xs, ys) with their boxes, widened by a margin; shapes without coordinates drop out."""
    return shapes.filter(F.size("xs") > 0).withColumns({"xmin": F.array_min("xs") - margin, "xmax": F.array_max("xs") + margin, "ymin": F.array_min("ys") - margin, "ymax": F.array_max("ys") + margin})


def _in_rings(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    return _in_cells(points, boxed(polygons), size).filter(in_ring(F.col("x"), F.col("y"), F.col("xs"), F.col("ys"))).drop("xs", "ys", *BOX)


def _in_range(points: DataFrame) -> DataFrame:
    return points.filter(F.col("x").between(-180, 180) & F.col("y").between(-90, 90))  # what is out of range is nowhere


def in_polygons(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """Points (x, y) joined to the polygons (closed rings xs, ys) that hold them: by grid cell and box, then by the ring."""
    met = _in_rings(gathered(_in_range(points), ["x", "y"], "_l"), gathered(polygons, ["xs", "ys"], "_r"), size)
    return paired(met, "_l", "_r").select(*points.columns, *[c for c in polygons.columns if c not in ("xs", "ys")])


def first_in_polygons(points: DataFrame, polygons: DataFrame, key: str, size: float) -> DataFrame:
    """(x, y, key): for each place of a point that polygons hold, the least key of them."""
    shapes = polygons.groupBy("xs", "ys").agg(F.min(key).alias(key))
    return _in_rings(_in_range(points).select("x", "y").distinct(), shapes, size).groupBy("x", "y").agg(F.min(key).alias(key))


def line_distance(x: Column, y: Column, xs: Column, ys: Column) -> Column:
    """How far a point is from a line of coordinates; a single coordinate is a point."""

    def far(i: Column) -> Column:
        x0, y0 = F.get(xs, i), F.get(ys, i)
        dx, dy = F.get(xs, i + 1) - x0, F.get(ys, i + 1) - y0
        along = F.coalesce(F.try_divide((x - x0) * dx + (y - y0) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        return F.hypot(x - x0 - t * dx, y - y0 - t * dy)

    return F.when(F.size(xs) > 1, F.array_min(F.transform(F.sequence(F.lit(0), F.size(xs) - 2), far))).otherwise(F.hypot(x - F.get(xs, F.lit(0)), y - F.get(ys, F.lit(0))))


def near_features(points: DataFrame, shapes: DataFrame, tolerance: float, size: float) -> DataFrame:
    """Points (x, y) joined to the shapes (xs, ys, polygon) at or within a tolerance of them; a polygon also holds what lies inside it."""
    near = _in_cells(gathered(points.filter("x is not null and y is not null"), ["x", "y"], "_l"), boxed(gathered(shapes, ["xs", "ys", "polygon"], "_r"), tolerance), size)
    x, y, xs, ys = (F.col(c) for c in ("x", "y", "xs", "ys"))
    hit = (F.col("polygon") & in_ring(x, y, xs, ys)) | (line_distance(x, y, xs, ys) <= tolerance)
    met = near.filter(hit).drop("xs", "ys", "polygon", *BOX)
    return paired(met, "_l", "_r").select(*points.columns, *[c for c in shapes.columns if c not in ("xs", "ys", "polygon")])
