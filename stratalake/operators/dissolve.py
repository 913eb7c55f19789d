"""Dissolving polygons by key: shared borders go, what is left is stitched into rings, and holes are given to the ring around them.

Rings are oriented (outer ones with the inside to the left) and cut into edges on a grid of coordinates. Edges that a key has in both directions cancel; borders
must share their vertices for that. At the end of an edge, the next one is the first clockwise from the way back, so rings that touch in a
point stay apart. Rings are named by pointer jumping along the next edges, in rounds of self-joins whose number is the logarithm of the longest ring, and
only then is a ring, a row of the result, put together by a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.regions import in_regions, region_cells, ring_edges
from stratalake.plans.storage import written

#: Coordinates are told apart by this.
PRECISION = 1e-7
RINGS = "key string, ring bigint, xs array<double>, ys array<double>, area double"


def ring_area(xs: Column, ys: Column) -> Column:
    """The area of a closed ring, positive if it runs with its inside to the left."""
    cross = F.transform(F.sequence(F.lit(0), F.size(xs) - 2), lambda i: F.get(xs, i) * F.get(ys, i + 1) - F.get(xs, i + 1) * F.get(ys, i))
    return F.when(F.size(xs) > 2, F.aggregate(cross, F.lit(0.0), lambda a, b: a + b) / 2).otherwise(0.0)


def boundary(shapes: DataFrame, key: str, hole: str | None = None, precision: float = PRECISION) -> DataFrame:
    """(key, x0, y0, x1, y1), in steps of `precision`: the edges of closed rings (xs, ys) that don't cancel within a key.

    `hole` names a boolean column for rings that are holes; without it no ring is one. Rings may run either way.
    """
    is_hole = F.col(hole) if hole else F.lit(False)
    rings = shapes.select(F.col(key).cast("string").alias("key"), "xs", "ys", ((ring_area(F.col("xs"), F.col("ys")) < 0) != is_hole).alias("turn"))
    edges = ring_edges(rings, "key", "turn")
    on = lambda c: F.round(F.col(c) / precision).cast("long").alias(c)
    edges = edges.select("key", "turn", *map(on, ("x0", "y0", "x1", "y1"))).filter("x0 <> x1 or y0 <> y1")
    a, b = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    way = F.when((a < b) != F.col("turn"), 1).otherwise(-1)
    net = edges.groupBy("key", F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.sum(way).alias("n")).filter("n <> 0")
    start, end = F.when(F.col("n") > 0, F.col("a")).otherwise(F.col("b")), F.when(F.col("n") > 0, F.col("b")).otherwise(F.col("a"))
    # Shapes that overlap leave an edge more than once; it stays as often.
    return net.withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("n").cast("int")))).select("key", start["x"].alias("x0"), start["y"].alias("y0"), end["x"].alias("x1"), end["y"].alias("y1"))


def _linked(edges: DataFrame) -> DataFrame:
    """(key, id, next, x0, y0): edges with the edge that follows each.

    At a vertex, edges that come in and those that go out take turns around it, so each incoming one has the first outgoing one clockwise of it.
    """
    numbered = written(edges.withColumn("id", F.monotonically_increasing_id()), "boundary")
    angle = lambda dx, dy: F.atan2(dy.cast("double"), dx.cast("double"))
    back = numbered.select("key", F.col("x1").alias("x"), F.col("y1").alias("y"), "id", F.lit(0).alias("out"), angle(F.col("x0") - F.col("x1"), F.col("y0") - F.col("y1")).alias("a"))
    out = numbered.select("key", F.col("x0").alias("x"), F.col("y0").alias("y"), "id", F.lit(1).alias("out"), angle(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("a"))
    ends = back.union(out).groupBy("key", "x", "y").agg(F.array_sort(F.collect_list(F.struct((-F.col("a")).alias("a"), "out", "id"))).alias("ends"))  # the edges at a vertex
    matched = ends.select(F.explode(_turns(F.col("ends"))).alias("m")).select(F.col("m.id").alias("id"), F.col("m.next").alias("next"))
    return numbered.join(matched, "id").select("key", "id", "next", "x0", "y0")


def _turns(ends: Column) -> Column:
    """Pairs (id, next) at a vertex whose ends are in clockwise order: each incoming edge takes the nearest free outgoing one after it, as brackets do."""
    empty = F.array().cast("array<struct<id:bigint,next:bigint>>")
    none = F.array().cast("array<bigint>")
    twice = F.concat(ends, ends)
    state = F.struct(none.alias("open"), none.alias("taken"), empty.alias("pairs"))

    def step(s: Column, e: Column) -> Column:
        used = F.array_contains(s["taken"], e["id"] * 2 + e["out"])
        coming = (e["out"] == 0) & ~used & ~F.array_contains(s["open"], e["id"])
        going = (e["out"] == 1) & ~used & (F.size(s["open"]) > 0)
        last = F.element_at(s["open"], -1)
        closed = F.struct(
            F.slice(s["open"], F.lit(1), F.size(s["open"]) - 1).alias("open"), F.concat(s["taken"], F.array(e["id"] * 2 + 1, last * 2)).alias("taken"),
            F.concat(s["pairs"], F.array(F.struct(last.alias("id"), e["id"].alias("next")))).alias("pairs"),
        )
        opened = F.struct(F.concat(s["open"], F.array(e["id"])).alias("open"), s["taken"].alias("taken"), s["pairs"].alias("pairs"))
        return F.when(coming, opened).when(going, closed).otherwise(s)

    return F.aggregate(twice, state, step)["pairs"]


def _named(linked: DataFrame) -> DataFrame:
    """`linked` with ring, the least id of the edges that follow each other."""
    at = written(linked.select("id", F.col("next").alias("to"), F.least("id", "next").alias("low")), "pointers")
    while True:
        ahead = at.select(F.col("id").alias("a_id"), F.col("to").alias("a_to"), F.col("low").alias("a_low"))
        moved = at.join(ahead, F.col("to") == F.col("a_id")).select("id", F.col("a_to").alias("to"), F.least("low", "a_low").alias("low"), (F.col("a_low") < F.col("low")).alias("changed"))
        moved = written(moved, "pointers")
        at = moved.drop("changed")
        if moved.filter("changed").isEmpty():
            return linked.join(at.select("id", F.col("low").alias("ring")), "id")


def _put_together(precision: float):
    def run(group: pa.Table) -> pa.Table:
        """The corners of one ring, from its least edge on, without those on a straight line."""
        ids, following = group["id"].to_numpy(), group["next"].to_numpy()
        place = dict(zip(ids.tolist(), range(len(ids))))
        order, at = [], int(ids.argmin())
        for _ in range(len(ids)):
            order.append(at)
            at = place[int(following[at])]
        x, y = group["x0"].to_numpy()[order], group["y0"].to_numpy()[order]
        dx, dy = np.diff(np.append(x, x[0])), np.diff(np.append(y, y[0]))
        # Exact: products of whole numbers of any size.
        bends = [int(a) * int(d) != int(b) * int(c) or int(a) * int(c) + int(b) * int(d) < 0 for a, b, c, d in zip(np.roll(dx, 1), np.roll(dy, 1), dx, dy)]
        x, y = x[bends].astype(float) * precision, y[bends].astype(float) * precision
        x, y = np.append(x, x[:1]), np.append(y, y[:1])
        area = float(np.sum(x[:-1] * y[1:] - x[1:] * y[:-1]) / 2)
        return pa.table({"key": group["key"].slice(0, 1), "ring": group["ring"].slice(0, 1), "xs": pa.array([x.tolist()]), "ys": pa.array([y.tolist()]), "area": pa.array([area])})

    return run


def dissolved_rings(shapes: DataFrame, key: str, hole: str | None = None, precision: float = PRECISION) -> DataFrame:
    """(key, ring, xs, ys, area): the rings of each key's dissolved shapes; holes have a negative area. Keys are text, and a null key is one of its own."""
    edges = _named(_linked(boundary(shapes, key, hole, precision)))
    return written(edges.groupBy("key", "ring").applyInArrow(_put_together(precision), RINGS), "rings")


def dissolved(shapes: DataFrame, key: str, hole: str | None = None, precision: float = PRECISION, size: float = 1.0) -> DataFrame:
    """(key, part, rings, area): a row for each part of a key's dissolved shapes, with its outer ring (xs, ys) first and its holes after it.

    A hole goes to the smallest ring of its key around it, which is found on a grid of cells of `size`.
    """
    rings = dissolved_rings(shapes, key, hole, precision)
    outer, holes = rings.filter("area > 0"), rings.filter("area < 0")
    cells = region_cells(outer.select("ring", "xs", "ys"), "ring", size)
    # The middle of an edge of a hole lies on no other ring.
    middle = lambda c: (F.get(c, F.lit(0)) + F.get(c, F.lit(1))) / 2
    marks = holes.select("key", F.col("ring").alias("hole"), middle("xs").alias("x"), middle("ys").alias("y"))
    around = in_regions(marks, "hole", cells, "ring", size).join(marks.select("hole", F.col("key").alias("h_key")), "hole")
    around = around.join(outer.select("ring", F.col("key").alias("o_key"), F.col("area").alias("o_area")), "ring").filter(F.col("h_key").eqNullSafe(F.col("o_key")))
    owner = around.groupBy("hole").agg(F.min_by("ring", F.struct("o_area", "ring")).alias("part"))
    ring = F.struct(F.lit(1).alias("hole"), F.col("ring").alias("id"), "xs", "ys", "area")
    inner = holes.join(owner, F.col("ring") == F.col("hole")).select("key", "part", ring.alias("r"))
    all_ = outer.select("key", F.col("ring").alias("part"), ring.withField("hole", F.lit(0)).alias("r")).union(inner)
    gathered = all_.groupBy("key", "part").agg(F.array_sort(F.collect_list("r")).alias("r"), F.sum("r.area").alias("area"))  # the rings of a part
    return gathered.select("key", "part", F.transform("r", lambda x: F.struct(x["xs"].alias("xs"), x["ys"].alias("ys"))).alias("rings"), "area")


def dissolved_summary(rings: DataFrame) -> DataFrame:
    """(key, area, length, outer, holes) of dissolved rings."""
    side = F.transform(F.sequence(F.lit(0), F.size("xs") - 2), lambda i: F.hypot(F.get("xs", i + 1) - F.get("xs", i), F.get("ys", i + 1) - F.get("ys", i)))
    length = F.aggregate(side, F.lit(0.0), lambda a, b: a + b)
    return rings.groupBy("key").agg(F.sum("area").alias("area"), F.sum(length).alias("length"), F.count_if(F.col("area") > 0).alias("outer"), F.count_if(F.col("area") < 0).alias("holes"))
