"""Points in polygons of any size, with holes and parts, by the cells of a grid.

A region is any number of closed rings of one id; a point is inside by the even-odd rule over all of them. Edges are laid on the cells that they pass
through. A cell keeps its own edges and whether its lower left corner is inside; cells between those with edges are either wholly
inside, and kept without edges, or wholly outside, and not kept. A point is decided from its cell alone: the way from the point to the cell's left side and down to the corner
crosses edges of this cell only, and each crossing changes sides. No task holds a whole region, and nothing compares points with rings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.spatial import gathered, paired
from stratalake.plans.storage import written

#: Edges of a cell that stand in one row come from a stretch of so many of a ring.
STRETCH = 512


def ring_edges(rings: DataFrame, *keys: str) -> DataFrame:
    """(keys, at, x0, y0, x1, y1): the edges of closed rings (xs, ys) that have a length; a ring that isn't closed is closed."""
    corners = F.arrays_zip(F.col("xs").alias("x0"), F.col("ys").alias("y0"), F.concat(F.slice("xs", 2, F.size("xs")), F.slice("xs", 1, 1)).alias("x1"), F.concat(F.slice("ys", 2, F.size("ys")), F.slice("ys", 1, 1)).alias("y1"))
    return rings.filter(F.size("xs") > 0).select(*keys, F.posexplode(corners).alias("at", "e")).select(*keys, "at", "e.*").filter("x0 <> x1 or y0 <> y1")


def _crossing_x(y: Column) -> Column:
    """Where an edge meets a level line that it crosses."""
    return F.col("x0") + (F.col("x1") - F.col("x0")) * (y - F.col("y0")) / (F.col("y1") - F.col("y0"))


def region_cells(rings: DataFrame, key: str, size: float) -> DataFrame:
    """(key, cx, cy, inside, edges, alone): the cells of the regions of `rings` (key, xs, ys); edges is null in cells that lie wholly inside.

    A cell with edges of several stretches of rings has a row for each, the first of which carries `inside`, that of its corner; the others say false. A row
    that is its region's only one in a cell is `alone`.
    """
    edges = written(ring_edges(rings.select(F.col(key).alias("id"), "xs", "ys"), "id"), "edges")
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = edges.withColumn("cy", F.explode(F.sequence(F.floor(low / size), F.floor(high / size))))
    # The part of an edge within a row of cells; rounding may add a neighbouring cell, which does no harm.
    within = lambda y: F.when(F.col("y0") == F.col("y1"), F.col("x0")).otherwise(_crossing_x(F.least(F.greatest(y, low), high)))
    ends = [within(F.col("cy") * size), within((F.col("cy") + 1) * size)]
    level = F.col("y0") == F.col("y1")
    from_x, to_x = F.when(level, F.least("x0", "x1")).otherwise(F.least(*ends)), F.when(level, F.greatest("x0", "x1")).otherwise(F.greatest(*ends))
    slack = 1e-9 * size
    laid = rows.withColumn("cx", F.explode(F.sequence(F.floor((from_x - slack) / size), F.floor((to_x + slack) / size))))
    stretches = laid.groupBy("id", "cx", "cy", F.expr(f"at div {STRETCH}").alias("stretch")).agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("edges"))
    stretches = written(stretches, "cell-edges")

    # Crossings of the line below a row of cells, by the first cell whose corner they are left of.
    line = F.col("cy") * size
    crossed = rows.filter((F.col("y0") > line) != (F.col("y1") > line)).select("id", "cy", F.ceil(_crossing_x(line) / size).alias("cx"))
    turns = crossed.groupBy("id", "cy", "cx").agg(F.count(F.lit(1)).alias("turns"))
    cells = stretches.groupBy("id", "cy", "cx").agg(F.min("stretch").alias("first"), F.count(F.lit(1)).alias("rows")).withColumn("turns", F.lit(0).cast("long"))
    row = Window.partitionBy("id", "cy")  # the columns of a region in a row of cells
    events = cells.unionByName(turns.withColumns({"first": F.lit(None).cast("long"), "rows": F.lit(0).cast("long")})).groupBy("id", "cy", "cx").agg(F.min("first").alias("first"), F.sum("rows").alias("rows"), F.sum("turns").alias("turns"))
    sides = events.withColumn("inside", F.sum("turns").over(row.orderBy("cx").rowsBetween(Window.unboundedPreceding, 0)) % 2 == 1)
    sides = written(sides.withColumn("next", F.lead("cx").over(row.orderBy("cx"))), "sides")

    corners = sides.filter("first is not null").select("id", "cx", "cy", F.col("first").alias("stretch"), "inside", (F.col("rows") == 1).alias("alone"))
    with_edges = stretches.join(corners, ["id", "cx", "cy", "stretch"], "left").select("id", "cx", "cy", F.coalesce("inside", F.lit(False)).alias("inside"), "edges", F.coalesce("alone", F.lit(False)).alias("alone"))
    # After an event there are no edges until the next one: what lies between is on one side. An event without edges is such a cell itself.
    start = F.col("cx") + F.when(F.col("first").isNull(), 0).otherwise(1)
    between = sides.filter(F.col("inside") & (start < F.col("next"))).select("id", F.explode(F.sequence(start, F.col("next") - 1)).alias("cx"), "cy")
    full = between.select("id", "cx", "cy", F.lit(True).alias("inside"), F.lit(None).cast(with_edges.schema["edges"].dataType).alias("edges"), F.lit(True).alias("alone"))
    return written(with_edges.unionByName(full).withColumnRenamed("id", key), "region-cells")


def _flips(x: Column, y: Column, left: Column, below: Column, edges: Column) -> Column:
    """How many edges the way from a point to the left side of its cell, and down to the corner, crosses."""

    def crossed(e: Column) -> Column:
        over = (e["y0"] > y) != (e["y1"] > y)
        at_x = e["x0"] + (e["x1"] - e["x0"]) * (y - e["y0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0))
        across = (e["x0"] > left) != (e["x1"] > left)
        at_y = e["y0"] + (e["y1"] - e["y0"]) * (left - e["x0"]) / F.nullif(e["x1"] - e["x0"], F.lit(0.0))
        level = F.when(over & (at_x > left) & (at_x <= x), 1).otherwise(0)
        return level + F.when(across & (at_y > below) & (at_y <= y), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda n, e: n + crossed(e))


def in_regions(points: DataFrame, point_key: str, cells: DataFrame, key: str, size: float) -> DataFrame:
    """(point_key, key): the regions, as `region_cells` of the same size, that hold each point (x, y); points without coordinates are in none."""
    fine = points.filter("x is not null and y is not null and not isnan(x) and not isnan(y)").select(F.col(point_key).alias("_p"), "x", "y")
    place = {"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)}
    flips = F.coalesce(_flips(F.col("x"), F.col("y"), F.col("cx") * size, F.col("cy") * size, F.col("edges")), F.lit(0))
    turned = (F.col("inside").cast("int") + flips).alias("n")
    named = cells.select(F.col(key).alias("_r"), "cx", "cy", "inside", "edges", "alone")
    # Cells of equal edges are decided once for all their regions and for all points of a place.
    lone = gathered(named.filter("alone").select("_r", "cx", "cy", "inside", F.array_sort("edges").alias("edges")), ["cx", "cy", "inside", "edges"], "_regions")
    met = gathered(fine, ["x", "y"], "_points").withColumns(place).join(lone, ["cx", "cy"]).select("_points", "_regions", turned).filter("n % 2 = 1")
    decided = paired(met.drop("n"), "_points", "_regions")
    sides = fine.withColumns(place).join(named.filter("not alone"), ["cx", "cy"]).select("_p", "_r", turned)
    summed = sides.groupBy("_p", "_r").agg(F.sum("n").alias("n")).filter("n % 2 = 1").drop("n")
    return decided.select("_p", "_r").unionByName(summed).select(F.col("_p").alias(point_key), F.col("_r").alias(key))
