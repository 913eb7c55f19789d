"""Regions by cells, and dissolving, against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import dissolve, regions


def star(n, r0, r1, cx, cy, turn=0.1):
    p = [(cx + (r0 if i % 2 else r1) * math.cos(turn + 2 * math.pi * i / n), cy + (r0 if i % 2 else r1) * math.sin(turn + 2 * math.pi * i / n)) for i in range(n)]
    return [a for a, _ in [*p, p[0]]], [b for _, b in [*p, p[0]]]


def odd_crossings(x, y, rings) -> bool:
    return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for xs, ys in rings for a, b, c, d in zip(xs, ys, xs[1:], ys[1:])) % 2 == 1


@pytest.mark.parametrize("size", [0.3, 2.5, 50.0])
def test_points_in_regions(spark, size):
    """Stars with a hole, of two parts, and a triangle with points on its corners and edges."""
    rng = random.Random(3)
    rings = [(1, *star(40, 3, 8, 0, 0)), (1, *star(12, 1, 2, 0, 0)), (2, *star(3000, 5, 5.5, 4, 4)), (2, *star(8, 1, 2, 20, 20)), (3, [0.0, 4.0, 4.0, 0.0, 0.0], [0.0, 0.0, 4.0, 4.0, 0.0]), (4, [], [])]
    points = [(i, rng.uniform(-10, 24), rng.uniform(-10, 24)) for i in range(3000)] + [(5000 + i, float(i % 6), float(i // 6)) for i in range(36)]
    want = {(i, k) for i, x, y in points for k in (1, 2, 3) if odd_crossings(x, y, [r[1:] for r in rings if r[0] == k])}
    cells = regions.region_cells(spark.createDataFrame(rings, "id int, xs array<double>, ys array<double>"), "id", size)
    asked = spark.createDataFrame([*points, (9999, None, 1.0), (9998, float("nan"), 1.0)], "p int, x double, y double")
    assert {tuple(r) for r in regions.in_regions(asked, "p", cells, "id", size).collect()} == want and len(want) > 500


def test_a_region_of_very_many_corners(spark):
    n = 400_000
    turn = lambda f: F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: (5 + i % 2 * 0.5) * f(i % n * (2 * math.pi / n)))
    ring = spark.range(1).select("id", turn(F.cos).alias("xs"), turn(F.sin).alias("ys"))
    cells = regions.region_cells(ring, "id", 0.05)
    assert cells.agg(F.max(F.size("edges"))).first()[0] <= 2 * regions.STRETCH
    points = [(i, i * 0.11 % 12 - 6, i * 0.07 % 12 - 6) for i in range(3000)]
    found = {r["p"] for r in regions.in_regions(spark.createDataFrame(points, "p long, x double, y double"), "p", cells, "id", 0.05).collect()}
    sure = lambda low, high: {i for i, x, y in points if low <= math.hypot(x, y) <= high}
    assert sure(0, 4.99) <= found and not sure(5.51, 99) & found


def squares(cells):
    return [(k, [float(x), x + 1.0, x + 1.0, float(x), float(x)][:: 1 if (x + y) % 2 else -1], [float(y), float(y), y + 1.0, y + 1.0, float(y)][:: 1 if (x + y) % 2 else -1]) for k, c in cells.items() for x, y in sorted(c)]


def test_dissolved_squares(spark):
    rng = random.Random(3)
    cells = {k: {(rng.randrange(14), rng.randrange(12)) for _ in range(90)} for k in "ab"}
    cells["d"] = {(x, y) for x in range(7) for y in range(7)} - {(x, y) for x in range(1, 6) for y in range(1, 6)} | {(3, 3)}
    df = spark.createDataFrame(squares(cells), "k string, xs array<double>, ys array<double>")
    got = {r["key"]: r for r in dissolve.dissolved_summary(dissolve.dissolved_rings(df, "k")).collect()}
    for k, c in cells.items():
        pairs = sum(((x + 1, y) in c) + ((x, y + 1) in c) for x, y in c)
        blocks = sum(all(p in c for p in ((x + 1, y), (x, y + 1), (x + 1, y + 1))) for x, y in c)
        assert (got[k]["area"], got[k]["length"], got[k]["outer"] - got[k]["holes"]) == (len(c), 4 * len(c) - 2 * pairs, len(c) - pairs + blocks)
    # A ring around a hole that has an island: two parts, the hole with the outer one.
    parts = sorted((r["area"], len(r["rings"])) for r in dissolve.dissolved(df, "k", size=2.0).filter("key = 'd'").collect())
    assert parts == [(1.0, 1), (24.0, 2)]


def test_dissolved_shapes_with_holes(spark):
    """A frame and what fills it become one ring; corners on straight lines go; a null key is one of its own."""
    square = lambda a, b: ([a, b, b, a, a], [a, a, b, b, a])
    rows = [("k", *square(0.0, 9.0), False), ("k", *square(3.0, 6.0), True), ("k", *square(3.0, 6.0), False), (None, *square(0.0, 2.0), False), ("e", [], [], False)]
    df = spark.createDataFrame(rows, "k string, xs array<double>, ys array<double>, hole boolean")
    got = {r["key"]: r for r in dissolve.dissolved_rings(df, "k", "hole").collect()}
    assert set(got) == {"k", None} and got["k"]["area"] == 81 and len(got["k"]["xs"]) == 5 and got[None]["area"] == 4
    frame = dissolve.dissolved(df.filter("not (k = 'k' and not hole and xs[0] = 3)"), "k", "hole").filter("key = 'k'").collect()
    assert [(r["area"], len(r["rings"])) for r in frame] == [(72.0, 2)]
