"""The review log, and units near a point."""

import math
import random

from stratalake.operators import reviews, spatial


def test_log_filters_and_history(spark):
    rows = [
        (1, ["a", "b"], "review", "item", "open", None, None, 5), (2, ["b"], "published", "row", "open", ["r1", "r2"], None, 6), (3, ["b"], "review", "row", "resolved", ["r2"], None, 6),
        (4, ["c"], "review", "column", "open", None, "age", 1), (5, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, item_ids array<string>, generation string, target_kind string, status string, row_key_vals array<string>, column_name string, made int")
    promoted = spark.createDataFrame([("a",), ("a",), ("b",)], "item string")
    log = lambda **k: [(r["id"], r["read_only"]) for r in reviews.review_log(df, promoted, **k).collect()]
    assert log() == [(2, False), (3, True), (1, True), (4, False), (5, False)]  # a comment without a date is the oldest
    assert log(item="b") == [(2, False), (3, True), (1, True)] and log(item="b", limit=1) == [(2, False)]
    assert log(row_value="r2", kind="row") == [(2, False), (3, True)] and log(row_value="r2", status="open") == [(2, False)]
    assert log(column="age", generation="review") == [(4, False)] and log(item="nowhere") == []


def test_other_units_within_the_tolerance_of_the_most_detailed_map(spark):
    r = random.Random(5)
    boxes = [(r.choice("ABC") if i % 9 else None, r.choice([24000, 100000, 500000, None]), i, x, y, x + r.random() / 100, y + r.random() / 100) for i in range(150) for x, y in [(r.random() / 20, 39 + r.random() / 20)]]
    points = [(i, r.random() / 20, 39 + r.random() / 20) for i in range(120)]
    got = spatial.near_contacts(spark.createDataFrame(points, "id int, x double, y double"), "id", spark.createDataFrame(boxes, "unit string, scale int, feature int, xmin double, ymin double, xmax double, ymax double"), 0.02)
    hit = lambda x, y: [b for b in boxes if b[0] and b[3] <= x <= b[5] and b[4] <= y <= b[6]]
    want = {}
    for i, x, y in points:
        found = sorted(hit(x, y), key=lambda b: (b[1] is None, b[1] or 0, b[2]))
        if found:
            own, scale = found[0][:2]
            up = (scale or 0) * 0.0005 / 111320
            turns = [k * math.pi / 4 for k in range(8)] if scale else []
            others = {b[0] for t in turns for b in hit(x + up / math.cos(math.radians(y)) * math.cos(t), y + up * math.sin(t))} - {own}
            want[i] = (own, scale, min(others, default=None))
    assert {r["id"]: (r["unit"], r["scale"], r["other"]) for r in got.collect()} == want
    assert len({v[2] for v in want.values()}) > 2 and None in {v[1] for v in want.values()}
