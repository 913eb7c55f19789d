"""Sorting, ranking and choosing of search results."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators import results


def test_undated_rows_are_last_both_ways(spark):
    rows = [(1, "b", None, None), (2, "A", "2001-01-01", None), (3, None, "1999-01-01", "2020-01-01"), (4, "a", None, "2019-01-01"), (5, " ", None, "2018-01-01")]
    df = spark.createDataFrame(rows, "rank int, title string, published string, loaded string")
    order = lambda sort: [r["rank"] for r in results.sorted_results(df, sort, 9).collect()]
    assert order("newest") == [2, 3, 4, 5, 1] and order("oldest") == [3, 2, 5, 4, 1]
    assert order("title") == [2, 4, 1, 3, 5] and order("relevance") == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        results.sort_order("best")


def test_scores_of_footprints(spark):
    rows = [("whole", 0.0, 0.0, 2.0, 2.0), ("half", 1.0, 0.0, 3.0, 2.0), ("point", 1.0, 1.0, 1.0, 1.0), ("apart", 3.0, 0.0, 4.0, 1.0), ("null", None, 0.0, 1.0, 1.0), ("turned", 2.0, 0.0, 0.0, 2.0), ("large", -1.0, -1.0, 3.0, 3.0)]
    df = spark.createDataFrame(rows, "id string, xmin double, ymin double, xmax double, ymax double")
    got = {r[0]: r[1] for r in df.select("id", results.overlap_score((0, 0, 2, 2))).collect()}
    assert got == pytest.approx({"whole": 1.0, "half": 0.25 * 0.5 + 0.75 * 0.5, "point": 0.75, "apart": 0.0, "null": 0.0, "turned": 0.0, "large": 0.25 + 0.75 * 0.25})
    assert [r["id"] for r in results.by_overlap(df.filter("id <> 'turned'"), (0, 0, 2, 2), "id", 3).collect()] == ["whole", "point", "half"]
    assert {r["id"] for r in results.drawable(df, (0, 0, 1, 1)).collect()} == {"whole", "half", "point", "apart", "turned"}
    assert "large" not in {r["id"] for r in results.drawable(df).collect()}
    with pytest.raises(ValueError):
        results.overlap_score((0, 0, 0, 1))


def test_most_detailed_takes_unknown_scales_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 24000, 3), ("a", 24000, 2), ("b", None, 5), ("b", None, 4), (None, 1, 6)], "g string, scale int, k int")
    assert sorted((str(r["g"]), r["k"]) for r in results.most_detailed(df, ["g"], "scale", "k").collect()) == [("None", 6), ("a", 2), ("b", 4)]
    assert results.most_detailed(df.filter(F.lit(False)), ["g"], "scale", "k").count() == 0
