"""Delimited tables as they are found, and archives that are never written over."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.queries import ingest
from stratalake.sources import archive, exports, readers


def table_of(spark, path, data: bytes):
    path.write_bytes(data)
    df, ragged = readers.csv_table(spark, f"file://{path}")
    return dict(df.dtypes), [tuple(r) for r in df.collect()], ragged


def test_a_preamble_units_and_an_old_encoding(spark, tmp_path):
    lines = "Report of 2019;;\n;;\nSample;Tiefe;Größe\n;(m);[mm]\nA-1;1,5;3\n001;2;4\nB;;5\nB;7\n"
    types, rows, ragged = table_of(spark, tmp_path / "a.csv", lines.encode("cp1252"))
    assert types == {"Sample": "string", "Tiefe (m)": "string", "Größe [mm]": "bigint"} and ragged == 1
    assert rows == [("A-1", "1,5", 3), ("001", "2", 4), ("B", None, 5)]
    assert table_of(spark, tmp_path / "b.csv", ("﻿" + lines).encode())[0] == types


def test_names_of_columns(spark, tmp_path):
    types, rows, ragged = table_of(spark, tmp_path / "c.csv", b"id,Name,name,\n1,a,b,0.5\n2,\"x,y\",c,1\n")
    assert types == {"id": "bigint", "Name": "string", "name_2": "string", "column_4": "double"} and ragged == 0
    assert rows == [(1, "a", "b", 0.5), (2, "x,y", "c", 1.0)]


def test_only_numbers_have_the_first_line_as_names(spark, tmp_path):
    types, rows, _ = table_of(spark, tmp_path / "d.csv", b"1,2\n3,4\n5,6\n")
    assert types == {"1": "bigint", "2": "bigint"} and rows == [(3, 4), (5, 6)]


def test_archives_are_kept(spark, tmp_path):
    path, day = f"file://{tmp_path}/a", datetime.date(2024, 5, 1)
    points = lambda n: spark.range(n).select("id", F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    first = archive.write_archive(points(10), path, "id", day)
    second = archive.write_archive(points(20), path, "id", day)
    archive.write_archive(points(30), path, "id", datetime.date(2024, 5, 2), rows=7)
    assert first != second and spark.read.parquet(first).count() == 10
    assert archive.read_latest(spark, path).count() == 30 and archive.read_latest(spark, path, day).count() == 20
    assert max(len(b) for b in archive.read_latest(spark, path).groupBy(F.input_file_name().alias("f")).agg(F.collect_list("id").alias("b")).select("b").toPandas()["b"]) <= 7
    box = archive.read_sidecar(spark, path, day).first()["columns"]["geom"]
    assert box["bbox"] == [0.0, 1.0, 19.0, 1.0] and box["geometry_types"] == ["Point"]


def test_a_file_a_document_in_few_folders(spark, tmp_path):
    body = F.when(F.col("id") % 3 == 0, " \n").when(F.col("id") % 3 == 1, F.concat(F.lit("é\n"), "id", F.lit("\n\n")))
    docs = spark.range(250).select(F.concat(F.lit("d.x-"), "id").alias("key"), body.alias("body"))
    assert exports.write_sidecars(docs, "key", "body", f"file:{tmp_path}/a", files=100) == 250
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["part=0", "part=1", "part=2"]
    found = readers.document_scan(spark, f"file://{tmp_path}/a").select("id", "body").collect()
    assert sorted(tuple(r) for r in found) == sorted((f"D.X-{i}", f"é\n{i}\n\n") for i in range(1, 250, 3))


def test_the_scan_has_no_folder_a_document(spark):
    files = ingest.sc5(spark, "/root/testdata/sf0.001").inputFiles()
    assert len(files) == spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").count() and len({f.rpartition("/")[0] for f in files}) == 1


@pytest.mark.parametrize("names", [["a", "A"], ["_a"], [".a"], ["a/b"], ["a:b"], [None], [""]])
def test_names_that_a_scan_would_lose(spark, tmp_path, names):
    with pytest.raises(PySparkException, match="no name for a file"):
        exports.write_sidecars(spark.createDataFrame([(n, "x") for n in names], "key string, body string"), "key", "body", f"file://{tmp_path}/b")


def test_ids_are_names_as_they_are(spark, tmp_path):
    names = ["a b", "é", "50%", "%41", "x=y", "{a}", "#1", "a?b", "a+b", "a.b"]
    exports.write_sidecars(spark.createDataFrame([(n, n) for n in names], "key string, body string"), "key", "body", f"file://{tmp_path}/c")
    assert sorted(tuple(r) for r in readers.document_scan(spark, f"file://{tmp_path}/c").select("id", "body").collect()) == sorted((n.upper(), n) for n in names)
