"""One JSON array in ranges of every size, against ``json.loads``; the sink's commit."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.sources import catalog, json_array

RECORDS = [
    {"handle": "a", "title": 'quote " and \\ and ],[{'}, {"handle": "b", "series": ["x, y", "[", "}"]}, {}, {"handle": "é日本 ", "title": "tab\t nl\n"},
    {"handle": "\\\\", "title": '\\"'}, {"handle": "long " * 400}, {"handle": "last", "series": []}, {"title": "\\" * 7 + '"'},
]


def rows_of(df):
    return [(r["_ord"], r["handle"], r["title"], r["series"]) for r in df.orderBy("_ord").select("_ord", "handle", "title", "series").collect()]


def wanted(records):
    return [(i, r.get("handle"), r.get("title"), r.get("series")) for i, r in enumerate(records)]


@pytest.mark.parametrize("step,indent", [(1 << 20, None), (7, None), (64, 2), (333, None)])
def test_ranges_give_what_one_reader_gives(spark, tmp_path, step, indent, monkeypatch):
    monkeypatch.setattr(json_array, "CHUNK", 50)
    text = " \n" + json.dumps(RECORDS, ensure_ascii=False, indent=indent) + "\n"
    path = str(tmp_path / "in.json")
    (tmp_path / "in.json").write_text(text)
    ranges = json_array.plan(spark, path, step)
    assert len(ranges) == -(-len(text.encode()) // step)
    fs, files = json_array.files_of(path)
    found = [(n, json.loads(v)) for r in ranges for n, v, _ in json_array.records_of(fs, files, r)]
    assert found == list(enumerate(RECORDS))
    if step != 7:
        assert rows_of(catalog.read_catalog(spark, path, range_bytes=step)) == wanted(RECORDS)


def test_empty_and_corrupt(spark, tmp_path):
    path = tmp_path / "x.json"
    for text in ("[]", " [ \n ] "):
        path.write_text(text)
        assert catalog.read_catalog(spark, str(path), range_bytes=2).count() == 0
    for text in ("", "{}", "[1", "[1]]", "[1][2]", '["a]', "[1] 2", "2 [1]", "[1],", "]1["):
        path.write_text(text)
        with pytest.raises(ValueError):
            json_array.plan(spark, str(path), 3)
        assert catalog.read_optional(spark, str(path), catalog.CATALOG).isEmpty()
    for text in ('[{"handle":"a"},]', '[,{"handle":"a"}]', '[{"handle":"a"},{"handle" "b"}]', '[{"handle":"a"},5]'):
        path.write_text(text)
        with pytest.raises((PySparkException, Py4JJavaError)):
            catalog.read_catalog(spark, str(path), range_bytes=5).collect()
        assert catalog.read_optional(spark, str(path), catalog.CATALOG).isEmpty()
    path.write_text('[{"handle":"a"}]')
    assert [r["handle"] for r in catalog.read_optional(spark, str(path), catalog.CATALOG).collect()] == ["a"]


def test_round_trip_and_a_failed_task_leaves_nothing(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).select(F.col("id").alias("_ord"), F.concat(F.lit('h"'), F.col("id").cast("string")).alias("handle"))
    out = str(tmp_path / "array")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        catalog.write_json_array(rows.orderBy(F.desc("_ord")), out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "array").glob("part-*"))) > 5 and not list(tmp_path.glob("*.tmp"))
    assert [(r["_ord"], r["handle"]) for r in catalog.read_catalog(spark, out, range_bytes=1000).select("_ord", "handle").orderBy("_ord").collect()] == [(i, f'h"{i}') for i in range(1000)]
    fails = rows.withColumn("handle", F.when(F.col("_ord") == 900, F.raise_error(F.lit("no"))).otherwise(F.col("handle")))
    with pytest.raises((PySparkException, Py4JJavaError)):
        catalog.write_json_array(fails, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists() and not list(tmp_path.glob("*.tmp"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        catalog.write_json_array(rows, out)
    assert catalog.read_catalog(spark, out).count() == 1000
