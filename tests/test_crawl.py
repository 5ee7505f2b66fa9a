from datetime import datetime, timedelta

from shelfmark.operators import crawl
from shelfmark.plans import page_queries

PAGES = "set_key string, page int, _ord int, rows int, declared int, ended boolean"


def test_crawl_end(spark):
    rows = [("total", 1, 1, 10, 25, False), ("total", 2, 1, 10, 99, False), ("total", 3, 1, 5, -1, False), ("total", 4, 1, 5, -1, False)]
    rows += [("empty", i, 1, None if i == 3 else 0, -1, False) for i in (1, 2, 3, 4)]
    rows += [("end", 1, 1, 4, -1, False), ("end", 2, 1, None, -1, True), ("reset", 1, 1, 0, 0, False), ("reset", 2, 1, 0, -1, False), ("reset", 3, 1, 1, -1, True), ("reset", 4, 1, 0, -1, False)]
    rows += [("gap", 1, 1, 3, -1, False), ("gap", 3, 1, None, -1, True), ("late", 2, 1, 3, -1, False), ("twice", 1, 1, None, -1, True), ("twice", 1, 2, 3, -1, False)]
    rows += [("long", i, 1, 1, -1, False) for i in range(1, 520)]
    got = {r["set_key"]: tuple(r)[1:] for r in crawl.crawl_end(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {
        "total": (3, 25, 25, "total", None), "empty": (3, 0, None, "empty", None), "end": (2, 4, None, "end", None), "reset": (4, 1, 0, "open", 5),
        "gap": (1, 3, None, "open", 2), "late": (0, 0, None, "open", 1), "twice": (1, 3, None, "open", 2), "long": (500, 500, None, "ceiling", None),
    }
    limited = {r["set_key"]: (r["last_page"], r["reason"]) for r in crawl.crawl_end(spark.createDataFrame(rows, PAGES), max_pages=2).collect()}
    assert limited["total"] == (2, "limit") and limited["end"] == (2, "end") and limited["gap"] == (1, "open")
    assert crawl.crawl_end(spark.createDataFrame([], PAGES)).count() == 0


def test_attempts(spark):
    at = datetime(2024, 1, 1)
    log = lambda a, *statuses: [(a, i, at + timedelta(minutes=i), s, f"{a}{i}") for i, s in enumerate(statuses)]
    rows = log("a", 200) + log("b", 429, None, 404, 200) + log("c", 500) + log("d", None, 503) + log("e", 500, 500, 500, 200) + log("f", 500, 500, None) + log("g", 301, None)
    df = spark.createDataFrame(rows, "address string, _ord int, at timestamp, status int, page string")
    got = {r["address"]: tuple(r)[1:] for r in crawl.attempts(df).collect()}
    assert got == {
        "a": ("accepted", 1, 200, "a0", None), "b": ("accepted", 3, 404, "b2", None), "c": ("waiting", 1, 500, None, at + timedelta(seconds=2)),
        "d": ("waiting", 2, 503, None, at + timedelta(minutes=1, seconds=4)), "e": ("refused", 3, 500, None, None), "f": ("failed", 3, None, None, None), "g": ("accepted", 1, 301, "g0", None),
    }
    assert "WindowGroupLimit" in crawl.attempts(df)._jdf.queryExecution().toString()


def test_attempts_query_takes_tied_lines_in_one_order(spark, tmp_path):
    lines = [(1, 2, 1, datetime(1995, 1, 1)), (1, 2, 1, datetime(1996, 1, 1)), (2, 3, 1, datetime(1997, 1, 1)), (2, 3, 1, datetime(1994, 1, 1))]
    for name, rows in (("a", lines), ("b", lines[::-1])):
        spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp").coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        got = sorted((r["address"], r["outcome"], r["due"]) for r in page_queries.q_attempts(spark, f"{tmp_path}/{name}").collect())
        assert got == [(1, "waiting", "1996-01-01 00:00:04"), (2, "waiting", "1997-01-01 00:00:04")]
