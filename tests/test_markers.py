from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelfmark.streaming import markers


def test_markers_over_a_restart(spark, tmp_path):
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    src, out, check = (str(tmp_path / k) for k in ("src", "out", "chk"))

    def land(rows):
        spark.createDataFrame(rows, markers.LOG).coalesce(1).write.mode("append").parquet(src)
        markers.run_markers(spark, src, out, check, days=10).awaitTermination(120)

    land([("a", day(0), "found"), ("b", day(1), "error"), ("c", day(2), "none"), (None, day(2), "found"), ("d", None, "found"), ("a", day(0), "found")])
    land([("b", day(5), "found"), ("c", day(6), "found"), ("e", day(12), "error")])
    land([("a", day(13), "found"), ("x", day(13), "lost")])
    land([("z", day(15), "error")])
    got = {(r["key"], r["event"], r["at"]) for r in spark.read.parquet(out).collect()}
    assert got == {("a", "finished", day(0)), ("c", "finished", day(2)), ("b", "finished", day(5)), ("c", "finished", day(6)), ("a", "due", day(10)), ("a", "finished", day(13)), ("b", "due", day(15))}
    log = spark.read.parquet(src)
    assert {(r["key"], r["done_at"], r["due"]) for r in markers.now_due(log, 10).collect()} == {("a", day(13), False), ("b", day(5), True), ("c", day(6), False), ("e", None, True), ("z", None, True)}


def test_many_sets_cost_few_calls_of_the_worker(spark, tmp_path):
    """Sets of one block run out one after the other, some of them moved on before; the state has a row a block, not a set."""
    n, start = 20_000, datetime(2024, 1, 1)
    src, out, check = (str(tmp_path / k) for k in ("src", "out", "chk"))
    at = lambda day: (F.lit(start).cast("timestamp") + F.make_dt_interval(day)).alias("at")
    first = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), at(F.col("id").cast("int") % 20), F.lit("found").alias("status"))
    again = spark.range(0, n, 7).select(F.concat(F.lit("k"), "id").alias("key"), at(F.lit(25)), F.lit("none").alias("status"))
    for rows in (first, again, spark.createDataFrame([("z", start + timedelta(days=29), "error")], markers.LOG)):
        rows.write.mode("append").parquet(src)
        markers.run_markers(spark, src, out, check, days=10).awaitTermination(120)
    events = spark.read.parquet(out).groupBy("key").agg(F.max(F.when(F.col("event") == "finished", F.col("at"))).alias("f"), F.max(F.when(F.col("event") == "due", F.col("at"))).alias("d"))
    got = {r["key"]: (r["f"], r["d"] is not None and r["d"] > r["f"]) for r in events.collect()}
    assert got == {r["key"]: (r["done_at"], r["due"]) for r in markers.now_due(spark.read.parquet(src), 10).collect() if r["done_at"]}
    assert spark.read.format("statestore").option("stateVarName", "block").load(check).count() <= markers.BLOCKS
