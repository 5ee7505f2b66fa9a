"""Mixing sources to target weights by systematic sampling.

Method. A source that should supply ``target`` of its ``source_size`` words gives every document the
expected copies ``r = target / source_size``. Documents of a source stand in the order of their size;
the prefix sums of expected copies, shifted by one random offset of the source, cross an integer
boundary ``copies`` times within each document, and it is emitted so often. Since neighbours in that
order have like sizes, the words taken differ from the target by about the largest document.

The prefix sum is ``r`` times the rank, so only ranks are needed: counts of cells (source, size,
bucket) are summed up first, and rows are numbered within a cell only. No task holds a source, nor
all documents of one size. Ranks and rates are integers (24 fraction bits), so reruns agree and a
rate of 3 gives exactly 3 copies.

Cases. Null and empty texts have size 0 and take part in the ranks without words to take. A null
source is a source of its own, sorted last. Repeated rows are separate rows. Sources without words
have target 0. An empty table gives an empty result. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import BLANK_WORD, table
from shelfmark.llm.positions import FILE, ROW, placed, repeated
from shelfmark.session import stash

ONE = 1 << 24
CYCLE = 3
CAP = 3


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def _bucket(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 2), 16, 10).cast("int")


def source_targets(per_source: DataFrame) -> DataFrame:
    """``(source, source_size)`` to ``+ weight, target``: one row a source, so windows over all of them are small.

    Capacity is filled in the order of capacity over weight: the first source that its share does not
    exceed ends the reshaping, and all later ones share what is left by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    t = per_source.withColumn("weight", ((F.row_number().over(by_name) - 1) % CYCLE + 1).cast("long")).withColumn("cap", F.col("source_size") * CAP)
    all_rows = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = all_rows.rowsBetween(Window.unboundedPreceding, -1), all_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    t = t.withColumn("share", F.col("left").cast("double") / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    t = t.withColumn("k", F.row_number().over(all_rows)).withColumn("fits", F.col("share") * F.col("weight") <= F.col("cap"))
    t = t.withColumn("stop", F.min(F.when(F.col("fits"), F.struct("k", "share"))).over(whole))
    target = F.when(F.col("k") < F.col("stop.k"), F.col("cap").cast("double")).otherwise(F.col("stop.share") * F.col("weight"))
    return t.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def allot(rows: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """Add ``source_size, target, copies`` to rows that have ``doc_id, source, size``.

    ``tie`` names columns that order rows of one id and size, where rows carry more than these.
    """
    rows = rows.withColumn("_mx_bucket", _bucket(F.col("doc_id")))
    key = ["_mx_source", "_mx_size", "_mx_bucket"]
    # null is no join key: "n" for null, "s" before any name
    rows = rows.withColumn("_mx_source", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))).withColumn("_mx_size", F.col("size"))
    cells = stash(rows.groupBy(*key).agg(F.count("*").alias("n"), F.min("source").alias("source")), "cells")
    ahead = Window.unboundedPreceding
    cells = cells.withColumn("in_size", F.coalesce(F.sum("n").over(Window.partitionBy("_mx_source", "_mx_size").orderBy("_mx_bucket").rowsBetween(ahead, -1)), F.lit(0)))
    sizes = cells.groupBy("_mx_source", "_mx_size").agg(F.sum("n").alias("n"))
    sizes = sizes.withColumn("in_source", F.coalesce(F.sum("n").over(Window.partitionBy("_mx_source").orderBy("_mx_size").rowsBetween(ahead, -1)), F.lit(0))).drop("n")
    targets = source_targets(cells.groupBy("_mx_source").agg(F.min("source").alias("source"), F.sum(F.col("n") * F.col("_mx_size")).alias("source_size")))
    offset = F.conv(F.substring(F.md5(F.col("_mx_source").cast("binary")), 1, 6), 16, 10).cast("long")
    targets = targets.withColumn("_mx_source", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))).drop("source", "weight")
    targets = targets.withColumn("_mx_rate", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * ONE)).otherwise(0)).withColumn("_mx_offset", offset)
    placed = cells.join(sizes, ["_mx_source", "_mx_size"]).join(targets, "_mx_source")
    placed = placed.select(*key, (F.col("in_source") + F.col("in_size")).alias("_mx_base"), "source_size", "target", "_mx_rate", "_mx_offset")
    rows = rows.withColumn("_mx_nr", F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", *tie)))
    rows = rows.join(placed, key)
    upto = (F.col("_mx_base") + F.col("_mx_nr")) * F.col("_mx_rate") + F.col("_mx_offset")
    copies = (F.shiftright(upto, 24) - F.shiftright(upto - F.col("_mx_rate"), 24)).cast("int")
    return rows.withColumn("copies", copies).drop(*key, "_mx_nr", "_mx_base", "_mx_rate", "_mx_offset")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, in its own columns.

    Rows are ranked without their texts; the number of copies finds its row by place.
    """
    rows = placed(docs)
    kept = stash(rows.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("_mx_tie"), FILE, ROW), "sizes")
    taken = allot(kept, ("_mx_tie", FILE, ROW)).filter("copies > 0")
    return repeated(rows, taken.select(FILE, ROW, F.col("copies").alias("n")), 0)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = stash(table(spark, sf_dir, "documents").select("doc_id", "source", size_of(F.col("text")).alias("size")), "sizes")
    return allot(sizes).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2))::BIGINT AS bucket
  FROM documents),
s AS (SELECT k, min(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY k),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM s),
f AS (SELECT *, row_number() OVER o AS nr,
        (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS share
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
g AS (SELECT arg_min(share, nr) AS share, min(nr) AS nr FROM f WHERE share * weight <= cap),
t AS (SELECT f.k, f.source_size, CASE WHEN f.nr < g.nr THEN f.cap::DOUBLE ELSE coalesce(g.share * f.weight, 0) END AS target FROM f, g),
r AS (SELECT t.*, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS rate,
        ('0x' || substr(md5(k), 1, 6))::BIGINT AS u FROM t),
n AS (SELECT d.*, row_number() OVER (PARTITION BY k ORDER BY size, bucket, doc_id) AS nr FROM d)
SELECT doc_id, size, source_size, target,
       (((nr * rate + u) >> 24) - (((nr - 1) * rate + u) >> 24)) * size AS taken,
       (((nr * rate + u) >> 24) - (((nr - 1) * rate + u) >> 24))::INTEGER AS copies
FROM n JOIN r USING (k)
"""
