"""Selecting only what still needs work, and knowing when a set is complete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import text as X


def stale(checked_at: Column, now: Column, days: int) -> Column:
    """Checked more than ``days`` days ago, never, or at no valid time; 0 days: never stale."""
    if days <= 0:
        return F.lit(False)
    at = F.try_to_timestamp(checked_at)
    return F.coalesce(at < now - F.expr(f"make_dt_interval({days})"), F.lit(True))


def first_n(rows: DataFrame, n: int | None) -> DataFrame:
    return rows if n is None else rows.orderBy("_ord").limit(n)


def price_candidates(rows: DataFrame, priced: Column, upc: Column, checked_at: Column, now: Column, fill_upc: bool = True, days: int = 0, limit: int | None = None) -> DataFrame:
    """Rows without a price, without a code (white space is none) if codes are to be filled, or with a stale price."""
    need = ~priced | (F.lit(fill_upc) & ~X.truthy(X.trim(X.blank(upc)))) | stale(checked_at, now, days)
    return first_n(rows.filter(need), limit)


def reference_candidates(rows: DataFrame, mode: str = "default", limit: int | None = None) -> DataFrame:
    """Rows to look up: ``all``, those looked up without an id or without tags, or those not looked up yet."""
    c = F.col
    checked = F.coalesce(c("hdbChecked"), F.lit(False))
    wanted = {
        "all": F.lit(True), "no_refs": checked & ~X.truthy(c("hdbid")), "no_series": checked & (F.coalesce(F.size("series"), F.lit(0)) <= 0),
        "default": ~X.truthy(c("hdbid")) & ~checked,
    }[mode]
    return first_n(rows.filter(X.truthy(c("handle")) & ~X.blank(c("handle")).endswith(".html") & wanted), limit)


def franchise_candidates(rows: DataFrame, limit: int | None = None) -> DataFrame:
    c = F.col
    return first_n(rows.filter(~X.truthy(c("franchise")) & ~F.coalesce(c("franchiseChecked"), F.lit(False)) & X.truthy(c("productUrl"))), limit)


def complete_sets(rows: DataFrame, targets: DataFrame, key: str, tolerance: int = 5) -> DataFrame:
    """``(key, rows, target, done)``: not failed, some rows, and near the declared number if one is declared."""
    counts = rows.groupBy(key).agg(F.count("*").alias("rows"))
    t = targets.join(counts, key, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    enough = F.when(F.col("target") > 0, F.col("rows") >= F.col("target") - tolerance).otherwise(True)
    return t.select(key, "rows", "target", (~F.coalesce("failed", F.lit(False)) & (F.col("rows") > 0) & enough).alias("done"))


def unfinished(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def mark_checked(rows: DataFrame, outcomes: DataFrame, field: str) -> DataFrame:
    """Set ``field`` where the outcome was clean; errors are left for the next run."""
    clean = outcomes.filter("status <> 'error'").select("_ord", F.lit(True).alias("_clean")).distinct()
    return rows.join(clean, "_ord", "left").withColumn(field, F.when(F.col("_clean"), True).otherwise(F.col(field))).drop("_clean")


def narrowing(facets: DataFrame, total: Column) -> DataFrame:
    """Facets that narrow a listing: a count of at least 0 and under the whole."""
    return facets.filter((F.col("count") >= 0) & (F.col("count") < total))


def first_per(rows: DataFrame, key: str, n: int, order: str = "_ord") -> DataFrame:
    """The first ``n`` rows of each ``key``; 0: all. Spark keeps ``n`` rows of a key a task before it shuffles."""
    if not n:
        return rows
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter(F.col("_rn") <= n).drop("_rn")
