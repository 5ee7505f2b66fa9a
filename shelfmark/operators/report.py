"""Coverage, verdicts, audits and change counts: one pass of conditional counts each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfmark.functions import text as X
from shelfmark.operators import predicates


def coverage(rows: DataFrame, priceable: Column, priced: Column, linked: Column, approx: Column, upc: Column, number: Column) -> DataFrame:
    """Counts and percentages of what is priced, linked and identified."""
    f = {k: F.coalesce(c, F.lit(False)) for k, c in {"priceable": priceable, "priced": priced, "linked": linked, "approx": approx, "upc": upc, "number": number}.items()}
    un = f["priceable"] & ~f["priced"]
    counted = rows.agg(
        F.count("*").alias("total"), *(F.count_if(f[k]).alias(k) for k in ("priceable", "linked")), F.count_if(f["priceable"] & f["priced"]).alias("priced"), F.count_if(f["priced"] & f["approx"]).alias("approx"),
        F.count_if(un).alias("unpriced"), F.count_if(un & f["upc"]).alias("unpriced_upc"), F.count_if(un & f["number"]).alias("unpriced_number"), F.count_if(un & f["upc"] & f["number"]).alias("unpriced_both"),
        F.count_if(un & ~f["upc"] & ~f["number"]).alias("unpriced_neither"), F.count_if(un & f["linked"]).alias("unpriced_linked"), F.count_if(f["priceable"] & f["priced"] & ~f["upc"]).alias("priced_no_upc"),
    )
    return counted.withColumns({"priced_pct": X.pct(F.col("priced"), F.col("priceable")), "neither_pct": X.pct(F.col("unpriced_neither"), F.col("unpriced"))})


def catalog_coverage(catalog: DataFrame) -> DataFrame:
    c = F.col
    return coverage(
        catalog, X.trim(X.blank(c("title"))) != "", predicates.has_price(c("marketValueLoose"), c("marketValueComplete"), c("marketValueNew")), X.truthy(c("pricechartingId")) | X.truthy(c("pricechartingUrl")),
        c("marketValueIsApproximate"), X.usable_upc(c("upc")), X.number_of(c("funkoNumber"), c("title"), c("funkoNumberFromTitle")) != "",
    )


def verdict(cov: DataFrame) -> DataFrame:
    """What the shares of a coverage row suggest, as an ordered list of messages."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    rules = F.array_compact(
        F.array(
            F.when(share("unpriced_upc", "unpriced") >= 0.30, "many unpriced rows have a code: search by code"),
            F.when(share("unpriced_neither", "unpriced") >= 0.40, "many unpriced rows have no identifier: fill identifiers first"),
            F.when(share("unpriced_linked", "unpriced") >= 0.15, "many unpriced rows are linked: fetch their prices again"),
            F.when(share("unpriced_number", "unpriced") >= 0.50, "most unpriced rows have a number: search by title and number"),
        )
    )
    return cov.select(F.when(F.col("unpriced") == 0, F.array(F.lit("every row is priced"))).when(F.size(rules) > 0, rules).otherwise(F.array(F.lit("no single cause"))).alias("messages"))


def audit(catalog: DataFrame, discovered: Column) -> DataFrame:
    priced = predicates.has_price(F.col("marketValueLoose"), F.col("marketValueComplete"), F.col("marketValueNew"))
    upc = X.truthy(F.col("upc"))
    return catalog.agg(F.count("*").alias("total"), F.count_if(priced).alias("priced"), F.count_if(upc).alias("upc"), F.count_if(priced & ~upc).alias("priced_no_upc"), F.count_if(discovered).alias("discovered"), F.count_if(discovered & upc).alias("discovered_upc"))


def samples(rows: DataFrame, n: int = 8, width: int = 60) -> DataFrame:
    return rows.orderBy("_ord").limit(n).select("_ord", F.substring(X.blank(F.col("title")), 1, width).alias("title"))


def changes(before: DataFrame, after: DataFrame, fields: list[str], key: str = "_ord") -> DataFrame:
    """Number of rows in which each field, and any field, changed; nulls compare equal."""
    joined = before.alias("b").join(after.alias("a"), F.col(f"b.{key}") == F.col(f"a.{key}"))
    differ = {f: ~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")) for f in fields}
    some = F.lit(False)
    for d in differ.values():
        some = some | d
    return joined.agg(*(F.count_if(d).alias(f) for f, d in differ.items()), F.count_if(some).alias("any_field"))


def observed(rows: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """A pass's counters, counted while its rows are written."""
    seen = Observation(name)
    return rows.observe(seen, F.count("*").alias("rows"), *(F.count_if(c).alias(k) for k, c in counters.items())), seen


def converged(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whether a further run left the number of rows, prices and codes as they were."""
    keys = ["total", "priced", "upc"]
    a, b = before.select(F.struct(*keys).alias("x"), F.lit(1).alias("k")), after.select(F.struct(*keys).alias("y"), F.lit(1).alias("k"))
    return a.join(b, "k").select((F.col("x") == F.col("y")).alias("converged"))
