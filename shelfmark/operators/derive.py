"""Grouping fields, provenance and facet tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.functions import text as X
from shelfmark.operators import merge, predicates
from shelfmark.session import stash
from shelfmark.sources import html


def tag_frequency(rows: DataFrame, tags: str = "series") -> DataFrame:
    """``(tag, freq)``: every occurrence counts, repeats within a row too."""
    return rows.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("freq"))


def rarest_tag(rows: DataFrame, key: str, tags: str = "series", usable=predicates.is_named_set_tag) -> DataFrame:
    """``(key, set_tag)``: each row's rarest usable tag, the earlier one in a tie."""
    # the rule is asked of each distinct tag, not of each occurrence
    # and stored: where the tags are few, their size is then known, they are broadcast, and no row is shuffled by its tag
    freq = stash(tag_frequency(rows, tags).filter(usable(F.col("tag"))), "tags")
    placed = rows.select(key, F.posexplode(tags).alias("pos", "tag"))
    return placed.join(freq, "tag").groupBy(key).agg(F.min_by("tag", F.struct("freq", "pos")).alias("set_tag"))


def grouping(catalog: DataFrame) -> DataFrame:
    """Set ``setTag``, ``franchiseSuggestion``, ``category`` where there is something to set, and seed empty series."""
    tags = rarest_tag(catalog, "_ord").withColumnsRenamed({"_ord": "_o", "set_tag": "_tag"})
    suggestion = F.coalesce(F.nullif(X.franchise_from_series(F.col("pcSeries")), F.lit("")), F.nullif(X.franchise_from_url(F.col("pricechartingUrl")), F.lit("")))
    category = F.nullif(X.category_of(F.col("console"), F.col("pricechartingUrl")), F.lit(""))
    out = catalog.join(tags, F.col("_ord") == F.col("_o"), "left")
    had = X.truthy(F.col("category"))
    seeded = F.when(~had & category.isNotNull() & (F.coalesce(F.size("series"), F.lit(0)) <= 0), F.array(category)).otherwise(F.col("series"))
    out = out.withColumns({"setTag": F.coalesce("_tag", "setTag"), "franchiseSuggestion": F.coalesce(suggestion, "franchiseSuggestion"), "series": seeded, "category": F.when(had, F.col("category")).otherwise(F.coalesce(category, "category"))})
    return out.select(*catalog.columns)


def shop_details(catalog: DataFrame, trails: DataFrame) -> DataFrame:
    """Section and franchise from the trails of shop pages, ``trails(_ord, crumbs)``; null crumbs: the page had none.

    A row whose page was read is marked, so that it is not read again; rows without a trail wait. Empty
    series are seeded with the franchise.
    """
    found = html.franchise_of(F.col("crumbs"))
    t = trails.select(F.col("_ord").alias("_o"), F.nullif(found["franchise"], F.lit("")).alias("_f"), X.blank(found["section"]).alias("_s"))
    out = catalog.join(t, F.col("_ord") == F.col("_o"), "left")
    seeded = F.when(F.col("_f").isNotNull(), merge.fill_if_empty(F.col("series"), F.array(F.lit("Pop! Vinyl"), F.col("_f")))).otherwise(F.col("series"))
    fields = {
        "series": seeded, "franchise": F.coalesce("_f", "franchise"), "funkoSection": F.when(F.col("_f").isNotNull(), F.col("_s")).otherwise(F.col("funkoSection")),
        "franchiseChecked": F.when(F.col("_o").isNotNull(), True).otherwise(F.col("franchiseChecked")),
    }
    return out.withColumns(fields).select(*catalog.columns)


def price_source(stored: Column, loose: Column, complete: Column, new: Column) -> Column:
    """Where a price is from; what a priced row says already stays."""
    priced = predicates.has_price(loose, complete, new)
    return F.when(priced, F.when(X.truthy(stored), stored).otherwise(V.PRICED_SOURCE)).otherwise("none")


def restamp(stored: Column, loose: Column, complete: Column, new: Column) -> Column:
    """As price_source, and a priced row that says "none" is put right."""
    priced = predicates.has_price(loose, complete, new)
    return F.when(priced, F.when(X.truthy(stored) & (stored != "none"), stored).otherwise(V.PRICED_SOURCE)).otherwise("none")


def facet_tags(members: DataFrame) -> DataFrame:
    """``(key, fandom, license, series_tags)`` from ``(key, dim, value)``."""
    wide = members.groupBy("key").pivot("dim", ["fandom", "license", "series"]).agg(F.array_sort(F.collect_set("value")))
    return wide.withColumnRenamed("series", "series_tags")


def export_records(catalog: DataFrame, contributed: Column) -> DataFrame:
    """Rows of the delta export, before its filters."""
    series = F.coalesce(F.col("series"), F.array().cast("array<string>"))
    plain = F.filter(series, lambda s: ~s.startswith("Pop!") & ~s.startswith("Funko") & ~s.contains("Exclusive") & (F.length(s) > 2))
    tag = F.get(F.filter(series, lambda s: s.rlike("(?i)exclusive") & (F.length(s) < 50)), F.lit(0))
    some = lambda c: F.nullif(c, F.lit(""))
    number = F.coalesce(some(F.col("funkoNumber")), some(F.col("funkoNumberFromTitle")))
    price = F.nullif(F.regexp_extract(X.sub(X.blank(F.col("price")), "[^0-9.]"), r"^\d*\.?\d+", 0), F.lit("")).try_cast("double")
    return catalog.select(
        "_ord", X.sub(F.col("upc"), r"\s").alias("upc"), F.substring(X.sub(F.col("handle"), r"\.html\z"), 1, 100).alias("handle"), F.col("title").alias("name"),
        F.coalesce(some(F.col("franchise")), F.get(plain, F.lit(0)), F.get(series, F.lit(0)), F.lit("")).alias("franchise"),
        F.lit(1).alias("schemaVersion"), F.lit("USER_SCAN").alias("source"), contributed.alias("contributedAt"),
        F.get(F.filter(series, lambda s: s.startswith("Pop!")), F.lit(0)).alias("category"), F.concat(F.lit("#"), number).alias("seriesNumber"),
        F.when(price != 0, price).alias("retailPrice"), some(F.col("imageName")).alias("imageUrl"),
        F.coalesce(some(F.col("exclusiveRetailer")), some(F.trim(X.sub(tag, r"(?i)\s*exclusives?\z")))).alias("exclusiveRetailer"),
        *(F.when(F.col(c), True).alias(c) for c in ("isVaulted", "isChase", "isExclusive")),
    )


def export(catalog: DataFrame, contributed: Column) -> tuple[DataFrame, DataFrame]:
    """The exported rows, and the number of rows for each first failing check."""
    made = export_records(catalog, contributed)
    judged = catalog.select("_ord", F.col("upc").alias("_u"), F.col("handle").alias("_h"), F.col("title").alias("_t")).join(made, "_ord")
    judged = judged.withColumn("reject_reason", predicates.reject_reason(F.col("_u"), F.col("_h"), F.col("_t"), F.col("franchise"))).drop("_u", "_h", "_t")
    return judged.filter("reject_reason is null").drop("reject_reason"), judged.groupBy("reject_reason").agg(F.count("*").alias("n"))
