"""The pricing pass: candidates, their listing rows, the gate, detail pages, and what is merged back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.functions import text as X
from shelfmark.operators import incremental, match, merge, predicates
from shelfmark.sources import html

c = F.col
GRADES = {"marketValueLoose": "loose", "marketValueComplete": "complete", "marketValueNew": "mint"}


def _details(details: DataFrame) -> DataFrame:
    """The last landed page of each address, with the fields that its labels stand for."""
    facts = F.struct("loose", "complete", "mint", "url", "labels")
    details = details.groupBy("href").agg(F.max_by(facts, "_ord").alias("page")).select("href", "page.*")
    fields = html.meta_fields(c("labels"))
    return details.select(c("href").alias("_href"), *(c(k).alias(f"_d_{k}") for k in ("loose", "complete", "mint", "url")), *(v.alias(f"_m_{k}") for k, v in fields.items()))


def price(catalog: DataFrame, listings: DataFrame, details: DataFrame, now: Column, fill_upc: bool = True, days: int = 0, limit: int | None = None) -> DataFrame:
    """The catalog with prices of confident matches; a detail page is believed before its listing row.

    ``listings`` as for match_listings, with ``id, href, loose, complete, mint``; ``details(_ord, href, loose,
    complete, mint, url, labels)`` in the order of landing: of an address' pages the last counts. A match without any
    price changes nothing. Fields that a record has are never replaced by a page's.
    """
    has = predicates.has_price(c("marketValueLoose"), c("marketValueComplete"), c("marketValueNew"))
    wanted = incremental.price_candidates(catalog, has, c("upc"), c("priceCheckedAt"), now, fill_upc, days, limit)
    found = match.match_listings(wanted.select("_ord", "title", "upc", "funkoNumber", "funkoNumberFromTitle"), listings).filter("match.ok")
    found = found.select("_ord", c("id").cast("string").alias("id"), "href", *GRADES.values(), "match.approximate")
    met = found.join(_details(details), c("href") == c("_href"), "left")
    new = met.select(
        c("_ord").alias("_o"), "id", merge.prefer(c("_d_url"), c("href")).alias("address"), "approximate",
        *(merge.prefer(c(f"_d_{k}"), c(k)).alias(f"_n_{f}") for f, k in GRADES.items()), *(c(f"_m_{f}") for f in V.META_LABELS.values()),
    ).filter(F.coalesce(*(c(f"_n_{f}") for f in GRADES)).isNotNull())
    out = catalog.join(new, c("_ord") == c("_o"), "left")
    hit, kind = c("_o").isNotNull(), {f.name: f.dataType for f in catalog.schema.fields}
    fields = {f: F.coalesce(f"_n_{f}", f) for f in GRADES} | {f: merge.blank_fill(c(f), c(f"_m_{f}"), kind[f]) for f in V.META_LABELS.values()}
    fields |= {"pricechartingId": F.coalesce("id", "pricechartingId"), "pricechartingUrl": F.coalesce("address", "pricechartingUrl")}
    fields |= {
        "priceCheckedAt": F.when(hit, F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(c("priceCheckedAt")), "priceSource": F.when(hit, V.PRICED_SOURCE).otherwise(c("priceSource")),
        "marketValueIsApproximate": F.when(c("approximate"), True).otherwise(c("marketValueIsApproximate")),
    }
    return out.select(*(fields[f].alias(f) if f in fields else c(f) for f in catalog.columns))


def discover(catalog: DataFrame, listings: DataFrame, details: DataFrame, limit: int | None = None) -> DataFrame:
    """New records of listing rows whose id the catalog lacks; here the listing row is believed before its page.

    ``listings(_ord, id, name, href, loose, complete, mint)`` in the order of the crawl, ``details`` as for
    ``price``; ``limit`` stops after so many additions.
    """
    known = catalog.filter(X.truthy(c("pricechartingId"))).select(c("pricechartingId").alias("id"))
    new = match.new_ids(listings.filter(X.truthy(c("id"))), known, limit=limit).join(_details(details), c("href") == c("_href"), "left")
    return new.select(
        "_ord", F.concat(F.lit("pc-"), c("id")).alias("handle"), c("name").alias("title"), F.lit(V.PRICED_SOURCE).alias("funkoSource"), c("id").alias("pricechartingId"), c("href").alias("pricechartingUrl"),
        *(merge.prefer(c(k), c(f"_d_{k}")).alias(f) for f, k in GRADES.items()), *(c(f"_m_{f}").alias(f) for f in V.META_LABELS.values()),
    )
