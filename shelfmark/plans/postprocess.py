"""The catalog's post-processing, in the one order that is right.

Steps do not commute: goods of other lines go before rows of a handle merge, as a merge gives a
figure the tags of its namesakes and a later filter would drop it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.functions import text as X
from shelfmark.operators import derive, match, merge, predicates
from shelfmark.session import stash


def clean_titles(catalog: DataFrame) -> DataFrame:
    cleaned = X.clean_title(F.col("title"))
    return catalog.withColumn("title", F.when(X.truthy(cleaned), cleaned).otherwise(F.col("title")))


def extract_numbers(catalog: DataFrame) -> DataFrame:
    c = F.col
    number = X.number_in_title(c("title"))
    take = number.isNotNull() & ~X.truthy(c("funkoNumber")) & (X.blank(c("funkoSource")) != V.SHOP_SOURCE)
    return catalog.withColumns({
        "price": F.when(X.dirty_price(c("price")), X.clean_price(c("price"))).otherwise(c("price")),
        "funkoNumberFromTitle": F.when(take, number).otherwise(c("funkoNumberFromTitle")),
        "title": F.when(take, X.without_number(c("title"))).otherwise(c("title")),
    })


def stamp_sources(catalog: DataFrame) -> DataFrame:
    c = F.col
    return catalog.withColumn("priceSource", derive.price_source(c("priceSource"), c("marketValueLoose"), c("marketValueComplete"), c("marketValueNew")))


def restamp_sources(catalog: DataFrame) -> DataFrame:
    c = F.col
    return catalog.withColumn("priceSource", derive.restamp(c("priceSource"), c("marketValueLoose"), c("marketValueComplete"), c("marketValueNew")))


STEPS = (predicates.drop_non_pops, clean_titles, merge.merge_by_handle, extract_numbers, match.title_dedupe, match.blocked_dedupe, predicates.drop_non_pops, derive.grouping, stamp_sources)
#: After these steps the catalog is read several times by the next, so it is written once.
WRITTEN = {extract_numbers, match.title_dedupe, match.blocked_dedupe}


def run(catalog: DataFrame) -> DataFrame:
    for step in STEPS:
        catalog = catalog.transform(step)
        if step in WRITTEN:
            catalog = stash(catalog, step.__name__)
    return catalog
