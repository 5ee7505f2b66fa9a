"""Paging and retry rules over what a crawl has landed: where a set's crawl ends, and what became of each address.

Fetching stays outside; these say what to fetch next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V

c = F.col


def crawl_end(pages: DataFrame, max_pages: int = 0) -> DataFrame:
    """Where each set's crawl stops, or which page it needs next: ``set_key, last_page, offset, total, reason, next_page``.

    ``pages(set_key, page, _ord, rows, declared, ended)``: rows is null where no markup of a row was met, declared
    the page's own total or less than 0, ended whether a page without rows says that there are no more. The first
    rule that holds after a page stops the crawl: ``end`` (such a page), ``empty`` (three pages without rows in
    turn), ``limit``, ``total`` (the rows so far reach the first declared total), ``ceiling``. Else the set is
    ``open``, and its next page is the first that has not landed; what landed beyond that gap does not count yet.
    A page landed twice counts as it landed last. A set's window has as many rows as the ceiling at most.
    """
    facts = F.struct("rows", "declared", "ended")
    landed = pages.filter(c("page").between(1, V.PAGE_CEILING)).groupBy("set_key", "page").agg(F.max_by(facts, "_ord").alias("p")).select("set_key", "page", "p.*")
    so_far = Window.partitionBy("set_key").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(c("rows"), F.lit(0)) > 0
    runs = landed.select(
        "set_key",
        "page",
        (F.row_number().over(Window.partitionBy("set_key").orderBy("page")) == c("page")).alias("reached"),
        (c("rows").isNull() & F.coalesce("ended", F.lit(False))).alias("end"),
        (c("page") - F.coalesce(F.max(F.when(filled, c("page"))).over(so_far), F.lit(0))).alias("empties"),
        F.sum(F.when(filled, c("rows")).otherwise(0)).over(so_far).alias("offset"),
        F.first(F.when(c("declared") >= 0, c("declared")), ignorenulls=True).over(so_far).alias("total"),
    )
    reason = (
        F.when(c("end"), "end")
        .when(c("empties") >= V.EMPTY_PAGES, "empty")
        .when(F.lit(max_pages > 0) & (c("page") >= max_pages), "limit")
        .when((c("total") > 0) & (c("offset") >= c("total")), "total")
        .when(c("page") >= V.PAGE_CEILING, "ceiling")
    )
    runs = runs.withColumn("reason", F.when(c("reached"), reason))
    state = F.struct("page", "offset", "total", "reason")
    by_set = runs.groupBy("set_key").agg(F.min_by(F.when(c("reason").isNotNull(), state), F.when(c("reason").isNotNull(), c("page"))).alias("stop"), F.max_by(F.when(c("reached"), state), F.when(c("reached"), c("page"))).alias("last"))
    known = pages.select("set_key").distinct().join(by_set, "set_key", "left")
    at = F.coalesce("stop", "last")
    return known.select(
        "set_key",
        F.coalesce(at["page"], F.lit(0)).alias("last_page"),
        F.coalesce(at["offset"], F.lit(0)).alias("offset"),
        at["total"].alias("total"),
        F.coalesce(at["reason"], F.lit("open")).alias("reason"),
        F.when(at["reason"].isNull(), F.coalesce(at["page"], F.lit(0)) + 1).alias("next_page"),
    )


def attempts(log: DataFrame, tries: int = V.FETCH_TRIES, backoff_ms: int = V.FETCH_BACKOFF_MS) -> DataFrame:
    """What became of each address: ``address, outcome, tries, status, page, due``.

    ``log(address, _ord, at, status, page)``; a null status is an error of the network. A busy or failing server
    (429, 500 and up) and an error are tried again after ``backoff_ms`` times the number of tries. Outcomes:
    ``accepted`` (any other status, with its page), ``waiting`` (with the time it is due), ``refused`` (the last try
    met such a status) and ``failed`` (it met an error). Later tries than the last do not count. Only an address'
    first ``tries`` rows are shuffled, however many it has.
    """
    first = log.withColumn("_n", F.row_number().over(Window.partitionBy("address").orderBy("_ord"))).filter(c("_n") <= tries)
    ordered = first.groupBy("address").agg(F.array_sort(F.collect_list(F.struct("_n", "at", "status", "page"))).alias("list"))
    kinds = {f.name: f.dataType.simpleString() for f in log.schema.fields}
    start = F.struct(F.lit("waiting").alias("outcome"), F.lit(0).alias("tries"), F.lit(None).cast(kinds["status"]).alias("status"), F.lit(None).cast(kinds["page"]).alias("page"), F.lit(None).cast("timestamp").alias("due"))

    def step(s: Column, x: Column) -> Column:
        again = x["status"].isNull() | (x["status"] == 429) | (x["status"] >= 500)
        n = s["tries"] + 1
        last = n >= tries
        outcome = F.when(~again, "accepted").when(~last, "waiting").when(x["status"].isNull(), "failed").otherwise("refused")
        due = F.when(again & ~last, F.timestamp_millis(F.unix_millis(x["at"].cast("timestamp")) + backoff_ms * n))
        made = F.struct(outcome.alias("outcome"), n.alias("tries"), x["status"].alias("status"), F.when(~again, x["page"]).alias("page"), due.alias("due"))
        return F.when(s["outcome"] == "waiting", made).otherwise(s)

    return ordered.select("address", F.aggregate("list", start, step).alias("s")).select("address", "s.*")
