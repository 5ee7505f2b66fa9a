"""Classifiers and filters of catalog rows, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.functions import text as X


def _any(column: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | column.contains(w)
    return out


def is_figure_image(url: Column) -> Column:
    return X.truthy(url) & ~X.blank(url).rlike(V.NON_FIGURE_MEDIA)


def classify(title: Column) -> Column:
    """Struct (popType, name) of a figure's title, or null for lines, accessories and other goods."""
    t = X.trim(X.sub(X.trim(X.blank(title)), V.PROTECTOR_SUFFIX))
    alone = t.rlike(rf"(?i){V.B0}(?:{V.ACCESSORY_STANDALONE}){V.B1}(?!-)")
    wanted = t.rlike("(?i)^pop!") & ~t.rlike(X.words_of(V.DROP_LINES)) & ~t.rlike(X.words_of(V.ACCESSORY_KEYWORDS)) & ~alone
    return F.when(wanted, X.pop_type(t))


def is_non_pop(title: Column, series: Column, source: Column) -> Column:
    """True for goods of other lines; rows of a known source are never dropped."""
    tags = F.transform(F.coalesce(series, F.array().cast("array<string>")), F.lower)
    listed = F.exists(tags, lambda s: _any(s, V.NON_POP_SERIES))
    bundle = X.blank(title).rlike(rf"(?i){V.B0}pop and (?:shirt|tee){V.B1}|{V.B0}and (?:shirt|tee) (?:pack|set){V.B1}")
    shirts = F.exists(tags, lambda s: s.contains("and shirt pack")) & ~bundle
    return ~X.truthy(source) & (X.blank(title).rlike(X.words_of(V.NON_POP_TITLE_WORDS)) | F.coalesce(listed, F.lit(False)) | F.coalesce(shirts, F.lit(False)))


def drop_non_pops(catalog: DataFrame) -> DataFrame:
    return catalog.filter(~is_non_pop(F.col("title"), F.col("series"), F.col("funkoSource")))


def has_signal(number: Column, console: Column, priced_id: Column, source: Column) -> Column:
    return (X.digits(number) != "") | X.blank(console).rlike("^funko-pop-") | X.truthy(priced_id) | X.truthy(source)


def denylist(catalog: DataFrame, title: Column, signal: Column, titles: tuple[str, ...] = V.REMOVE_TITLES) -> DataFrame:
    """Add ``listed`` and ``dropped``: a listed title goes unless a signal protects the row.

    The list is part of the program, so it is a literal set in the plan.
    """
    listed = X.trim(X.blank(title)).isin(*titles)
    return catalog.withColumns({"listed": listed, "dropped": listed & ~F.coalesce(signal, F.lit(False))})


def denylist_audit(judged: DataFrame, title: Column, titles: tuple[str, ...] = V.REMOVE_TITLES) -> DataFrame:
    """``(title, outcome, rows)`` of judged rows: listed titles that were removed, protected, or are not in the catalog."""
    listed = judged.filter("listed").groupBy(X.trim(X.blank(title)).alias("title")).agg(F.count_if("dropped").alias("removed"), F.count_if(~F.col("dropped")).alias("protected"))
    asked = judged.sparkSession.createDataFrame([(t,) for t in titles], "title string").distinct()
    met = asked.join(listed, "title", "left")
    n = lambda k: F.coalesce(F.col(k), F.lit(0))
    outcomes = F.array_compact(F.array(
        F.when(n("removed") > 0, F.struct(F.lit("removed").alias("outcome"), n("removed").alias("rows"))), F.when(n("protected") > 0, F.struct(F.lit("protected").alias("outcome"), n("protected").alias("rows"))),
        F.when(n("removed") + n("protected") == 0, F.struct(F.lit("not found").alias("outcome"), F.lit(0).cast("long").alias("rows"))),
    ))
    return met.select("title", F.inline(outcomes))


def is_named_set_tag(tag: Column) -> Column:
    t = X.trim(F.lower(X.blank(tag)))
    ends = F.lit(False)
    for s in V.SET_SUFFIXES:
        ends = ends | t.endswith(s) | t.endswith(s + "s")
    return (t != "") & ~t.startswith("pop!") & ~t.isin(*V.SET_GENERIC_LINES) & ~_any(t, V.SET_EXCLUDE_KW) & ends


def reject_reason(upc: Column, handle: Column, title: Column, franchise: Column) -> Column:
    """The first check that an export row fails, or null."""
    return (
        F.when(~X.truthy(upc), "no_upc")
        .when(~X.truthy(handle) | X.blank(handle).endswith(".html"), "no_handle")
        .when(~X.valid_upc(X.sub(X.blank(upc), r"\s")), "bad_upc")
        .when(F.length(X.blank(title)) < 2, "no_name")
        .when(~X.truthy(franchise), "no_franchise")
    )


def listing_console(console: Column) -> Column:
    return X.blank(console).rlike("^funko-pop-")


def is_priced_source(source: Column, handle: Column | None = None) -> Column:
    own = X.blank(source) == V.PRICED_SOURCE
    return own if handle is None else own | X.blank(handle).startswith("pc-")


def pop_guard(series: Column) -> Column:
    """No tags, or one that names the main line."""
    return (F.coalesce(F.size(series), F.lit(0)) <= 0) | F.coalesce(F.exists(series, lambda s: s.rlike("(?i)^(?:funko )?pop")), F.lit(False))


def has_price(loose: Column, complete: Column, new: Column) -> Column:
    return X.truthy(loose) | X.truthy(complete) | X.truthy(new)
