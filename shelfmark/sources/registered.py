"""The surface for SQL text: functions and table functions under names of their own.

``register(spark)`` adds, for the session: ``decode_entities`` and ``strip_accents`` (Arrow batches), ``url_handle``
(a function in SQL over them), and the page readers as table functions to be joined laterally: ``listing_rows``,
``tiles``, ``detail_page`` and ``reference_page``. A null page gives no row, but for ``detail_page``, which gives
one of nulls.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from shelfmark.functions import text as X
from shelfmark.sources import html

LISTING = "id string, name string, console string, href string, loose string, complete string, mint string"
TILE = "pid string, handle string, title string, price string, available boolean, series array<string>, productUrl string, funkoPrimaryImage string, funkoSource string"
DETAIL = "loose string, complete string, mint string, url string, labels map<string,string>"
REFERENCE = "field string, value string"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


class ListingRows:
    names = _names(LISTING)

    def eval(self, page: str) -> Iterator[tuple]:
        for row in html.listing_rows(page):
            yield tuple([row[n] for n in self.names])


class Tiles:
    def eval(self, page: str) -> Iterator[tuple]:
        for row in html.tiles(page) or ():
            yield tuple(row[n] for n in _names(TILE))


class DetailPage:
    def eval(self, page: str) -> Iterator[tuple]:
        row = html.detail(page)
        yield tuple(row[n] for n in _names(DETAIL))


class ReferencePage:
    def eval(self, page: str) -> Iterator[tuple]:
        yield from (html.reference_numbers(page) or {}).items()


TABLE_FUNCTIONS = {"listing_rows": (ListingRows, LISTING), "tiles": (Tiles, TILE), "detail_page": (DetailPage, DETAIL), "reference_page": (ReferencePage, REFERENCE)}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def url_handle_sql(value: str) -> str:
    """The expression behind ``url_handle``, by the same parts as the column function."""
    out = f"coalesce({value}, '')"
    for pattern, by in X.HANDLE_PARTS:
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(by)})"
    return f"regexp_replace(regexp_replace(strip_accents({out}), '-+', '-'), {_quoted(r'^-|-\z')}, '')"


def register(spark: SparkSession) -> None:
    spark.udf.register("decode_entities", X._decode)
    spark.udf.register("strip_accents", X.strip_accents)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION url_handle(handle STRING) RETURNS STRING RETURN {url_handle_sql('handle')}")
    for name, (reader, schema) in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, udtf(reader, returnType=schema))
