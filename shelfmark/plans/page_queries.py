"""Page readers, the pricing pass and the smaller catalog operators on the driver's tables, beside their SQL.

Pages are put together from table columns so that their rows, written in SQL without any page, must come
back out of the readers: every selector, every fallback, and the odd spellings.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.operators import crawl, derive, incremental, match, predicates, report
from shelfmark.plans import pricing
from shelfmark.plans.catalog_queries import ORACLES, query, quoted, read
from shelfmark.session import stash, stash_path
from shelfmark.sources import catalog, html, json_array, registered
from shelfmark.streaming import markers, resume

c = F.col


def page(*parts: object) -> Column:
    """Parts one after the other; strings are themselves, columns their values."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def spread(spark, sf, table: str, key: str) -> DataFrame:
    """A table's rows by key over the session's cores: the tables are one file each, and pages made of rows are read where they are made."""
    return read(spark, sf, table).repartition(4 * spark.sparkContext.defaultParallelism, key)


def pages_of(rows: DataFrame, key: str, made: Column) -> DataFrame:
    return rows.select(c(key).alias("page_id"), made.alias("html"))


TILE = "pid string, handle string, title string, price string, available boolean, series array<string>, productUrl string, funkoPrimaryImage string, funkoSource string"


def _tile_pages(spark, sf) -> DataFrame:
    """One page a part, by the seven ways of marking a tile up and one without any."""
    p, k, name = spread(spark, sf, "part", "p_partkey"), c("p_partkey"), c("p_name")
    way = k % 8
    open_, close = (
        [page('<div class="x product-tile" data-pid="', k, '">'), page('<div class="b-product-tile" data-product-id="', k, '">'), page('<li data-pid="', k, '">'), page('<div class="product-grid-item" data-itemid="', k, '">'),
         page('<article class="product" aria-label="', name, '" data-price="$', c("p_size"), '.50">'), page('<div data-product-id="', k, '" data-name="', name, '" data-category="Pop!|Toys > ', c("p_brand"), '">'), page('<div data-itemid="', k, '">'), page("<p>")],
        [page("</div>"), page("</div>"), page("</li>"), page("</div>"), page("</article>"), page("</div>"), page("</div>"), page("</p>")],
    )
    at = lambda xs: F.get(F.array(*xs), way)
    title = at([page('<div class="product-name"> ', name, " </div>"), page("<h2>", name, "</h2><h3>no</h3>"), page('<span class="product-title">', name, "</span>"), page('<b class="b-product-tile__name">', name, "</b>"), page(""), page(""), page(""), page("<h3>", name, "</h3>")])
    link = F.when(k % 3 == 0, page('<a href="/us">See</a><a href="/products/h', k, '/more?x=1">See</a>')).when(k % 3 == 1, page('<a href="https://shop.example/p/h', k, '">See</a>')).otherwise(page('<a name="x">See</a>'))
    price = F.when(way == 4, page("")).when(k % 5 == 0, page('<span class="sale-price-x">Price reduced from $', c("p_size"), ".99 to $ 4.50 (70% off)</span>")).otherwise(page('<i class="price">$', c("p_size"), '.00</i>'))
    gone = F.when(k % 4 == 0, page('<em class="is-out-of-stock">sold</em>')).when(k % 4 == 1, page('<em class="sold-out"></em>')).otherwise(page("<em>sold out</em>"))
    image = F.when(k % 2 == 0, page('<img src="/i', k, '.png">')).otherwise(page('<img data-src="/d', k, '.png">'))
    category = F.when(way == 5, page("")).when(k % 7 == 0, page('<u class="category">A, ', c("p_type"), "</u>")).otherwise(page(""))
    return pages_of(p, "p_partkey", page("<html><body>", at(open_), link, title, price, gone, image, category, at(close), "</body></html>"))


_TILE_SQL = """
SELECT p_partkey AS page_id, CASE WHEN p_partkey % 8 = 4 THEN '' ELSE p_partkey::VARCHAR END AS pid,
  CASE p_partkey % 3 WHEN 2 THEN '' ELSE 'h' || p_partkey END AS handle, p_name AS title,
  CASE WHEN p_partkey % 8 = 4 THEN p_size || '.50' WHEN p_partkey % 5 = 0 THEN '4.50' ELSE p_size || '.00' END AS price,
  p_partkey % 4 > 1 AS available,
  CASE WHEN p_partkey % 8 = 5 THEN 'Pop!;Toys;' || p_brand WHEN p_partkey % 7 = 0 THEN 'A;' || p_type ELSE '' END AS series,
  CASE p_partkey % 3 WHEN 0 THEN 'https://www.funko.com/products/h' || p_partkey || '/more?x=1' WHEN 1 THEN 'https://shop.example/p/h' || p_partkey ELSE '' END AS productUrl,
  CASE WHEN p_partkey % 2 = 0 THEN '/i' ELSE '/d' END || p_partkey || '.png' AS funkoPrimaryImage, 'funko.com' AS funkoSource
FROM part WHERE p_partkey % 8 NOT IN (6, 7)"""


@query(_TILE_SQL)
def q_tiles(spark, sf):
    return html.read_pages(_tile_pages(spark, sf), html.tiles, TILE).withColumn("series", F.array_join("series", ";")).drop("pos")


@query(f"SELECT page_id, pid, handle, title FROM ({_TILE_SQL})")
def q_short_tiles(spark, sf):
    return html.read_pages(_tile_pages(spark, sf), html.short_tiles, "pid string, handle string, title string").drop("pos")


def _money(cents: Column) -> Column:
    return page("$", F.when(c("o_orderkey") % 2 == 0, " ").otherwise(""), F.format_number(cents / 100, 2))


_CENTS = "(o_totalprice * 100)::BIGINT"


def _cents() -> Column:
    return F.round(c("o_totalprice") * 100).cast("long")


@query(f"""
WITH o AS (SELECT *, round(o_totalprice * 100)::BIGINT AS cents FROM orders)
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 3 = 0 THEN 'x-' || o_custkey ELSE 'T' || o_orderkey END AS id, 'Figure ' || o_custkey || ' #' || o_orderkey AS name,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'funko-pop-rides' END AS console,
  CASE WHEN o_orderkey % 5 = 0 THEN 'https://x.example/game/x-' ELSE 'https://www.pricecharting.com/game/funko-pop-rides/x-' END || o_custkey AS href,
  cents // 100 || '.' || lpad((cents % 100)::VARCHAR, 2, '0') AS loose, CASE WHEN o_orderkey % 4 = 0 THEN (cents + 1) // 100 || '.' || lpad(((cents + 1) % 100)::VARCHAR, 2, '0') END AS complete, NULL::VARCHAR AS mint
FROM o WHERE o_orderkey % 7 <> 0""")
def q_listing_rows(spark, sf):
    k = c("o_orderkey")
    href = F.when(k % 5 == 0, page("https://x.example/game/x-", c("o_custkey"))).otherwise(page("/game/funko-pop-rides/x-", c("o_custkey")))
    link = page('<a href="', href, '" title="', F.when(k % 3 == 0, " ").otherwise(page(" T", k)), '">pic</a>')
    cells = page("<td>", link, '</td><td class="title"><a href="', href, '">Figure  ', c("o_custkey"), "</a>\n #", k, "</td><td>c</td><td>", _money(_cents()), "</td><td>", F.when(k % 4 == 0, _money(_cents() + 1)).otherwise(page("-")), "</td><td>ask</td>")
    row = F.when(k % 7 == 0, page('<td><a href="/offers">no item</a></td>')).otherwise(cells)
    made = page('<table><tr><td><a href="/game/a/b">other table</a></td></tr></table><table id="games_table"><thead><tr><th><a href="/game/a/b">head</a></th></tr></thead><tbody><tr>', row, "</tr></tbody></table>")
    return html.read_pages(pages_of(spread(spark, sf, "orders", "o_orderkey"), "o_orderkey", made), html.listing_rows, "id string, name string, console string, href string, loose string, complete string, mint string").drop("pos")


def _detail_pages(spark, sf) -> DataFrame:
    k = c("o_orderkey")
    price = page('<div id="used_price"><b>Loose</b> <span class="js-price"> ', _money(_cents()), ' </span></div><p id="complete_price">', F.when(k % 3 == 0, page("$0.00")).when(k % 3 == 1, page("$ 100,000.01")).otherwise(page("$ 1.25 $9.99")), "</p>")
    meta = page(
        "<table><tr><td>UPC:</td><td>", F.when(k % 4 == 0, page("none")).when(k % 4 == 1, page("849803 097097, 88969812", F.lpad((k % 10000).cast("string"), 4, "0"))).when(k % 4 == 2, page("N/A")).otherwise(page("12")), "</td></tr>",
        "<tr><td>Box  Number:</td><td>#", k, " a</td></tr><tr><th>Series:</th><td>no</td></tr><tr><td>Series:</td><td>first</td></tr><tr><td>Series:</td><td>S  ", c("o_custkey"), "</td></tr>",
        "<tr><td>Release Date:</td><td>", F.when(k % 2 == 0, F.date_format("o_orderdate", "MMMM d, yyyy")).otherwise("soon"), "</td></tr><tr><td>Publisher</td><td>no colon</td></tr>",
        "<tr><td>ePID (eBay):</td><td>", k, "</td></tr><tr><td>ASIN (Amazon):</td><td></td></tr><tr><td>Print Run:</td><td>", c("o_orderpriority"), "</td></tr><tr><td>Description:</td><td>d</td></tr></table>",
    )
    return pages_of(spread(spark, sf, "orders", "o_orderkey"), "o_orderkey", page('<link rel="canonical" href="https://x/', k, '">', price, meta))


DETAIL = "loose string, complete string, mint string, url string, labels map<string,string>"


@query("""
SELECT o_orderkey AS page_id, CASE WHEN cents > 0 AND cents <= 10000000 THEN cents // 100 || '.' || lpad((cents % 100)::VARCHAR, 2, '0') END AS loose,
  CASE WHEN o_orderkey % 3 = 2 THEN '1.25' END AS complete, NULL::VARCHAR AS mint, 'https://x/' || o_orderkey AS url
FROM (SELECT *, round(o_totalprice * 100)::BIGINT AS cents FROM orders)""")
def q_detail_prices(spark, sf):
    return html.read_pages(_detail_pages(spark, sf), html.detail, DETAIL).select("page_id", "loose", "complete", "mint", "url")


@query("""
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS releaseDate, CASE WHEN o_orderkey % 4 = 1 THEN '88969812' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0') END AS upc,
  o_orderkey::VARCHAR AS funkoNumber, 'S ' || o_custkey AS pcSeries, o_orderkey::VARCHAR AS ebayEpid, NULL::VARCHAR AS amazonAsin, o_orderpriority::VARCHAR AS printRun, NULL::VARCHAR AS publisher, 'd' AS pcDescription FROM orders""")
def q_detail_fields(spark, sf):
    rows = html.read_pages(_detail_pages(spark, sf), html.detail, DETAIL)
    return rows.select("page_id", *(v.alias(k) for k, v in html.meta_fields(c("labels")).items()))


@query("""
SELECT s_suppkey AS page_id, 'H' || s_nationkey AS hdbid, CASE WHEN s_suppkey % 3 = 0 THEN ' 8498-03'[2:] ELSE lpad(s_suppkey::VARCHAR, 12, '7') END AS upc, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey::VARCHAR END AS funkoNumber,
  'hot2' AS hotTopicSku, NULL::VARCHAR AS gamestopSku, 't' || s_suppkey AS targetSku, CASE WHEN s_suppkey % 5 = 0 THEN 'w' END AS walmartSku, 'a b' AS amazonSku FROM supplier""")
def q_reference_numbers(spark, sf):
    k, box = c("s_suppkey"), lambda label, value: page('<div class="spaced-field"><strong>', label, '</strong><div class="ng-binding"> ', value, " </div></div>")
    made = page(
        box("HDBID:", page("H", c("s_nationkey"))), F.when(k % 3 == 0, box("UPC:", page("8498-03"))).otherwise(page('<a href="?_nkw=', F.lpad(k.cast("string"), 12, "7"), '">e</a>')), box("Reference #:", F.when(k % 2 == 0, page(k)).otherwise(page("no number"))),
        box("Hot Topic SKU:", page("hot1")), '<div class="col-md-6"><strong>Hot Topic SKU:</strong> <div class="ng-binding">hot2</div></div>', box("GameStop SKU", page("-")), '<p><strong>GameStop SKU:</strong><i class="ng-binding">no box</i></p>',
        '<strong class="spaced-field">Target</strong><i class="ng-binding">t', k, "</i>", box("Walmart SKU:", F.when(k % 5 == 0, page("w")).otherwise(F.repeat(F.lit("w"), 50))), box("Amazon SKU:", page("a b")), box("Other:", page("x")), '<a href="?itemId=1">i</a>',
    )
    fields = [*("hdbid", "upc", "funkoNumber"), *V.SKU_LABELS.values()]
    return html.read_pages(pages_of(spread(spark, sf, "supplier", "s_suppkey"), "s_suppkey", made), html.reference_numbers, ", ".join(f"{f} string" for f in fields)).drop("pos")


@query("""SELECT c_custkey AS page_id, CASE WHEN c_custkey % 3 > 0 THEN 'Pop! Vinyl;N' || c_nationkey || CASE WHEN c_custkey % 3 = 2 THEN ';Event' ELSE '' END END AS tags FROM customer""")
def q_subject_tags(spark, sf):
    k, link = c("c_custkey"), lambda path, text: page('<a class="t" href="', path, '">', text, "</a>")
    none = page(link("/subjects/one-series/all", "no"), link("/lists/one-series", "no"), link("/subjects/one-series-x", "no"), link("/subjects/one-series", page("<b> </b>")))
    some = page(link("/m/subjects/pop-vinyl-series", page(" Pop! <i>Vinyl</i>\n")), link("/subjects/n-series", page("N", c("c_nationkey"))), link("/subjects/pop-vinyl-series", "Pop! Vinyl"), F.when(k % 3 == 2, link("/subjects/e-event-series", "Event")).otherwise(""))
    rows = pages_of(read(spark, sf, "customer"), "c_custkey", page(none, F.when(k % 3 > 0, some).otherwise("")))
    return rows.select("page_id", F.array_join(html.subject_tags(c("html")), ";").alias("tags"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN -1 WHEN o_orderkey % 4 = 2 AND o_custkey < 10 THEN -1 ELSE o_custkey::INT END AS shop, CASE WHEN o_orderkey % 4 > 1 THEN -1 ELSE o_custkey::INT END AS facet, CASE WHEN o_orderkey % 4 = 2 THEN 0 WHEN o_orderkey % 4 = 3 THEN o_custkey::INT ELSE 0 END AS in_set,
 o_orderkey % 3 = 0 OR o_orderkey % 4 < 2 OR (o_orderkey % 4 = 2 AND o_custkey >= 10) AS content FROM orders""")
def q_page_totals(spark, sf):
    k, n = c("o_orderkey"), F.format_number(c("o_custkey"), 0)
    made = F.when(k % 4 == 0, page("1-20 of\n", n, " ITEMS (7) Results")).when(k % 4 == 1, page("<h1>Toys</h1> (", n, ") results")).when(k % 4 == 2, page("we have ", n, " Item")).otherwise(page("Prices for all ", n, " Funko X Figures, 0 / 5 things"))
    shop = html.declared_total(made)
    return read(spark, sf, "orders").select(
        k, shop.alias("shop"), html.declared_total(made, V.FACET_TOTALS).alias("facet"), html.declared_total(made, V.SET_TOTALS, 0).alias("in_set"), html.has_content(F.when(k % 3 == 0, 1).otherwise(0), shop).alias("content")
    )


# Selection and small reports


def _reference_rows(spark, sf) -> DataFrame:
    k = c("p_partkey")
    return read(spark, sf, "part").select(
        k.alias("_ord"), F.when(k % 11 == 0, "").when(k % 11 == 1, "x.html").otherwise("h").alias("handle"), F.when(k % 2 == 0, "7").when(k % 3 == 0, "").alias("hdbid"), (k % 5 < 3).alias("hdbChecked"),
        F.when(k % 7 == 0, F.array().cast("array<string>")).when(k % 7 > 2, F.array("p_type")).alias("series"),
    )


@query("""SELECT mode, p_partkey FROM part, (VALUES ('all'), ('no_refs'), ('no_series'), ('default')) m(mode) WHERE p_partkey % 11 > 1 AND
 CASE mode WHEN 'all' THEN true WHEN 'no_refs' THEN p_partkey % 5 < 3 AND p_partkey % 2 = 1 WHEN 'no_series' THEN p_partkey % 5 < 3 AND p_partkey % 7 <= 2 ELSE p_partkey % 2 = 1 AND p_partkey % 5 >= 3 END""")
def q_reference_modes(spark, sf):
    rows, out = _reference_rows(spark, sf), None
    for mode in ("all", "no_refs", "no_series", "default"):
        one = incremental.reference_candidates(rows, mode).select(F.lit(mode).alias("mode"), c("_ord").alias("p_partkey"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0")
def q_code_candidates(spark, sf):
    k = c("o_orderkey")
    rows = read(spark, sf, "orders").withColumn("_ord", k)
    return incremental.price_candidates(rows, k % 2 == 0, F.when(k % 3 == 0, "  ").otherwise("1"), F.lit(None), F.lit(None)).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_size % 3 = 0 AND p_partkey % 2 = 0 AND p_partkey % 5 > 0")
def q_franchise_candidates(spark, sf):
    k = c("p_partkey")
    rows = read(spark, sf, "part").select(k.alias("_ord"), F.when(c("p_size") % 3 > 0, "F").alias("franchise"), F.when(k % 2 == 1, True).alias("franchiseChecked"), F.when(k % 5 > 0, "u").otherwise("").alias("productUrl"))
    return incremental.franchise_candidates(rows).select(c("_ord").alias("p_partkey"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN true WHEN p_size % 2 = 0 THEN true END AS checked FROM part""")
def q_mark_checked(spark, sf):
    p, k = read(spark, sf, "part"), c("p_partkey")
    rows = p.select(k.alias("_ord"), F.when(c("p_size") % 2 == 0, True).alias("checked"))
    outcomes = p.filter(k % 4 < 3).select(k.alias("_ord"), F.get(F.array(F.lit("found"), F.lit("none"), F.lit("error")), k % 4).alias("status"))
    return incremental.mark_checked(rows, outcomes.unionAll(outcomes), "checked").select(c("_ord").alias("p_partkey"), "checked")


@query("SELECT p_partkey, p_size AS count FROM part WHERE p_size < 40 AND p_partkey % 9 > 0")
def q_narrowing(spark, sf):
    facets = read(spark, sf, "part").select("p_partkey", F.when(c("p_partkey") % 9 == 0, -1).otherwise(c("p_size")).alias("count"))
    return incremental.narrowing(facets, F.lit(40))


@query(f"""WITH t AS (SELECT unnest([{quoted(V.REMOVE_TITLES)}]) AS title, unnest(range(25)) AS i),
r AS (SELECT title, p_size % 5 = 0 AS kept FROM part JOIN t ON i = p_partkey % 30 WHERE i <> 3)
SELECT title, 'removed' AS outcome, count(*) AS rows FROM r WHERE NOT kept GROUP BY title UNION ALL SELECT title, 'protected', count(*) FROM r WHERE kept GROUP BY title
UNION ALL SELECT title, 'not found', 0 FROM t WHERE title NOT IN (SELECT title FROM r)""")
def q_denylist_audit(spark, sf):
    p, k = read(spark, sf, "part"), c("p_partkey")
    titles = F.array(*map(F.lit, V.REMOVE_TITLES))
    title = F.when(k % 30 == 3, c("p_name")).otherwise(F.concat(F.lit(" "), F.get(titles, (k % 30).cast("int")), F.lit(" ")))
    signal = predicates.has_signal(F.when(c("p_size") % 5 == 0, "No. 7"), F.lit(None), F.lit(None), F.lit(None))
    rows = p.select(title.alias("title"), "p_size")
    return predicates.denylist_audit(predicates.denylist(rows, c("title"), signal), c("title"))


_CATALOG_SQL = """SELECT count(*) AS total, count(*) FILTER (WHERE p_size % 2 = 0) AS priced, count(*) FILTER (WHERE p_partkey % 3 = 0) AS upc, count(*) FILTER (WHERE p_size % 2 = 0 AND p_partkey % 3 > 0) AS priced_no_upc,
 count(*) FILTER (WHERE p_partkey % 4 = 0) AS discovered, count(*) FILTER (WHERE p_partkey % 12 = 0) AS discovered_upc FROM part"""


def _small_catalog(spark, sf) -> DataFrame:
    k, some = c("p_partkey"), lambda cond, v: F.when(cond, v).otherwise("")
    return read(spark, sf, "part").select(
        k.alias("_ord"), c("p_name").alias("title"), some(c("p_size") % 2 == 0, "1.00").alias("marketValueLoose"), F.lit(None).cast("string").alias("marketValueComplete"), F.lit("").alias("marketValueNew"), some(k % 3 == 0, "1").alias("upc"),
        some(k % 4 == 0, "pricecharting").alias("funkoSource"), F.when(k % 7 == 0, True).alias("hdbChecked"), some(k % 10 == 0, "9").alias("pricechartingId"),
    )


@query(_CATALOG_SQL)
def q_audit(spark, sf):
    return report.audit(_small_catalog(spark, sf), predicates.is_priced_source(c("funkoSource")))


@query("SELECT count(*) FILTER (WHERE p_partkey % 7 = 0 OR p_size % 2 = 0 OR p_partkey % 10 = 0 OR p_partkey % 3 = 0) AS worked_on FROM part")
def q_worked_on(spark, sf):
    return _small_catalog(spark, sf).agg(F.count_if(catalog.worked_on()).alias("worked_on"))


@query(f"SELECT a.total = b.total AND a.priced = b.priced AND a.upc = b.upc AS converged, step FROM ({_CATALOG_SQL}) a, (SELECT *, 'same' AS step FROM ({_CATALOG_SQL}) UNION ALL SELECT *, 'fewer' FROM ({_CATALOG_SQL} WHERE p_partkey <> 1)) b")
def q_converged(spark, sf):
    rows = _small_catalog(spark, sf)
    audit = lambda r: report.audit(r, F.lit(False))
    made = [report.converged(audit(rows), audit(r)).withColumn("step", F.lit(step)) for step, r in (("same", rows), ("fewer", rows.filter("_ord <> 1")))]
    return made[0].unionByName(made[1])


# Pages that leave end tags out


def _open_listing_pages(spark, sf) -> DataFrame:
    """One listing a customer: a row an order, with hardly an end tag, no table body, and tables within cells."""
    k = c("o_orderkey")
    link = page('<a href="/game/funko-pop-rides/x-', k, '" title="T', k, '">')
    row = F.when(k % 2 == 0, page("<tr><td>", link, '<td class="title">Figure<p>', k, "<td>c<td>", _money(_cents()), "<td><td>$1.25<td><table><tr><td>in a cell<td>$9.99</table>")).otherwise(
        page("<tr><td>", link, '</a></td><td class="title"> Figure', k, "</td><td>c</td><td>", _money(_cents()), "</td><td></td><td>$1.25</td></tr>")
    )
    rows = spread(spark, sf, "orders", "o_custkey").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("rows"))
    head = F.when(c("o_custkey") % 3 == 0, page('<thead><tr><th><a href="/game/a/b">head</a><tbody>')).otherwise(page(""))
    return pages_of(rows, "o_custkey", page('<ul><li>one<li><p>two<div><table id="games_table">', head, c("rows"), '<tfoot><tr><td><a href="/game/a/foot">foot</a></table><p>end'))


@query("""
SELECT o_custkey AS page_id, 'T' || o_orderkey AS id, 'Figure' || o_orderkey AS name, 'funko-pop-rides' AS console, cents // 100 || '.' || lpad((cents % 100)::VARCHAR, 2, '0') AS loose, NULL::VARCHAR AS complete, '1.25' AS mint
FROM (SELECT *, round(o_totalprice * 100)::BIGINT AS cents FROM orders)""")
def q_open_listing(spark, sf):
    return html.read_pages(_open_listing_pages(spark, sf), html.listing_rows, "id string, name string, console string, loose string, complete string, mint string").drop("pos")


@query(f"SELECT * FROM ({ORACLES['q_detail_prices']}) JOIN ({ORACLES['q_detail_fields']}) USING (page_id)")
def q_open_detail(spark, sf):
    pages = _detail_pages(spark, sf)
    opened = F.when(c("page_id") % 2 == 0, F.regexp_replace("html", "</(td|tr|th|p|div)>", "")).otherwise(c("html"))
    rows = html.read_pages(pages.withColumn("html", page("<p>before<ul><li>x", opened)), html.detail, DETAIL)
    return rows.select("page_id", "loose", "complete", "mint", "url", *(v.alias(k) for k, v in html.meta_fields(c("labels")).items()))


# The same readers and functions in SQL text


@query(ORACLES["q_open_listing"])
def q_sql_listing(spark, sf):
    registered.register(spark)
    pages = _open_listing_pages(spark, sf)
    return spark.sql("SELECT p.page_id, r.id, r.name, r.console, r.loose, r.complete, r.mint FROM {pages} p, LATERAL listing_rows(p.html) r", pages=pages)


@query("""
SELECT p_partkey, 'Fish & Chips "' || p_name || '" &nope;' AS decoded, lower(replace(p_name, ' ', '-')) || '-cafe-' || p_partkey AS handle FROM part""")
def q_sql_functions(spark, sf):
    registered.register(spark)
    return spark.sql(
        """SELECT p_partkey, decode_entities(concat('Fish &amp; Chips &quot;', p_name, '&#34; &nope;')) AS decoded,
             url_handle(concat('-', lower(replace(p_name, ' ', '-')), '&amp;-(caf\u00e9)-[x]-', p_partkey, '.')) AS handle FROM {part}""",
        part=read(spark, sf, "part"),
    )


# Where a crawl ends


@query("""
WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
p AS (SELECT o_custkey AS set_key, n + CASE WHEN o_custkey % 5 = 0 AND n > 7 THEN 1 ELSE 0 END AS page, CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 3 END ELSE o_orderkey % 10 + 1 END AS rows,
  CASE WHEN n = 2 AND o_custkey % 2 = 0 THEN 20 WHEN n = 3 THEN 10 ELSE -1 END AS declared, o_orderkey % 7 = 0 AS ended FROM o),
walk AS (
  SELECT DISTINCT set_key, 0 AS page, 0 AS start, -1 AS total, 0 AS empties, NULL::VARCHAR AS reason FROM p
  UNION ALL
  SELECT w.set_key, p.page, w.start + coalesce(p.rows, 0), CASE WHEN w.total < 0 THEN p.declared ELSE w.total END, CASE WHEN coalesce(p.rows, 0) = 0 THEN w.empties + 1 ELSE 0 END,
    CASE WHEN p.rows IS NULL AND p.ended THEN 'end' WHEN coalesce(p.rows, 0) = 0 AND w.empties = 2 THEN 'empty' WHEN (CASE WHEN w.total < 0 THEN p.declared ELSE w.total END) BETWEEN 1 AND w.start + coalesce(p.rows, 0) THEN 'total' END
  FROM walk w JOIN p ON p.set_key = w.set_key AND p.page = w.page + 1 WHERE w.reason IS NULL)
SELECT set_key, max(page) AS last_page, max(start) AS "offset", nullif(arg_max(total, page), -1) AS total, coalesce(max(reason), 'open') AS reason, CASE WHEN max(reason) IS NULL THEN max(page) + 1 END AS next_page FROM walk GROUP BY set_key""")
def q_crawl_end(spark, sf):
    k, n = c("o_orderkey"), c("n")
    o = read(spark, sf, "orders").withColumn("n", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    pages = o.select(
        c("o_custkey").alias("set_key"), F.when((c("o_custkey") % 5 == 0) & (n > 7), n + 1).otherwise(n).alias("page"), F.lit(1).alias("_ord"),
        F.when(k % 4 == 0, 0).when((k % 4 == 1) & (c("o_custkey") % 3 == 0), None).when(k % 4 == 1, 3).otherwise(k % 10 + 1).alias("rows"),
        F.when((n == 2) & (c("o_custkey") % 2 == 0), 20).when(n == 3, 10).otherwise(-1).alias("declared"), (k % 7 == 0).alias("ended"),
    )
    return crawl.crawl_end(pages)


@query("""
WITH l AS (SELECT l_orderkey AS address, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n, l_shipdate::TIMESTAMP AS seen,
  CASE l_partkey % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 503 END AS status FROM lineitem),
s AS (SELECT address, min(n) FILTER (WHERE n <= 3 AND status IN (200, 404)) AS good, least(max(n), 3) AS met FROM l GROUP BY address)
SELECT address, CASE WHEN good IS NOT NULL THEN 'accepted' WHEN met < 3 THEN 'waiting' WHEN status IS NULL THEN 'failed' ELSE 'refused' END AS outcome, coalesce(good, met)::INTEGER AS tries, status,
  CASE WHEN good IS NOT NULL THEN 'page ' || good END AS page, CASE WHEN good IS NULL AND met < 3 THEN strftime(seen + to_seconds(2 * met), '%Y-%m-%d %H:%M:%S') END AS due
FROM s JOIN l USING (address) WHERE n = coalesce(good, met)""")
def q_attempts(spark, sf):
    k = c("l_partkey") % 5
    # lines of one number and part are told apart by their date, so that reruns agree
    rows = read(spark, sf, "lineitem").withColumn("_ord", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_shipdate")))
    status = F.when(k == 0, 200).when(k == 1, 404).when(k == 2, 429).when(k == 3, 503)
    log = rows.select(c("l_orderkey").alias("address"), "_ord", c("l_shipdate").cast("timestamp").alias("at"), status.alias("status"), page("page ", c("_ord")).alias("page"))
    return crawl.attempts(log).withColumn("due", F.date_format("due", "yyyy-MM-dd HH:mm:ss"))


# Catalog files: written by many tasks, read in ranges


def _catalog_rows(spark, sf) -> DataFrame:
    k = c("p_partkey")
    none = F.lit(None).cast("string")
    return read(spark, sf, "part").select(
        k.alias("_ord"), page('h "', k, '"').alias("handle"), F.when(k % 3 == 0, none).otherwise(page("{", c("p_name"), "], [\\", c("p_type"))).alias("title"), F.when(k % 4 == 0, F.array("p_brand", "p_type")).alias("series"), F.when(k % 5 == 0, "1").alias("upc"),
    )


_ARRAY_SQL = r"""SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS _ord, 'h "' || p_partkey || '"' AS handle, CASE WHEN p_partkey % 3 > 0 THEN '{' || p_name || '], [\' || p_type END AS title,
  CASE WHEN p_partkey % 4 = 0 THEN p_brand || ';' || p_type END AS series, CASE WHEN p_partkey % 5 = 0 THEN '1' END AS upc FROM part"""


@query(_ARRAY_SQL)
def q_json_array(spark, sf):
    path = stash_path(spark, "array")
    catalog.write_json_array(_catalog_rows(spark, sf), path)
    found = catalog.read_catalog(spark, path, range_bytes=20_000)
    return found.select("_ord", "handle", "title", F.array_join("series", ";").alias("series"), "upc")


@query("SELECT 'none' AS dataset, 0 AS rows UNION ALL SELECT 'cut off', 0 UNION ALL SELECT 'bad record', 0 UNION ALL SELECT 'whole', count(*) FROM part")
def q_optional_datasets(spark, sf):
    """What passes get of datasets that are missing, cut off, of a bad record, or whole."""
    lines = _catalog_rows(spark, sf).select("_ord", F.to_json(F.struct("handle", "title")).alias("value"))
    made = {"none": None, "cut off": (lines, ""), "bad record": (lines.withColumn("value", F.when(c("_ord") == 7, "{nope}").otherwise(c("value"))), "]"), "whole": (lines, "]")}
    out = []
    for name, how in made.items():
        path = stash_path(spark, "optional")
        if how:
            json_array.write_text(how[0], path, tail=how[1])
        out.append(catalog.read_optional(spark, path, catalog.CATALOG).agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows"))
    return reduce(DataFrame.unionByName, out)


@query("""
WITH v AS (SELECT CASE p_size % 2 WHEN 0 THEN 'fandom' ELSE 'series' END AS dim, p_type AS name, count(*) AS n FROM part GROUP BY ALL)
SELECT dim, name, n AS count, (SELECT count(*) FROM v w WHERE w.dim = v.dim) AS names, (SELECT count(*) FROM part) AS total FROM v""")
def q_vocabulary(spark, sf):
    p = read(spark, sf, "part")
    words = p.groupBy(F.when(c("p_size") % 2 == 0, "fandom").otherwise("series").alias("dim"), c("p_type").alias("name")).agg(F.count("*").alias("count"))
    path = stash_path(spark, "vocabulary")
    catalog.write_vocabulary(words, path, p.count(), "2024-01-01T00:00:00Z")
    names = "map<string,bigint>"
    parts = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("f"), "value")
    whole = parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "value"))), lambda x: x["value"]), "").alias("value"))
    found = whole.select(F.from_json("value", f"counts {names}, unfilteredTotal bigint, vocabulary map<string,{names}>").alias("v")).select("v.*", F.explode("v.vocabulary").alias("dim", "words"))
    return found.select("dim", F.explode("words").alias("name", "count"), F.element_at("counts", c("dim")).alias("names"), c("unfilteredTotal").alias("total"))


# Versions, finished sets, resumed runs and counters


@query("SELECT p_partkey, p_name FROM part WHERE p_size > 10")
def q_current_version(spark, sf):
    """Three versions are committed, a fourth is written and never committed: the third is the current one."""
    folder, p = stash_path(spark, "versions"), read(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    for least in (40, 25, 10):
        catalog.write_versioned(p.filter(c("p_size") > least).drop("p_size"), folder)
    p.write.parquet(f"{folder}/v-lost")
    return catalog.read_latest(spark, folder)


@query("SELECT DISTINCT p_brand AS key, 'kept' AS run FROM part UNION ALL SELECT DISTINCT p_brand, 'ended early' FROM part")
def q_done_sets(spark, sf):
    """Finished sets outlive a run that ended early and are forgotten after one that is complete."""
    path, p = stash_path(spark, "done"), read(spark, sf, "part")
    catalog.write_done(p.filter("p_size > 10"), path, "p_brand")
    catalog.write_done(p, path, "p_brand")
    kept = stash(catalog.read_done(spark, path).withColumn("run", F.lit("kept")))
    catalog.clear_done(spark, path, complete=False)
    early = stash(catalog.read_done(spark, path).withColumn("run", F.lit("ended early")))
    catalog.clear_done(spark, path, complete=True)
    return kept.unionByName(early).unionByName(catalog.read_done(spark, path).withColumn("run", F.lit("complete")))


@query("SELECT p_partkey, 2 * p_size AS twice FROM part")
def q_resumed_run(spark, sf):
    """Files that land between two runs of a stream are worked on once each."""
    src, out, check = (stash_path(spark, k) for k in ("landed", "worked", "progress"))
    p = read(spark, sf, "part").select("p_partkey", "p_size")
    for part in (c("p_partkey") % 3 == 0, c("p_partkey") % 3 > 0):
        p.filter(part).repartition(3).write.mode("append").parquet(src)
        resume.run_new_files(spark, src, p.schema, lambda b: b.select("p_partkey", (2 * c("p_size")).alias("twice")), out, check, 2).awaitTermination()
    return spark.read.parquet(out).select("p_partkey", "twice")


_MARKED = """
WITH l AS (SELECT 'c' || o_custkey AS key, o_orderdate::TIMESTAMP AS seen, o_orderkey % 4 < 2 AS done FROM orders WHERE o_orderkey % 4 < 3)
SELECT key, strftime(max(seen) FILTER (WHERE done), '%Y-%m-%d') AS done_at, coalesce(max(seen) FILTER (WHERE done) + INTERVAL 300 DAY <= (SELECT max(seen) FROM l), true) AS due FROM l GROUP BY key"""


def _marker_log(spark, sf) -> DataFrame:
    k = c("o_orderkey") % 4
    status = F.when(k == 0, "found").when(k == 1, "none").when(k == 2, "error").otherwise("unknown")
    return read(spark, sf, "orders").select(page("c", c("o_custkey")).alias("key"), c("o_orderdate").cast("timestamp").alias("at"), status.alias("status"))


@query(_MARKED)
def q_done_markers(spark, sf):
    """Which sets are due again, by one pass over the log."""
    return markers.now_due(_marker_log(spark, sf), 300).withColumn("done_at", F.date_format("done_at", "yyyy-MM-dd"))


@query(f"SELECT * FROM ({_MARKED}) WHERE done_at IS NOT NULL")
def q_marker_stream(spark, sf):
    """The same by the stream's state and timers, over a restart: the log lands in two parts."""
    src, out, check = (stash_path(spark, k) for k in ("log", "events", "progress"))
    log = _marker_log(spark, sf)
    middle = log.agg(F.expr("percentile(unix_seconds(at), 0.5)")).first()[0]
    for part in (F.unix_seconds("at") < middle, F.unix_seconds("at") >= middle):
        log.filter(part).write.mode("append").parquet(src)
        markers.run_markers(spark, src, out, check, 300).awaitTermination()
    last = lambda event: F.max(F.when(c("event") == event, c("at")))
    events = spark.read.parquet(out).groupBy("key").agg(last("finished").alias("f"), last("due").alias("d"))
    return events.select("key", F.date_format("f", "yyyy-MM-dd").alias("done_at"), F.coalesce(c("d") > c("f"), F.lit(False)).alias("due"))


@query("SELECT p_partkey FROM part WHERE p_size % 2 = 0 ORDER BY p_partkey LIMIT 30")
def q_limited_candidates(spark, sf):
    """The limit of a pass: the first rows that still need work."""
    k = c("p_partkey")
    rows = read(spark, sf, "part").withColumn("_ord", k)
    found = incremental.price_candidates(rows, c("p_size") % 2 == 1, F.lit("1"), F.lit(None), F.lit(None), limit=30)
    return found.select("p_partkey")


@query(f"SELECT total AS rows, priced, upc FROM ({_CATALOG_SQL})")
def q_pass_counters(spark, sf):
    """Counters that are counted while a pass writes its rows."""
    price = predicates.has_price(c("marketValueLoose"), c("marketValueComplete"), c("marketValueNew"))
    rows, seen = report.observed(_small_catalog(spark, sf), f"pass-{uuid.uuid4().hex}", priced=price, upc=c("upc") != "")
    stash(rows, "pass")
    return spark.createDataFrame([seen.get], "rows long, priced long, upc long")


# Joins, merges and the pricing pass


@query("""
WITH f AS (SELECT p_partkey AS o, 'I' || p_partkey % 400 AS id FROM part WHERE p_partkey % 3 = 0), k AS (SELECT DISTINCT 'I' || s_suppkey % 400 AS id FROM supplier)
SELECT min(o) AS p_partkey, id FROM f WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.id = f.id) GROUP BY id ORDER BY 1 LIMIT 25""")
def q_stop_after(spark, sf):
    found = read(spark, sf, "part").filter(c("p_partkey") % 3 == 0).select(c("p_partkey").alias("_ord"), F.concat(F.lit("I"), (c("p_partkey") % 400).cast("string")).alias("id"))
    known = read(spark, sf, "supplier").select(F.concat(F.lit("I"), (c("s_suppkey") % 400).cast("string")).alias("id"))
    return match.new_ids(found, known, limit=25).select(c("_ord").alias("p_partkey"), "id")


@query("""
WITH p AS (SELECT *, p_partkey % 6 AS m FROM part), t AS (SELECT p_type, max(p_partkey) FILTER (WHERE p_partkey % 2 = 0) AS last, min(p_partkey) AS first FROM part GROUP BY p_type),
j AS (SELECT t.last AS target, 'fan' AS f FROM t WHERE last IS NOT NULL UNION ALL SELECT t.first, 'title' FROM t)
SELECT p_partkey, coalesce((SELECT string_agg(DISTINCT f, ',' ORDER BY f) FROM j WHERE target = p_partkey), '') AS fandom FROM part""")
def q_facet_join(spark, sf):
    p = read(spark, sf, "part")
    none = F.lit(None).cast("array<string>")
    rows = p.select(c("p_partkey").alias("_ord"), F.when(c("p_partkey") % 4 == 0, F.initcap("p_type")).when(c("p_partkey") % 2 == 0, c("p_type")).otherwise("").alias("handle"), F.concat(F.lit("Pop! "), "p_type").alias("title"), none.alias("funkoFandom"), none.alias("funkoLicense"), none.alias("funkoSeries"))
    types = p.select("p_type").distinct()
    tag = lambda key, f: types.select(key.alias("key"), F.array(F.lit(f)).alias("fandom"), F.array().cast("array<string>").alias("license"), none.alias("series_tags"))
    tags = tag(F.lower("p_type"), "fan").unionByName(tag(F.concat(F.lit("pop! "), F.lower("p_type"), F.lit("!")), "title")).unionByName(tag(F.concat("p_type", F.lit(" nowhere")), "lost"))
    return match.facet_join(rows, tags).select(c("_ord").alias("p_partkey"), F.array_join(F.array_sort(F.coalesce("funkoFandom", F.array().cast("array<string>"))), ",").alias("fandom"))


@query("""
WITH r AS (SELECT p_partkey, p_size % 3 AS m, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN ['Pop! X', p_brand || ' Mystery Box'] ELSE ['Exclusive Mystery Box', p_type || ' Gift Set', p_brand || ' Mystery Box'] END AS tags FROM part),
e AS (SELECT p_partkey, unnest(tags) AS tag, unnest(range(len(tags))) AS pos FROM r), n AS (SELECT tag, count(*) AS n FROM e GROUP BY tag)
SELECT r.p_partkey, coalesce((SELECT arg_min(e.tag, n.n * 1000 + e.pos) FROM e JOIN n USING (tag) WHERE e.p_partkey = r.p_partkey AND e.tag NOT LIKE 'Pop!%' AND e.tag NOT LIKE '%Exclusive%'), 'old') AS setTag,
 CASE r.p_partkey % 4 WHEN 0 THEN 'Naruto' WHEN 1 THEN 'Harry Potter' ELSE 'old' END AS franchiseSuggestion, CASE WHEN r.p_partkey % 5 = 0 THEN 'own' WHEN r.p_partkey % 2 = 0 THEN 'Pop! Harry Potter' WHEN r.p_partkey % 4 = 1 THEN 'Pop! Harry Potter' ELSE '' END AS category,
 coalesce(array_to_string(CASE WHEN tags IS NULL AND r.p_partkey % 5 > 0 AND (r.p_partkey % 2 = 0 OR r.p_partkey % 4 = 1) THEN ['Pop! Harry Potter'] ELSE tags END, ';'), '') AS series FROM r""")
def q_derive_grouping(spark, sf):
    k, m = c("p_partkey"), c("p_size") % 3
    series = F.when(m == 1, F.array(F.lit("Pop! X"), F.concat("p_brand", F.lit(" Mystery Box")))).when(m == 2, F.array(F.lit("Exclusive Mystery Box"), F.concat("p_type", F.lit(" Gift Set")), F.concat("p_brand", F.lit(" Mystery Box"))))
    rows = read(spark, sf, "part").select(
        k.alias("_ord"), series.alias("series"), F.lit("old").alias("setTag"), F.lit("old").alias("franchiseSuggestion"), F.when(k % 5 == 0, "own").otherwise("").alias("category"),
        F.when(k % 4 == 0, "Naruto. Animation").when(k % 4 == 2, "Walmart").otherwise("").alias("pcSeries"), F.when(k % 2 == 0, "funko-pop-harry-potter").alias("console"),
        F.when(k % 4 == 1, "https://x/game/funko-pop-harry-potter/a-1").when(k % 4 == 3, "https://x/game/other/a").alias("pricechartingUrl"),
    )
    out = derive.grouping(rows)
    return out.select(c("_ord").alias("p_partkey"), "setTag", "franchiseSuggestion", "category", F.coalesce(F.array_join("series", ";"), F.lit("")).alias("series"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'F' || p_size ELSE 'old' END AS franchise, CASE WHEN p_partkey % 3 = 0 THEN 'S' END AS funkoSection, CASE WHEN p_partkey % 3 < 2 THEN true END AS franchiseChecked,
 CASE WHEN p_size % 2 = 0 THEN 'own' WHEN p_partkey % 3 = 0 THEN 'Pop! Vinyl;F' || p_size ELSE '' END AS series FROM part""")
def q_shop_details(spark, sf):
    k = c("p_partkey")
    rows = read(spark, sf, "part").select(
        k.alias("_ord"), "p_size", F.lit("old").alias("franchise"), F.lit(None).cast("string").alias("funkoSection"), F.lit(None).cast("boolean").alias("franchiseChecked"),
        F.when(c("p_size") % 2 == 0, F.array(F.lit("own"))).when(c("p_size") % 4 == 1, F.array().cast("array<string>")).alias("series"),
    )
    crumb = lambda i, name: page('{"position":', F.lit(i), ',"item":{"name":"', name, '"}}')
    body = page(crumb(3, page("F", c("p_size"))), ",", crumb(1, "Shop"), ",", crumb(2, "S"))
    found = page('<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[', body, "]}</script>")
    trails = rows.filter(k_mod("_ord", 3) < 2).select("_ord", html.breadcrumbs(F.when(k_mod("_ord", 3) == 0, found).otherwise("<p>no trail</p>")).alias("crumbs"))
    return derive.shop_details(rows, trails).select(c("_ord").alias("p_partkey"), "franchise", "funkoSection", "franchiseChecked", F.coalesce(F.array_join("series", ";"), F.lit("")).alias("series"))


def k_mod(name: str, n: int) -> Column:
    return c(name) % n


def _search_tables(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, what searches for them gave, and detail pages, from the parts.

    A part's number decides: 0 is found by its code, 1 by the number of its title, 2 by its verified number
    (its first row is no figure, its second a variant), 3 by its name alone, 4 not at all.
    """
    p, k = read(spark, sf, "part"), c("p_partkey")
    m, some = k % 5, lambda cond, v: F.when(cond, v).otherwise("")
    code = F.lpad(k.cast("string"), 12, "0")
    name = page("Figure ", k)
    rows = p.select(
        k.alias("_ord"), name.alias("title"), some(m == 0, code).alias("upc"), some(m == 2, page("No. ", c("p_size"))).alias("funkoNumber"), some(m == 1, page(c("p_size"))).alias("funkoNumberFromTitle"),
        some(k % 7 == 0, "5.00").alias("marketValueLoose"), *(F.lit("").alias(f) for f in ("marketValueComplete", "marketValueNew", "pricechartingId", "pricechartingUrl", "priceCheckedAt", "priceSource")),
        F.lit(None).cast("boolean").alias("marketValueIsApproximate"), *(some(k % 2 == 0, "own").alias(f) if f == "publisher" else F.lit(None).cast("string").alias(f) for f in V.META_LABELS.values() if f not in ("upc", "funkoNumber")),
    )
    asked = F.when(m == 0, code).when(m.isin(1, 2), page(name, " #", c("p_size"), " funko")).when(m == 3, page(name, " funko")).otherwise(page("nothing"))
    cents = lambda n: page(F.lit(n), ".", F.lpad((k % 100).cast("string"), 2, "0"))
    item = lambda pos, text, console, n: F.struct(F.lit(pos).alias("pos"), text.alias("name"), F.lit(console).alias("console"), page("id", F.lit(n), "-", k).alias("id"), page("/g/", F.lit(n), "-", k).alias("href"), cents(n).alias("loose"), F.when(k % 3 == 0, cents(n + 1)).alias("complete"), F.lit(None).cast("string").alias("mint"))
    found = F.array(item(0, name, "playstation-5", 1), item(1, page(name, " (Chrome)"), "funko-pop-games", 2), item(2, name, "funko-pop-games", 3))
    listings = p.select(asked.alias("query_key"), F.inline(F.when(m == 0, F.slice(found, 2, 1)).otherwise(found)))
    details = p.filter(m < 3).select(
        page("/g/3-", k).alias("href"), cents(9).alias("loose"), F.lit(None).cast("string").alias("complete"), F.when(k % 4 == 0, cents(8)).alias("mint"), F.when(k % 2 == 0, page("https://d/", k)).alias("url"),
        F.create_map(F.lit("Publisher"), F.lit("Funko"), F.lit("Box Number"), page("#", k)).alias("labels"), F.lit(2).alias("_ord"),
    )
    # every page landed before, with other prices, and again the same
    before = details.withColumns({"loose": F.lit("7.77"), "mint": F.lit("7.77"), "url": F.lit("https://old"), "_ord": F.lit(1)})
    return rows, listings, details.unionByName(before).unionByName(details.filter(k_mod("_ord", 2) == 0))


_NOW = "TIMESTAMP '2024-05-06 07:08:09.123'"


@query("""
WITH p AS (SELECT *, p_partkey AS k, p_partkey % 5 AS m, lpad((p_partkey % 100)::VARCHAR, 2, '0') AS cc, p_partkey % 7 = 0 AS priced FROM part),
-- a code's one row is a variant and is taken; by name the plain figure is
r AS (SELECT *, m < 4 AND (NOT priced OR m > 0) AS hit, m IN (1, 2) AS paged FROM p)
SELECT k AS p_partkey, CASE WHEN NOT hit THEN CASE WHEN priced THEN '5.00' ELSE '' END WHEN m = 0 THEN '2.' || cc WHEN paged THEN '9.' || cc ELSE '3.' || cc END AS marketValueLoose,
  CASE WHEN hit AND k % 3 = 0 THEN CASE WHEN m = 0 THEN '3.' ELSE '4.' END || cc ELSE '' END AS marketValueComplete, CASE WHEN hit AND paged AND k % 4 = 0 THEN '8.' || cc ELSE '' END AS marketValueNew,
  CASE WHEN NOT hit THEN '' WHEN m = 0 THEN 'id2-' || k ELSE 'id3-' || k END AS pricechartingId, CASE WHEN NOT hit THEN '' WHEN m = 0 THEN '/g/2-' || k WHEN paged AND k % 2 = 0 THEN 'https://d/' || k ELSE '/g/3-' || k END AS pricechartingUrl,
  CASE WHEN hit THEN '2024-05-06T07:08:09.123Z' ELSE '' END AS priceCheckedAt, CASE WHEN hit THEN 'pricecharting' ELSE '' END AS priceSource, NULL::BOOLEAN AS approximate,
  CASE WHEN m = 2 THEN 'No. ' || p_size WHEN hit AND paged THEN k::VARCHAR ELSE '' END AS funkoNumber, CASE WHEN k % 2 = 0 THEN 'own' WHEN hit AND paged THEN 'Funko' ELSE '' END AS publisher FROM r""")
def q_pricing_pass(spark, sf):
    rows, listings, details = _search_tables(spark, sf)
    out = pricing.price(rows, listings, details, F.expr(_NOW))
    return out.select(c("_ord").alias("p_partkey"), "marketValueLoose", "marketValueComplete", "marketValueNew", "pricechartingId", "pricechartingUrl", "priceCheckedAt", "priceSource", c("marketValueIsApproximate").alias("approximate"), "funkoNumber", "publisher")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'upc' ELSE 'title' END AS matched_by, CASE WHEN p_partkey % 5 = 0 THEN 'id2-' ELSE 'id3-' END || p_partkey AS id, true AS ok, CASE WHEN p_partkey % 5 = 0 THEN 'upc' ELSE 'base' END AS reason FROM part WHERE p_partkey % 5 < 4""")
def q_listing_match(spark, sf):
    rows, listings, _ = _search_tables(spark, sf)
    out = match.match_listings(rows.select("_ord", "title", "upc", "funkoNumber", "funkoNumberFromTitle"), listings)
    return out.select(c("_ord").alias("p_partkey"), "matched_by", "id", "match.ok", "match.reason")


@query("""
WITH p AS (SELECT *, p_partkey AS k, lpad((p_partkey % 100)::VARCHAR, 2, '0') AS cc FROM part WHERE p_partkey % 5 > 0 AND p_partkey % 6 > 0)
SELECT 'pc-id3-' || k AS handle, 'Figure ' || k AS title, 'pricecharting' AS funkoSource, '3.' || cc AS marketValueLoose, CASE WHEN k % 3 = 0 THEN '4.' || cc END AS marketValueComplete,
 CASE WHEN k % 5 < 3 AND k % 4 = 0 THEN '8.' || cc END AS marketValueNew, CASE WHEN k % 5 < 3 THEN 'Funko' END AS publisher FROM p""")
def q_discover(spark, sf):
    _, listings, details = _search_tables(spark, sf)
    known = read(spark, sf, "part").filter(c("p_partkey") % 6 == 0).select(page("id3-", c("p_partkey")).alias("pricechartingId"))
    rows = listings.filter("pos = 2 and id is not null").withColumn("_ord", F.regexp_extract("id", r"(\d+)$", 1).cast("long"))
    out = pricing.discover(known, rows, details)
    return out.select("handle", "title", "funkoSource", "marketValueLoose", "marketValueComplete", "marketValueNew", "publisher")
