"""Landed pages to rows: flat cases as column expressions, nested ones by the page's tree."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.functions import text as X
from shelfmark.sources.tree import Layouts, Node, parse

MONEY = re.compile(V.MONEY)


def money(text: str | None) -> str | None:
    """The first dollar amount, without commas."""
    m = MONEY.search(text or "")
    return m[1].replace(",", "") if m else None


def grade(text: str | None) -> str | None:
    """As money, for a price between 0 and 100,000."""
    value = float(money(text) or 0)
    return f"{value:.2f}" if 0 < value <= 100000 else None


def clean_price(raw: str) -> str:
    """The last dollar amount of a text that tells of a reduction, else the first; "" if none."""
    found = [re.sub("[^0-9.]", "", m) for m in re.findall(r"\$\s*[0-9]+\.[0-9]{2}", raw)]
    return "" if not found else found[-1] if re.search(r"reduced|off|\bto\b", raw, re.IGNORECASE | re.ASCII) else found[0]


#: Ways in which a product tile has been marked up; the first that a page has is its way.
TILE_TESTS = (
    lambda n: n.has("product-tile"),
    lambda n: n.has("b-product-tile"),
    lambda n: "data-pid" in n.attrs,
    lambda n: n.has("product-grid-item"),
    lambda n: n.tag == "article" and n.has("product"),
    lambda n: "data-product-id" in n.attrs or "data-itemid" in n.attrs,
)


def _some(n: Node | None, *names: str) -> str:
    """The first attribute of these that says something."""
    return next((v for k in names if n is not None and (v := n.attrs.get(k))), "")


def _tile(n: Node, base: str) -> dict | None:
    named = n.first(lambda k: k.tag in ("h2", "h3") or k.has("product-name", "b-product-tile__name", "product-title"))
    title = (named.raw() if named else "") or _some(n, "data-name", "aria-label")
    if not title:
        return None
    link = n.first(lambda k: k.tag == "a" and "/products/" in k.attrs.get("href", "")) or n.first(lambda k: k.tag == "a")
    href = _some(link, "href")
    _, found, path = href.partition("/products/")
    handle = re.split(r"[?/]", path.partition("/products/")[0])[0] if found else ""
    priced = n.first(lambda k: "price" in k.attrs.get("class", ""))
    gone = n.first(lambda k: k.has("unavailable", "sold-out") or "out-of-stock" in k.attrs.get("class", ""))
    category = _some(n, "data-category") or "".join(k.content() for k in n.find(lambda k: k.has("breadcrumb") or "category" in k.attrs.get("class", "")))
    return {
        "pid": _some(n, "data-pid", "data-product-id", "data-itemid"), "handle": handle or href.rpartition("/")[2], "title": title,
        "price": clean_price((priced.raw() if priced else "") or _some(n, "data-price")), "available": gone is None, "series": [s.strip() for s in re.split(r"[,|>/]", category) if s.strip()],
        "productUrl": href if not href or href.startswith("http") else base + href,
        "funkoPrimaryImage": _some(n.first(lambda k: k.tag == "img"), "src", "data-src", "data-lazy"), "funkoSource": V.SHOP_SOURCE,
    }


def tiles(page: str | None, base: str = V.SHOP_BASE) -> list[dict] | None:
    """Product tiles; None where no markup of a tile was met, which is not the same as no product."""
    root = parse(page)
    found = next((hits for t in TILE_TESTS if (hits := root.find(t))), None)
    return None if found is None else [t for n in found if (t := _tile(n, base))]


def short_tiles(page: str | None) -> list[dict] | None:
    """Tiles with what tells them apart only: pid, handle and title."""
    found = tiles(page)
    return None if found is None else [{k: t[k] for k in ("pid", "handle", "title")} for t in found]


def _listing_parts(root: Node) -> tuple[list[int], list[str | None]]:
    """For each row of the table's body its links (address and title), cells of title and fourth to sixth cell; the shape is the links' number."""
    table = root.first(lambda n: n.attrs.get("id") == "games_table")
    links, out = [], []
    for tr in table.tagged("tr") if table else ():
        if not tr.within("tbody", table):
            continue
        below = tr.tagged("a", "td")
        found = [n for n in below if n.tag == "a" and "href" in n.attrs]
        cells = [n for n in below if n.tag == "td"]
        links.append(len(found))
        for n in found:
            out += (n.attrs["href"], n.attrs.get("title", ""))
        out.append("".join([c.content() for c in cells if c.has("title")]))
        out += [cells[i].content() if i < len(cells) else None for i in (3, 4, 5)]
    return links, out


_listings = Layouts(_listing_parts)


def listing_rows(page: str | None, base: str = V.PRICED_BASE) -> list[dict]:
    """Rows of the listing table's body that link to an item."""
    links, found = _listings.of(page)
    out, at = [], 0
    for n in links:
        end = at + 2 * n
        link = next((i for i in range(at, end, 2) if "/game/" in found[i]), None)
        at = end + 4
        if link is None:
            continue
        href = found[link]
        slug = next((p for p in reversed(href.split("/")) if p), href)
        console = re.search("/game/([^/]+)/", href)
        worth = [money(text) for text in found[end + 1 : at]]
        out.append({
            "id": found[link + 1].strip() or slug, "name": " ".join(found[end].split()), "console": console[1] if console else "", "href": href if href.startswith("http") else base + href,
            "loose": worth[0], "complete": worth[1], "mint": worth[2],
        })
    return out


PRICES = {"used_price": "loose", "complete_price": "complete", "new_price": "mint"}


def _detail_parts(root: Node) -> tuple[None, list[str | None]]:
    """Texts of the three prices, the canonical address, and label and value of each row of two cells or more."""
    first: dict[str, Node] = {}
    canonical = None
    rows = []
    for n in root.walk():
        if n.tag == "tr":
            rows.append(n)
        if n.attrs:
            if (name := n.attrs.get("id")) in PRICES and name not in first:
                first[name] = n
            if canonical is None and n.tag == "link" and n.attrs.get("rel") == "canonical":
                canonical = n
    out = [first[name].content() if name in first else None for name in PRICES]
    out.append(canonical.attrs.get("href") if canonical is not None else None)
    for tr in rows:
        cells = tr.tagged("td")
        if len(cells) > 1:
            out += (cells[0].content(), cells[1].content())
    return None, out


_details = Layouts(_detail_parts)


def detail(page: str | None) -> dict:
    """Prices, canonical address and labelled rows of a detail page; the last of a repeated label wins."""
    found = _details.of(page)[1]
    out = {k: grade(text) for k, text in zip(PRICES.values(), found)}
    labels = {}
    for i in range(4, len(found), 2):
        label, value = " ".join(found[i].split()), " ".join(found[i + 1].split())
        if label.endswith(":") and value and value.lower() not in ("none", "n/a"):
            labels[label[:-1].strip()] = value
    return out | {"url": found[3] or None, "labels": labels}


def _reference_field(label: str) -> str | None:
    exact = {"hdbid": "hdbid", "upc": "upc"}
    if label in exact or label.startswith("reference"):
        return exact.get(label, "funkoNumber")
    return next((field for word, field in V.SKU_LABELS.items() if word in label), None)


def reference_numbers(page: str | None) -> dict | None:
    """Labelled numbers of a reference page under their fields, or None if there is none; a later label wins."""
    out: dict[str, str] = {}
    for strong in parse(page).find(lambda n: n.tag == "strong"):
        label = re.sub(":\\Z", "", strong.content()).strip()
        box = strong
        while box is not None and not box.has("spaced-field", "col-md-6"):
            box = box.parent
        if not label or box is None:
            continue
        shown = box.first(lambda n: n.has("ng-binding"))
        value = shown.raw() if shown else ""
        if not value:  # the label itself may be the box: what stands after it then
            kids = [k for k in strong.parent.kids if isinstance(k, Node)]
            after = [k for k in kids[kids.index(strong) + 1 :] if k.has("ng-binding")]
            value = after[0].raw() if after else ""
        field = _reference_field(label.lower())
        if not value or value == label or len(value) >= 50 or value == "-" or field is None:
            continue
        if field != "funkoNumber" or re.fullmatch("[0-9]{1,6}", value):
            out[field] = value
    for field, pattern in (("upc", r"_nkw=([0-9]{10,13})"), ("hdbid", r"itemId=([0-9]+)")):
        if not out.get(field) and (m := re.search(pattern, page or "")):
            out[field] = m[1]
    return out or None


def read_pages(pages: DataFrame, reader: Callable[[str | None], list[dict] | dict | None], schema: str, key: str = "page_id", partitions: int | None = None) -> DataFrame:
    """Rows that ``reader`` gets from each page, with the page's key and the row's place in it.

    Parsing costs far more than moving a page, so pages of too few splits are spread over ``partitions`` first.
    """
    names = [f.split()[0] for f in re.split(r",\s*(?![^<]*>)", schema)]
    kinds = pages.sparkSession.createDataFrame([], schema).schema
    arrow = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "map<string,string>": pa.map_(pa.string(), pa.string())}
    types = [arrow[f.dataType.simpleString()] for f in kinds.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, page in zip(batch.column(key).to_pylist(), batch.column("html").to_pylist()):
                got = reader(page)
                rows += [(k, i, r) for i, r in enumerate(got if isinstance(got, list) else [got] if got else [])]
            value = lambda r, n: list(r[n].items()) if isinstance(r.get(n), dict) else r.get(n)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], batch.column(key).type), pa.array([r[1] for r in rows], pa.int32()), *(pa.array([value(r[2], n) for r in rows], t) for n, t in zip(names, types))], [key, "pos", *names])

    kind = dict(pages.dtypes)[key]
    if partitions:
        pages = pages.repartition(partitions)
    return pages.select(key, "html").mapInArrow(run, f"{key} {kind}, pos int, {schema}")


# Flat cases, in the plan


def page_title(page: Column) -> Column:
    return F.regexp_extract(X.blank(page), "(?is)<title[^>]*>(.*?)</title>", 1)


def links(page: Column) -> Column:
    return F.regexp_extract_all(X.blank(page), F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), 1)


def subject_tags(page: Column) -> Column:
    """Texts of subject links whose address ends in ``-series``, in order, once each; null if none."""
    found = F.regexp_extract_all(X.blank(page), F.lit(r'(?is)<a\s[^>]*?href="[^"]*/subjects/[^"]*(?<=-series)"[^>]*>(.*?)</a>'), 1)
    tags = F.array_distinct(F.filter(F.transform(found, lambda t: X.trim(X.sub(t, "<[^>]*>"))), lambda t: t != ""))
    return F.when(F.size(tags) > 0, tags)


def meta_fields(labels: Column) -> dict[str, Column]:
    """The fields that a detail page's labels stand for; a code, number or date that is none is null."""
    value = {field: F.nullif(F.try_element_at(labels, F.lit(label)), F.lit("")) for label, field in V.META_LABELS.items()}
    shaped = {"upc": X.normalise_upc(value["upc"]), "funkoNumber": F.when(value["funkoNumber"].isNotNull(), X.digits(value["funkoNumber"])), "releaseDate": X.release_date(value["releaseDate"])}
    return {f: F.nullif(shaped.get(f, v), F.lit("")) for f, v in value.items()}


def breadcrumbs(page: Column) -> Column:
    """``array<struct<position, name, url>>`` of the first breadcrumb list; blocks of bad JSON are passed over."""
    blocks = F.regexp_extract_all(X.blank(page), F.lit(r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>'), 1)
    crumb = "struct<`@type`:string,itemListElement:array<struct<position:int,name:string,item:struct<name:string,`@id`:string>>>>"
    read = lambda b: F.when(F.ltrim(b).startswith("["), F.from_json(b, f"array<{crumb}>")).otherwise(F.array(F.from_json(b, crumb)))
    lists = F.filter(F.flatten(F.transform(blocks, read)), lambda x: x["@type"] == "BreadcrumbList")
    one = F.get(lists, F.lit(0))["itemListElement"]
    return F.array_sort(F.transform(one, lambda e: F.struct(e["position"].alias("position"), F.coalesce(e["item"]["name"], e["name"]).alias("name"), e["item"]["@id"].alias("url"))))


def franchise_of(crumbs: Column) -> Column:
    """Struct (section, franchise) of a trail of three crumbs or more."""
    # through a one-element array, so that the trail is parsed once and not for each use
    made = lambda x: F.when(F.size(x) >= 3, F.struct(F.get(x, F.lit(1))["name"].alias("section"), F.get(x, F.lit(2))["name"].alias("franchise")))
    return F.get(F.transform(F.array(crumbs), made), F.lit(0))


def facet_vocabulary(pages: DataFrame, page: Column, key: str) -> DataFrame:
    """``(key, dim, name, count)``: the first count of each name of a dimension."""
    rx = r"(?i)Refine by (Fandom|License|Series):\s*(.+?)\s*\((\d[\d,]*)\)"
    got = [F.regexp_extract_all(X.blank(page), F.lit(rx), i) for i in (1, 2, 3)]
    z = pages.select(key, F.posexplode(F.arrays_zip(*(g.alias(n) for g, n in zip(got, ("d", "n", "c"))))).alias("pos", "z"))
    rows = z.select(key, "pos", F.lower("z.d").alias("dim"), F.trim("z.n").alias("name"), X.sub(F.col("z.c"), ",").cast("int").alias("count")).filter("name <> ''")
    return rows.groupBy(key, "dim", "name").agg(F.min_by("count", "pos").alias("count"))


def console_slugs(page: Column, known: Column | None = None) -> Column:
    """Set slugs on a page in order of first sight, then known ones (by default the fixed list) not seen."""
    known = F.array(*map(F.lit, V.CONSOLE_SLUGS)) if known is None else known
    return F.array_union(F.array_distinct(F.regexp_extract_all(X.blank(page), F.lit(r"/console/(funko-pop-[a-z0-9-]+)"), 1)), known)


def declared_total(page: Column, patterns: tuple[str, ...] = V.SHOP_TOTALS, none: int = -1) -> Column:
    """The number of rows that a page says there are, by the first pattern that it has."""
    found = [F.nullif(X.sub(F.regexp_extract(X.blank(page), "(?i)" + p, 1), ","), F.lit("")) for p in patterns]
    return F.coalesce(F.coalesce(*found).try_cast("int"), F.lit(none))


def has_content(rows: Column, total: Column) -> Column:
    return (rows > 0) | (total >= 0)
