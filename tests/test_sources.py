import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from shelfmark.sources import catalog, html
from shelfmark.streaming.resume import run_new_files

LISTING = """<table id="games_table"><tbody><tr><td><a href="/game/funko-pop-rides/x-12" title="77">p</a></td><td class="title"><a href="/game/funko-pop-rides/x-12">X #12</a></td><td>c</td><td>$1,010.50</td><td></td><td>$5.00</td></tr><tr><td>no link</td></tr></tbody></table>"""
DETAIL = """<link rel="canonical" href="https://x/y"><span id="used_price">$ 3.10</span><span id="new_price">$0.00</span><table><tr><td>UPC:</td><td>123</td></tr><tr><td>UPC:</td><td>456</td></tr><tr><td>Publisher:</td><td>none</td></tr><tr><td>Bad</td><td>x</td></tr></table>"""
TILES = """<div class="product-tile" data-pid="P1"><a href="/products/goku?x=1"><img src="/i.png"></a><div class="product-name">Pop! Goku</div><span class="price">$11.99</span><span class="category">Anime | Z</span></div><div class="product-tile" data-pid="P2"><span class="sold-out">x</span><a href="/p/vegeta">See</a><h3>Vegeta</h3></div><div class="product-tile" data-pid="P3"></div>"""
REFERENCE = """<div class="spaced-field"><strong>UPC:</strong><span class="ng-binding">8498-030</span></div><div class="spaced-field"><strong>Reference #:</strong><span class="ng-binding">27</span></div><div class="col-md-6"><strong>Other:</strong><span class="ng-binding">-</span></div><a href="?itemId=99">x</a>"""


def test_readers():
    row = {"id": "77", "name": "X #12", "console": "funko-pop-rides", "href": "https://p.example/game/funko-pop-rides/x-12", "loose": "1010.50", "complete": None, "mint": "5.00"}
    assert html.listing_rows(LISTING, "https://p.example") == [row]
    d = html.detail(DETAIL)
    assert (d["loose"], d["complete"], d["mint"], d["url"], d["labels"]) == ("3.10", None, None, "https://x/y", {"UPC": "456"})
    t = html.tiles(TILES, "https://shop.example")
    assert [(x["pid"], x["handle"], x["title"], x["price"], x["available"], x["series"]) for x in t] == [("P1", "goku", "Pop! Goku", "11.99", True, ["Anime", "Z"]), ("P2", "vegeta", "Vegeta", "", False, [])]
    assert t[0]["productUrl"] == "https://shop.example/products/goku?x=1" and t[0]["funkoPrimaryImage"] == "/i.png"
    assert html.tiles("<p>none</p>") is None and html.tiles(None) is None and html.tiles('<i data-pid="1"></i>') == []
    assert html.short_tiles(TILES)[1] == {"pid": "P2", "handle": "vegeta", "title": "Vegeta"}
    assert html.reference_numbers(REFERENCE) == {"upc": "8498-030", "funkoNumber": "27", "hdbid": "99"}
    assert html.reference_numbers("<p></p>") is None


def test_pages_to_rows(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, None), (3, "<table id='games_table'></table>")], "page_id long, html string")
    got = html.read_pages(pages, html.listing_rows, "id string, name string, console string, loose string").collect()
    assert [tuple(r) for r in got] == [(1, 0, "77", "X #12", "funko-pop-rides", "1010.50")]
    got = html.read_pages(spark.createDataFrame([(1, DETAIL)], "page_id long, html string"), html.detail, "loose string, labels map<string,string>").collect()
    assert got[0]["labels"] == {"UPC": "456"}


def test_reading_pages_starts_no_job(spark):
    spark.sparkContext.setJobGroup("lazy", "none")
    pages = spark.createDataFrame([(1, LISTING)] * 50, "page_id long, html string").groupBy("page_id").agg(F.max("html").alias("html"))
    made = html.read_pages(pages, html.listing_rows, "id string", partitions=3)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
    assert made.count() == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_current_version(spark, tmp_path):
    folder = str(tmp_path / "versions")
    assert catalog.read_latest(spark, folder) is None
    rows = lambda n: spark.range(n)
    catalog.write_versioned(rows(1), folder)
    with ThreadPoolExecutor(4) as pool:  # all are kept, and each commit has a number of its own
        paths = list(pool.map(lambda n: catalog.write_versioned(rows(n), folder), (2, 3, 4, 5)))
    pointers = sorted(p.name for p in (tmp_path / "versions" / "_current").iterdir() if not p.name.startswith("."))
    assert pointers == [f"{i:012d}" for i in range(1, 6)] and len(set(paths)) == 4
    now = catalog.read_latest(spark, folder).count()
    assert now in (2, 3, 4, 5)
    # a writer that stops before its commit, and one that stops within it, change nothing
    rows(9).write.parquet(f"{folder}/v-lost")
    (tmp_path / "versions" / "_current" / f"{6:012d}").write_text("")
    assert catalog.read_latest(spark, folder).count() == now
    catalog.write_versioned(rows(7), folder)
    assert catalog.read_latest(spark, folder).count() == 7


def test_flat_cases(spark):
    crumb = '<script type="application/ld+json">{bad</script><script type="application/ld+json">[{"@type":"X"},{"@type":"BreadcrumbList","itemListElement":[{"position":3,"item":{"name":"Z"}},{"position":1,"name":"H"},{"position":2,"name":"S"}]}]</script>'
    page = crumb + '<a href="/subjects/1-one-series">One</a><a href="/subjects/2-two-series"> Two </a><a href="/subjects/1-one-series">One</a><a href="/subjects/3-series-x">no</a> of 1,204 items\nRefine by Fandom: Animation (1,204)\nRefine by Fandom: Animation (7)\nRefine by Series: S (3)'
    df = spark.createDataFrame([(1, page), (2, None)], "k long, h string")
    f = html.franchise_of(html.breadcrumbs(F.col("h")))
    got = df.orderBy("k").select(f["franchise"], html.subject_tags(F.col("h")), html.declared_total(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("Z", ["One", "Two"], 1204), (None, None, -1)]
    assert sorted(tuple(r)[1:] for r in html.facet_vocabulary(df, F.col("h"), "k").collect()) == [("fandom", "Animation", 1204), ("series", "S", 3)]


def test_catalog_files(spark, tmp_path):
    rows = [{"handle": "a", "funkoNumber": 12}, {"handle": "b", "upc": "1", "series": ["x"]}]
    (tmp_path / "in.json").write_text(json.dumps(rows))
    df = catalog.read_catalog(spark, str(tmp_path / "in.json"))
    assert [(r["_ord"], r["handle"], r["funkoNumber"]) for r in df.collect()] == [(0, "a", "12"), (1, "b", None)]
    base = str(tmp_path / "in.json")
    (tmp_path / "base.json").write_text("[]")
    assert catalog.choose_source(spark, str(tmp_path / "base.json"), base) == base
    assert catalog.choose_source(spark, base, str(tmp_path / "none.json")) == base
    assert catalog.read_optional(spark, str(tmp_path / "none.json"), catalog.CATALOG).isEmpty()
    assert catalog.write_delta(df.limit(0), str(tmp_path)) is None
    catalog.write_catalog(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    (tmp_path / "done.json").write_text('["s1", "s2"]')
    assert {r["key"] for r in catalog.read_done(spark, str(tmp_path / "done.json")).collect()} == {"s1", "s2"}
    (tmp_path / "bad.json").write_text("{nope")
    assert catalog.read_done(spark, str(tmp_path / "bad.json")).isEmpty()


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b", ["x"]), (0, "a", None)], "_ord long, handle string, series array<string>")
    catalog.write_json_array(rows, str(tmp_path / "array"))
    catalog.write_json_array(rows.limit(0), str(tmp_path / "empty"))
    text = lambda d: "".join(p.read_text() for p in sorted((tmp_path / d).glob("part-*")))
    assert json.loads(text("array")) == [{"handle": "a"}, {"handle": "b", "series": ["x"]}] and json.loads(text("empty")) == []
    done = str(tmp_path / "d.json")
    for keys in (["s1", "s2"], ["s3", "s3", None]):
        catalog.write_done(spark.createDataFrame([(k,) for k in keys], "key string"), done)
        assert {r["key"] for r in catalog.read_done(spark, done).collect()} == {k for k in keys if k}
    assert not catalog.clear_done(spark, done, complete=False) and not catalog.read_done(spark, done).isEmpty()
    assert catalog.clear_done(spark, done, complete=True) and catalog.read_done(spark, done).isEmpty()
    names = spark.createDataFrame([("fandom", "A", 3), ("fandom", "B", 1), ("license", "C", 2)], "dim string, name string, count int")
    catalog.write_vocabulary(names, str(tmp_path / "facets"), 2925, "2024-01-01T00:00:00Z")
    got = json.loads(text("facets"))
    assert got == {"source": "https://www.funko.com", "harvestedAt": "2024-01-01T00:00:00Z", "unfilteredTotal": 2925, "counts": {"fandom": 2, "license": 1, "series": 0}, "vocabulary": {"fandom": {"A": 3, "B": 1}, "license": {"C": 2}, "series": {}}}
    catalog.write_vocabulary(names.limit(0), str(tmp_path / "nothing"), -1, "t")
    assert json.loads(text("nothing"))["vocabulary"] == {"fandom": {}, "license": {}, "series": {}}
    catalog.write_vocabulary(names.filter("dim = 'license'").withColumn("name", F.lit('a "b" \\ é')), str(tmp_path / "odd"), 1, "t")
    assert json.loads(text("odd"))["vocabulary"] == {"fandom": {}, "license": {'a "b" \\ é': 2}, "series": {}}
    judged = rows.withColumn("dropped", F.col("handle") == "a")
    catalog.write_split(judged, str(tmp_path / "kept"), str(tmp_path / "gone"))
    assert [r["handle"] for r in spark.read.json(str(tmp_path / "kept")).collect()] == ["b"]
    version = catalog.write_versioned(rows, str(tmp_path / "versions"))
    assert version != catalog.write_versioned(rows, str(tmp_path / "versions")) and spark.read.parquet(version).count() == 2
    assert spark.read.json(catalog.write_delta(rows, str(tmp_path / "delta"))).count() == 2


def test_stream_resumes(spark, tmp_path):
    src = tmp_path / "src"
    args = (str(src), "id long", lambda b: b.withColumn("twice", F.col("id") * 2), str(tmp_path / "out"), str(tmp_path / "chk"))
    from pyspark.sql import types as T

    args = (args[0], T.StructType([T.StructField("id", T.LongType())]), *args[2:])
    for i in range(2):
        spark.range(i * 5, i * 5 + 5).write.mode("append").parquet(str(src))
        run_new_files(spark, *args).awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["twice"] for r in got.collect()) == [2 * i for i in range(10)]


def test_console_slugs_unite_with_the_fixed_list(spark):
    pages = spark.createDataFrame([('<a href="/console/funko-pop-new"><a href="/console/funko-pop-zodiac">',), (None,)], "h string")
    new, none = (r[0] for r in pages.select(html.console_slugs(F.col("h"))).collect())
    assert len(none) == 109 and none[0] == "funko-pop-8-bit" and none[-1] == "funko-pop-zodiac"
    assert new == ["funko-pop-new", "funko-pop-zodiac", *none[:-1]]
