import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import text as X
from shelfmark.operators import derive, incremental, match, merge, predicates
from shelfmark.operators.graph import components
from shelfmark.plans import catalog_queries as Q
from shelfmark.plans import postprocess
from shelfmark.sources.catalog import CATALOG

c = F.col


def catalog(spark, rows):
    names = [f.name for f in CATALOG.fields]
    return spark.createDataFrame([(i, *(r.get(n) for n in names)) for i, r in enumerate(rows)], "_ord long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATALOG.fields))


def out(df, *names):
    return [tuple(r) for r in df.orderBy("_ord").select(*names).collect()]


GATE = [
    ("Freddy Frostbear", "Baseball Freddy #1", False, False),
    ("Piccolo (Metallic)", "Orange Piccolo #1", False, False),
    ("Robin (Chase)", "Robin as Nightwing", False, False),
    ("Krillin (Metallic)", "Krillin #110", True, True),
    ("Twinkie The Kid (Glow In The Dark)", "Twinkie the Kid [Chase GITD] #27", False, False),
    ("Twinkie the Kid (Metallic)", "Twinkie the Kid [Metallic] #27", True, False),
    ("Twinkie the Kid", "Twinkie the Kid [Chase] #27", False, False),
    ("Twinkie the Kid", "Twinkie the Kid #27", True, False),
    ("Piccolo", "Orange Piccolo #1", True, False),
]


def test_gate(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(GATE)], "_ord long, a string, b string")
    got = out(df.withColumn("g", match.gate(c("a"), c("b"))), "g.ok", "g.approximate")
    assert got == [g[2:] for g in GATE]
    strict = df.filter("_ord = 8").select(match.gate(c("a"), c("b"), strict_base=True)["ok"]).first()[0]
    upc = df.filter("_ord = 0").select(match.gate(c("a"), c("b"), F.lit("upc"))["ok"]).first()[0]
    assert strict is False and upc is True


def test_scores(spark):
    rows = [("[Metallic] #27", 18), ("#27", 8), ("[Metallic] #31", 7), ("[Chase] #27", 4)]
    df = spark.createDataFrame([(i, "Twinkie the Kid " + r) for i, (r, _) in enumerate(rows)], "_ord long, b string")
    assert [s for (s,) in out(df.select("_ord", match.score(F.lit("Twinkie the Kid (Metallic)"), F.lit("27"), c("b")).alias("s")), "s")] == [s for _, s in rows]


def sequential(base, incoming):
    import re

    key = lambda t: re.sub("[^a-z0-9]+", " ", (t or "").lower()).strip()
    handles, titles, out = {}, {}, {}
    for o, h, t in base:
        if h:
            handles[h.lower()] = ("base", o)
        if key(t):
            titles[key(t)] = ("base", o)
    for o, h, t in incoming:
        hit = (h and handles.get(h.lower())) or (key(t) and titles.get(key(t)))
        if hit:
            out[o] = hit
        else:
            out[o] = ("append", o)
            if h:
                handles[h.lower()] = ("new", o)
            if key(t):
                titles[key(t)] = ("new", o)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_one_pass(spark, seed):
    rng = random.Random(seed)
    pick = lambda p, n: rng.choice([None, "", *(f"{p}{i}" for i in range(n))])
    base = [(i, pick("h", 12), pick("t", 12)) for i in range(10)]
    new = [(i, pick("h", 25), pick("t", 25)) for i in range(60)]
    s = "_ord long, handle string, title string"
    got = match.assign_upsert(spark.createDataFrame(new, s), spark.createDataFrame(base, s)).collect()
    assert {r["_ord"]: (r["kind"], r["target"]) for r in got} == sequential(base, new)


@pytest.mark.parametrize("rounds,replay", [(10, 10_000), (2, 5), (2, 0)])
def test_upsert_of_one_component_of_all_rows(spark, monkeypatch, rounds, replay):
    monkeypatch.setattr(match, "ROUNDS", rounds)
    monkeypatch.setattr(match, "REPLAY", replay)
    rng = random.Random(9)
    chain = [(2 * i + k, f"h{i + k}", f"t{i}") for i in range(12) for k in (0, 1)]  # each row shares a key with the next
    hot = [(100 + i, "hot", f"t{rng.randrange(40)}") for i in range(80)]
    new = [*chain, *hot, *((200 + i, f"h{rng.randrange(30)}", rng.choice(["hot title", f"t{rng.randrange(60)}"])) for i in range(80))]
    base = [(0, "h3", "t7"), (1, "b", "hot title")]
    s = "_ord long, handle string, title string"
    got = match.assign_upsert(spark.createDataFrame(new, s), spark.createDataFrame(base, s)).collect()
    assert len(got) == len(new) and {r["_ord"]: (r["kind"], r["target"]) for r in got} == sequential(base, new)


def test_changed_rows(spark):
    s = "_ord long, handle string, title string, price string, pid string, note string, series array<string>, tags array<string>"
    base = [(0, "a", "A", "", "p", "x", ["s"], []), (1, "b", "B", "5", "", None, None, ["k"])]
    new = [(0, "a", "", "7", "", "x", ["s"], ["m"]), (1, "a", "", "8", "", None, ["s"], ["n"]), (2, "a", "", "", "q", "x", None, None), (3, "a", "", "", "q", "y", ["s", "t"], None)]
    new += [(4, "a", "", "", "", "y", ["t"], None), (5, "b", "", "6", "", None, None, None), (6, "n", "N", "", "", None, None, None), (7, "n", "", "1", "", None, None, None)]
    policy = {"price": "falsy", "pid": "overwrite", "note": "defined", "series": "union", "tags": "if_empty"}
    got = match.upsert_changes(spark.createDataFrame(base, s), spark.createDataFrame(new, s), policy).collect()
    assert sorted((r["_ord"], r["kind"], r["changed"]) for r in got) == [(0, "base", True), (1, "base", False), (2, "base", True), (3, "base", True), (4, "base", False), (5, "base", False), (6, "append", False), (7, "new", True)]


def test_upsert_fixtures(spark):
    s = "_ord long, handle string, title string, price string"
    new = spark.createDataFrame([(0, "h1", "T1", ""), (1, "h1", "T2", "2"), (2, "h2", "T1", "3"), (3, "h3", "T2", "4")], s)
    got = match.upsert(spark.createDataFrame([(0, "b", "T9", "")], s), new, {"price": "falsy"})
    assert out(got, "handle", "price") == [("b", ""), ("h1", "2"), ("h3", "4")]
    new = spark.createDataFrame([(0, "h5", "T5", ""), (1, "h5", "T9", "7")], s)
    got = match.upsert(spark.createDataFrame([(0, "b", "T9", "")], s), new, {"price": "falsy"})
    assert out(got, "handle", "price") == [("b", ""), ("h5", "7")]


def test_handle_merge(spark):
    df = catalog(spark, [
        {"handle": "h", "title": "A", "price": "", "series": ["A", "B"]}, {"handle": "", "title": "x"}, {"handle": "h", "title": "B", "price": "9.99", "series": ["B", "C"]},
        {"handle": "h", "price": "8.88", "available": False}, {"handle": "", "title": "y"},
    ])
    assert out(merge.merge_by_handle(df), "title", "price", "series", "available") == [("A", "9.99", ["A", "B", "C"], None), ("x", None, None, None), ("y", None, None, None)]


def test_filter_goes_before_merge(spark):
    df = catalog(spark, [{"handle": "h", "title": "R", "series": ["Pop! Ad Icons"]}, {"handle": "h", "title": "R", "series": ["Wacky Wobblers"]}])
    assert merge.merge_by_handle(predicates.drop_non_pops(df)).count() == 1
    assert predicates.drop_non_pops(merge.merge_by_handle(df)).count() == 0


def test_fuzzy_dedupe(spark):
    pc = {"funkoSource": "pricecharting", "marketValueLoose": "5.00"}
    df = catalog(spark, [
        {"title": "Shaak Ti", "funkoNumber": "853"}, {"title": "Shaak Ti #853"} | pc, {"title": "Goku", "funkoNumber": "9"}, {"title": "Goku Black #9"} | pc,
        {"title": "Other", "funkoNumber": "9"}, {"title": "Same Name"}, {"title": "Same Name"} | pc, {"title": "Moved Off", "funkoNumberFromTitle": "77"}, {"title": "Moved Off #77"} | pc,
    ])
    assert out(match.blocked_dedupe(df), "_ord", "marketValueLoose") == [(0, "5.00"), (2, None), (3, "5.00"), (4, None), (5, None), (6, "5.00"), (7, "5.00")]
    assert [o for (o,) in out(match.blocked_dedupe(df, from_title=False, fallback_exact=True), "_ord")] == [0, 2, 3, 4, 5, 7]


def test_title_dedupe(spark):
    df = catalog(spark, [{"title": "A", "series": ["Mystery Minis"]}, {"title": "A", "funkoSource": "funko.com", "price": "1"}, {"title": "B", "funkoSource": "funko.com", "price": "2"}, {"title": "b!", "series": []}])
    assert out(match.title_dedupe(df), "_ord", "price") == [(0, None), (1, "1"), (3, "2")]


def test_new_ids(spark):
    found = spark.createDataFrame([(0, "shaak-ti-853"), (1, "x-854"), (2, "y-854")], "_ord long, id string")
    known = spark.createDataFrame([("853",)], "id string")
    assert out(match.new_ids(found, known), "id") == [("x-854",)]
    assert len(out(match.new_ids(found, known, tail_tolerant=False), "id")) == 3


def test_set_tag_and_facets(spark):
    df = spark.createDataFrame([(0, ["Pop! X", "A Mystery Box", "B Mystery Box"]), (1, ["A Mystery Box"]), (2, ["A Mystery Box", "C Mystery Box", "D Mystery Box"])], "_ord long, series array<string>")
    assert out(derive.rarest_tag(df, "_ord"), "set_tag") == [("B Mystery Box",), ("A Mystery Box",), ("C Mystery Box",)]
    cat = catalog(spark, [{"handle": "h1", "title": "Pop! Foo Bar"}, {"handle": "h2", "title": "Other", "funkoFandom": ["X"]}])
    tags = spark.createDataFrame([("foo bar", ["F"], None, []), ("h2", ["F"], ["L"], []), ("none", ["Z"], [], [])], "key string, fandom array<string>, license array<string>, series_tags array<string>")
    assert out(match.facet_join(cat, tags), "funkoFandom", "funkoLicense") == [(["F"], None), (["X", "F"], ["L"])]


def test_incremental(spark):
    now = F.expr("timestamp '2026-06-01 00:00:00'")
    df = spark.createDataFrame([(0, "2026-03-03T00:00:00Z"), (1, "2026-03-02T00:00:00Z"), (2, None), (3, "garbage")], "_ord long, at string")
    assert [s for (s,) in out(df.select("_ord", incremental.stale(c("at"), now, 90).alias("s")), "s")] == [False, True, True, True]
    assert df.filter(incremental.stale(c("at"), now, 0)).isEmpty()
    rows = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(18)] + [("c", 1)], "k string, i int")
    t = spark.createDataFrame([("a", 20, False), ("b", 20, False), ("c", 0, False), ("d", 0, False), ("b2", 1, True)], "k string, target int, failed boolean")
    assert {r["k"]: r["done"] for r in incremental.complete_sets(rows, t, "k").collect()} == {"a": False, "b": True, "c": True, "d": False, "b2": False}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_postprocess_runs_in_order_and_settles(spark):
    df = catalog(spark, [
        {"handle": "a", "title": "Funko Pop! Shaak Ti", "funkoNumber": "853", "series": ["Pop! Star Wars"]}, {"handle": "b", "title": "Shaak Ti #853", "funkoSource": "pricecharting", "marketValueNew": "12.00"},
        {"handle": "c", "title": "Cup of X"}, {"handle": "d", "title": "Batman #12 (Chase)", "pricechartingUrl": "https://x/game/funko-pop-heroes/batman-12", "price": "Price reduced from $14.99 to $4.50"},
        {"handle": "d", "title": "Batman", "upc": "849803097097"},
    ])
    once = postprocess.run(df)
    cols = ["handle", "title", "funkoNumberFromTitle", "price", "upc", "marketValueNew", "category", "priceSource"]
    want = [("a", "Shaak Ti", None, None, None, "12.00", None, "pricecharting"), ("d", "Batman (Chase)", "12", "4.50", "849803097097", None, "Pop! Heroes", "none")]
    assert out(once, *cols) == want
    assert out(postprocess.run(once), *cols) == want


def test_short_tokens(spark):
    rows = [("a b", "a b c", True), ("a", "a b", False), ("a b c", "b a", True), ("a b", "a c", False)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(rows)], "_ord long, a string, b string")
    assert [x for (x,) in out(df.select("_ord", match.short_tokens_shared(c("a"), c("b")).alias("x")), "x")] == [r[2] for r in rows]
    assert df.select(X.id_tail(F.lit("a-12"))).first()[0] == "12"


def test_listings_by_code_then_title(spark):
    recs = catalog(spark, [{"title": "Goku", "upc": "849803097097"}, {"title": "Goku (Metallic)", "upc": "889698123456"}, {"title": "Krillin (Metallic)", "funkoNumber": "110"}, {"title": "Nobody"}])
    rows = [
        ("849803097097", "Other #1", "funko-pop-x", 0), ("889698123456", "Goku #2", "funko-pop-x", 0), ("889698123456", "Goku [Metallic] #2", "funko-pop-x", 1),
        ("Krillin #110 funko", "Krillin #110", "funko-pop-x", 1), ("Krillin #110 funko", "Krillin [Metallic] #110", "games", 0), ("Nobody funko", "Somebody Else", "funko-pop-x", 0),
    ]
    got = match.match_listings(recs, spark.createDataFrame(rows, "query_key string, name string, console string, pos int"))
    assert out(got, "_ord", "name", "matched_by", "match.ok", "match.approximate") == [
        (0, "Other #1", "upc", True, False), (1, "Goku [Metallic] #2", "upc-multi", True, False), (2, "Krillin #110", "title", True, True), (3, "Somebody Else", "title", False, False),
    ]


def test_reports(spark):
    from shelfmark.operators import report
    from shelfmark.sources.catalog import merge_report

    df = catalog(spark, [{"title": "A #1", "upc": "849803097097", "marketValueLoose": "1.00"}, {"title": "B"}, {"title": "C", "marketValueNew": "2.00", "handle": "pc-c"}])
    cov = report.catalog_coverage(df).first()
    assert (cov["total"], cov["priced"], cov["unpriced_neither"], cov["priced_no_upc"], cov["priced_pct"]) == (3, 2, 1, 1, "66.7%")
    audit = report.audit(df, c("handle").startswith("pc-")).first()
    assert (audit["priced"], audit["upc"], audit["priced_no_upc"], audit["discovered"], audit["discovered_upc"]) == (2, 1, 1, 1, 0)
    counts = report.audit(df, F.lit(False))
    assert report.converged(counts, counts).first()["converged"] is True
    rows, seen = report.observed(df, "seen", priced=predicates.has_price(c("marketValueLoose"), c("marketValueComplete"), c("marketValueNew")))
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 3, "priced": 2}
    pairs = spark.createDataFrame([(0, 1)], "_ord long, target long")
    assert [tuple(r) for r in merge_report(pairs, df, df).collect()] == [(None, "A #1", "B")]


def test_best_rows_that_are_level_go_by_place(spark):
    rows = [(k, lead * 100 + k, score) for k in range(200) for lead, score in ((0, 9), (1, 10), (10, 19))]
    got = match.best_rows(spark.createDataFrame(rows, "k int, pos long, score int"), "k").select("k", "pos").collect()
    assert {(r["k"], r["pos"]) for r in got} == {(k, k) for k in range(200)}


def test_best_row_query_equals_sql_where_rows_are_level(spark, tmp_path):
    import duckdb

    rows = [(102_300 + g + 100 * i, "n", g, "t", f"b{i}") for g in range(100) for i in (0, 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int, p_type string, p_brand string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    want = sorted(con.execute(Q.ORACLES["q_best_row"]).fetchall())
    assert sorted(map(tuple, Q.q_best_row(spark, str(tmp_path)).collect())) == want


@pytest.mark.parametrize("seed,brands,types,lack", [(0, 3, 2, 0), (1, 40, 40, 0), (2, 5, 3, 0.3), (3, 1, 1, 0), (4, 300, 2, 0.1)])
def test_best_row_query_meets_few_rows_of_a_group(spark, tmp_path, monkeypatch, seed, brands, types, lack):
    import duckdb

    rng = random.Random(seed)
    pick = lambda p, n: None if rng.random() < lack else f"{p}{rng.randrange(n)}"
    keys = [None if rng.random() < lack / 5 else rng.choice([i, 50 * i, 7]) for i in range(400)]  # some twice, some missing
    rows = [(k, pick("n", 1), 5, pick("t", types), pick("b", brands)) for k in keys]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int, p_type string, p_brand string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    order = lambda r: tuple((v is None, v or 0) for v in r)
    met, best = [], match.best_rows
    monkeypatch.setattr(match, "best_rows", lambda x, *a: (met.append(x.count()), best(x, *a))[1])
    got = sorted(map(tuple, Q.q_best_row(spark, str(tmp_path)).collect()), key=order)
    assert got == sorted(con.execute(Q.ORACLES["q_best_row"]).fetchall(), key=order)
    assert met[0] <= 5 * len(rows)


def test_rarest_tag_counts_tags_once_and_moves_no_row_by_its_tag(spark):
    rows = [(1, ["a gift set", "b gift set"]), (2, ["b gift set", "a gift set", "pop! x"]), (3, ["b gift set"]), (4, ["pop! x"]), (5, None), (6, ["c gift set", "b gift set", "c gift set"])]
    df = derive.rarest_tag(spark.createDataFrame(rows, "k int, series array<string>").repartition(3, "k"), "k")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate ") == 1 and "BroadcastHashJoin" in plan
    assert {tuple(r) for r in df.collect()} == {(1, "a gift set"), (2, "a gift set"), (3, "b gift set"), (6, "c gift set")}
