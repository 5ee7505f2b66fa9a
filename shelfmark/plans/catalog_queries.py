"""The catalog operators applied to the driver's tables, each beside its SQL.

The tables hold no catalog, so queries build titles, codes and tags from their columns; what is
checked is the operator, under its own name. SQL strings are written apart from the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.functions import text as X
from shelfmark.operators import derive, incremental, match, merge, predicates, report
from shelfmark.sources import html
from shelfmark.streaming import resume  # noqa: F401  (part of the surface)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
c = F.col


def query(sql: str | None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL pieces that several oracles share
def n1(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def core(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({x}), '#\s*\d+[a-z]?', ' ', 'g'), '\[[^\]]*\]', ' ', 'g'), '\b(bottle opener|box|pop! protector)\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


VARIANT_SQL = rf"list_filter(list_transform(flatten(list_transform(regexp_extract_all({{x}}, '[\(\[]([^\)\]]*)[\)\]]', 1), lambda p: string_split_regex(p, '\s+'))), lambda w: regexp_replace(lower(w), '[^a-z0-9]', '', 'g')), lambda w: w <> '' AND w NOT IN ({quoted(V.VARIANT_STOPWORDS)}))"
CORE_SQL = rf"list_filter(string_split_regex(lower(regexp_replace(regexp_replace(regexp_replace({{x}}, '[\(\[][^\)\]]*[\)\]]', ' ', 'g'), '#\s*\d+', ' ', 'g'), '(?i)funko\s+pop.*', ' ')), '[^a-z0-9]+'), lambda w: w <> '' AND w NOT IN ({quoted(V.NAME_STOPWORDS)}))"
NO_ZEROS = "coalesce(nullif(regexp_replace({x}, '^0+', ''), ''), '0')"


@query(f"SELECT p_partkey, {n1('p_name')} AS title_key, {n1(chr(39) + 'Pop! ' + chr(39) + ' || p_name')} AS with_line, {n1('p_name')} AS facet_key, p_name || ' ' || p_type AS clean FROM part")
def q_normalise_title(spark, sf):
    p = read(spark, sf, "part")
    return p.select("p_partkey", X.normalise_title(c("p_name")).alias("title_key"), X.normalise_title(F.concat(F.lit("Pop! "), "p_name")).alias("with_line"), X.facet_title(F.concat(F.lit("Pop! "), "p_name")).alias("facet_key"), X.sanitise(F.concat(F.lit("  "), "p_name", F.lit(" \n "), "p_type", F.lit(" "))).alias("clean"))


@query(f"SELECT doc_id, {n1('text')} AS title_key FROM documents")
def q_normalise_text(spark, sf):
    return read(spark, sf, "documents").select("doc_id", X.normalise_title(c("text")).alias("title_key"))


NUMBERED = "p_name || ' #' || p_size || ' (' || p_type || ')'"


@query(rf"""SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 = 0 THEN {NO_ZEROS.format(x="lpad(p_size::VARCHAR, 4, '0')")} END, {NO_ZEROS.format(x="p_size::VARCHAR")}) AS number,
 regexp_extract({NUMBERED}, '\s*#(\d{{1,6}})\b', 1) AS in_title, trim(regexp_replace(regexp_replace({NUMBERED}, '\s*#\d{{1,6}}\b', ''), '\s{{2,}}', ' ', 'g')) AS rest FROM part""")
def q_extract_number(spark, sf):
    p = read(spark, sf, "part")
    title = F.expr(NUMBERED)
    verified = F.when(c("p_partkey") % 3 == 0, F.lpad(c("p_size").cast("string"), 4, "0"))
    return p.select("p_partkey", X.number_of(verified, title).alias("number"), X.number_in_title(title).alias("in_title"), X.without_number(title).alias("rest"))


@query("SELECT c_custkey, c_name AS rest, CAST(NULL AS VARCHAR) AS in_title, coalesce(nullif(regexp_replace(regexp_extract(c_name, '#(\\d+)', 1), '^0+', ''), ''), '0') AS number FROM customer")
def q_number_guard(spark, sf):
    t = read(spark, sf, "customer")
    return t.select("c_custkey", X.without_number(c("c_name")).alias("rest"), X.number_in_title(c("c_name")).alias("in_title"), X.number_of(F.lit(None), c("c_name")).alias("number"))


DECODED = r"replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')".replace('\\"', '"')


@query(rf"SELECT page_id, trim(regexp_replace(regexp_replace({DECODED}, '(?i)^(Funko\s+)?Pop!?\s+', ''), '\s{{2,}}', ' ', 'g')) AS title FROM pages")
def q_clean_title(spark, sf):
    return read(spark, sf, "pages").select("page_id", X.clean_title(html.page_title(c("html"))).alias("title"))


@query(r"""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN printf('%.2f', p_retailprice * 0.5) ELSE printf('%.2f', p_retailprice) END AS price, p_partkey % 2 = 0 AS dirty FROM part""")
def q_clean_price(spark, sf):
    amount = lambda k: F.format_string("$%.2f", c("p_retailprice") * k)
    raw = F.when(c("p_partkey") % 2 == 0, F.concat(F.lit("Price reduced from "), amount(1.0), F.lit("\n to "), amount(0.5), F.lit(" (50% off)"))).otherwise(amount(1.0))
    return read(spark, sf, "part").select("p_partkey", X.clean_price(raw).alias("price"), X.dirty_price(raw).alias("dirty"))


UPC_RAW = "CASE WHEN o_orderkey % 4 = 0 THEN lpad(CAST(o_orderkey * 7919 AS {s}), 12, '0') WHEN o_orderkey % 4 = 1 THEN lpad(CAST(o_orderkey AS {s}), 11, '0') || ', ' || lpad(CAST(o_orderkey * 31 AS {s}), 13, '8') WHEN o_orderkey % 4 = 2 THEN '12345678 ' || lpad(CAST(o_orderkey AS {s}), 6, '0') ELSE CAST(o_orderkey AS {s}) END"


@query(rf"""WITH r AS (SELECT o_orderkey, {UPC_RAW.format(s='VARCHAR')} AS raw FROM orders),
u AS (SELECT *, coalesce(list_filter(regexp_extract_all(raw, '\d+'), lambda g: length(g) IN (12, 13))[1], CASE WHEN length(regexp_replace(raw, '\D', '', 'g')) >= 12 THEN left(regexp_replace(raw, '\D', '', 'g'), 12) END) AS upc FROM r)
SELECT o_orderkey, upc, CASE WHEN upc IS NULL THEN false WHEN length(upc) = 13 THEN true ELSE (10 - list_sum(list_transform(range(1, 12), lambda i: substr(upc, i, 1)::INT * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END)) % 10) % 10 = substr(upc, 12, 1)::INT END AS valid,
 regexp_full_match(trim(raw), '\d{{11,13}}') AS usable FROM u""")
def q_upc(spark, sf):
    t = read(spark, sf, "orders").select("o_orderkey", F.expr(UPC_RAW.format(s="STRING")).alias("raw")).withColumn("upc", X.normalise_upc(c("raw")))
    return t.select("o_orderkey", "upc", X.valid_upc(c("upc")).alias("valid"), X.usable_upc(c("raw")).alias("usable"))


TITLED = "p_name || ' (' || p_type || ' In The Dark) [' || p_brand || ' Edition] Box #' || p_size"


@query(f"SELECT p_partkey, array_to_string({VARIANT_SQL.format(x=TITLED)}, ' ') AS variants, array_to_string({CORE_SQL.format(x=TITLED)}, ' ') AS core_words, {core(TITLED)} AS core, {core('regexp_replace(' + TITLED + chr(44) + chr(39) + '[(][^)]*[)]' + chr(39) + chr(44) + chr(39) + ' ' + chr(39) + chr(44) + chr(39) + 'g' + chr(39) + ')')} AS core_plain, trim(p_name || ' Box') || ' #' || p_size || ' funko' AS search FROM part")
def q_name_keys(spark, sf):
    t = F.expr(TITLED)
    return read(spark, sf, "part").select("p_partkey", F.array_join(X.variant_tokens(t), " ").alias("variants"), F.array_join(X.core_tokens(t), " ").alias("core_words"), X.core_name(t).alias("core"), X.core_no_parens(t).alias("core_plain"), X.search_query(t, c("p_size").cast("string")).alias("search"))


CLASSED = "CASE p_partkey % 8 WHEN 0 THEN 'Pop! Rides  Deluxe ' || p_name WHEN 1 THEN 'Pop! ' || p_name || ' with Pop! Protector' WHEN 2 THEN 'Pop! Pin-Up ' || p_name WHEN 3 THEN 'Pop! Tote ' || p_name WHEN 4 THEN p_name WHEN 5 THEN 'Pop! ' || p_name || ' Pin' WHEN 6 THEN 'Pop! Super ' || p_name ELSE 'Bitty Pop ' || p_name END"


@query(rf"""WITH t AS (SELECT p_partkey, trim(regexp_replace(trim({CLASSED}), '(?i)\s+with Pop!\s*Protector\s*$', '')) AS t FROM part),
k AS (SELECT *, regexp_matches(t, '(?i)^pop!') AND NOT regexp_matches(t, '(?i)\b({V.DROP_LINES})\b') AND NOT regexp_matches(t, '(?i)\b({V.ACCESSORY_KEYWORDS})\b') AND NOT regexp_matches(t, '(?i)\b({V.ACCESSORY_STANDALONE})\b([^-]|$)') AS ok,
 trim(regexp_replace(regexp_extract(t, '(?i)^Pop!\s+(((Rides Deluxe|Rides|Deluxe|Super|Jumbo|Moments|Moment|Premium|Plus|Towns|Town|Nooks|Comic Cover|Cover|Album|Die-Cast|Movie Poster|Gamerverse|Pez)\s+)+)', 1), '\s+', ' ', 'g')) AS st FROM t)
SELECT p_partkey, CASE WHEN ok THEN coalesce(nullif(st, ''), 'Standard') END AS pop_type,
 CASE WHEN ok THEN trim(regexp_replace(t, '(?i)^Pop!\s+((Rides Deluxe|Rides|Deluxe|Super|Jumbo|Moments|Moment|Premium|Plus|Towns|Town|Nooks|Comic Cover|Cover|Album|Die-Cast|Movie Poster|Gamerverse|Pez)\s+)*', '')) END AS name FROM k""")
def q_classify(spark, sf):
    t = read(spark, sf, "part").select("p_partkey", predicates.classify(F.expr(CLASSED)).alias("k"))
    return t.select("p_partkey", c("k.popType").alias("pop_type"), c("k.name").alias("name"))


GOODS = "CASE p_partkey % 5 WHEN 0 THEN p_name || ' mug' WHEN 1 THEN p_name || ' capped' WHEN 2 THEN p_name || ' Tee' WHEN 3 THEN 'Pop and Tee ' || p_name ELSE p_name END"


@query(rf"""SELECT p_partkey FROM (SELECT p_partkey, p_size, {GOODS} AS title, CASE WHEN p_size % 4 = 0 THEN 'Pop! Tees ' || p_type WHEN p_size % 4 = 1 THEN 'Pop! and Shirt Pack' ELSE p_type END AS tag, CASE WHEN p_size % 7 = 0 THEN 'x' ELSE '' END AS src FROM part)
WHERE src <> '' OR NOT (regexp_matches(title, '(?i)\b({V.NON_POP_TITLE_WORDS})\b') OR contains(lower(tag), 'pop! tees') OR (contains(lower(tag), 'and shirt pack') AND NOT regexp_matches(title, '(?i)\bpop and (shirt|tee)\b|\band (shirt|tee) (pack|set)\b')))""")
def q_drop_other_goods(spark, sf):
    p = read(spark, sf, "part")
    tag = F.when(c("p_size") % 4 == 0, F.concat(F.lit("Pop! Tees "), "p_type")).when(c("p_size") % 4 == 1, "Pop! and Shirt Pack").otherwise(c("p_type"))
    rows = p.select("p_partkey", F.expr(GOODS).alias("title"), F.array(tag).alias("series"), F.when(c("p_size") % 7 == 0, "x").otherwise("").alias("funkoSource"))
    return predicates.drop_non_pops(rows).select("p_partkey")


@query(rf"SELECT page_id, url <> '' AND NOT regexp_matches(url, '(?i)_Mugs_[0-9a-f]{{6,}}') AS figure FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '/x_Mugs_' || substr(md5(page_id::VARCHAR), 1, 8) || '.jpg' WHEN page_id % 3 = 1 THEN '' ELSE url END AS url FROM pages)")
def q_image_filter(spark, sf):
    p = read(spark, sf, "pages")
    url = F.when(c("page_id") % 3 == 0, F.concat("url", F.lit("/x_Mugs_"), F.substring(F.md5(c("page_id").cast("string").cast("binary")), 1, 8), F.lit(".jpg"))).when(c("page_id") % 3 == 1, "").otherwise(c("url"))
    return p.select("page_id", predicates.is_figure_image(url).alias("figure"))


@query("SELECT p_name, count(*) AS n_rows, sum((listed)::INT)::BIGINT AS listed, sum((listed AND p_size % 5 <> 0)::INT)::BIGINT AS dropped FROM (SELECT *, p_name IN ('red bolt', 'small ring', 'no such thing') AS listed FROM part) GROUP BY p_name")
def q_denylist(spark, sf):
    p = read(spark, sf, "part")
    signal = predicates.has_signal(F.when(c("p_size") % 5 == 0, c("p_size").cast("string")), F.lit(None), F.lit(None), F.lit(None))
    out = predicates.denylist(p, c("p_name"), signal, ("red bolt", "small ring", "no such thing"))
    return out.groupBy("p_name").agg(F.count("*").alias("n_rows"), F.count_if("listed").alias("listed"), F.count_if("dropped").alias("dropped"))


@query("""SELECT min(p_partkey) AS _ord, p_name AS handle, arg_min(p_type, p_partkey) AS title,
 coalesce(arg_min(p_brand, p_partkey) FILTER (WHERE p_size % 3 = 0), '') AS upc, array_to_string(list_transform(list_sort(list_distinct(list(p_type))), lambda x: x), ',') AS tags FROM part GROUP BY p_name""")
def q_handle_merge(spark, sf):
    p = read(spark, sf, "part").select(c("p_partkey").alias("_ord"), c("p_name").alias("handle"), c("p_type").alias("title"), F.when(c("p_size") % 3 == 0, c("p_brand")).otherwise("").alias("upc"), F.array("p_type").alias("series"))
    out = merge.merge_by_handle(p)
    return out.select("_ord", "handle", "title", "upc", F.array_join(F.array_sort("series"), ",").alias("tags"))


@query("""SELECT p_partkey, CASE WHEN t1 = '' THEN p_brand ELSE t1 END AS falsy, CASE WHEN t1 = '' THEN p_brand ELSE t1 END AS blank, p_brand AS overwrite, p_size % 2 = 0 AS flag,
 CASE WHEN t2 THEN true ELSE p_size > 25 END AS flag_falsy, t2 AS flag_blank, CASE WHEN p_type = 'SMALL' THEN 'SMALL,SMALL' ELSE 'SMALL,' || p_type END AS unioned, CASE WHEN p_type = 'SMALL' THEN 'SMALL,SMALL' ELSE 'SMALL,SMALL,' || p_type END AS appended
FROM (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS t1, p_partkey % 4 = 0 AS t2 FROM part)""")
def q_merge_policies(spark, sf):
    p = read(spark, sf, "part")
    held = F.array(F.lit("SMALL"), F.lit("SMALL"))
    t = p.select(c("p_partkey").alias("k"), F.when(c("p_partkey") % 3 == 0, "").otherwise(c("p_name")).alias("falsy"), (c("p_partkey") % 4 == 0).alias("flag_falsy"), held.alias("unioned"))
    t = t.withColumns({"blank": c("falsy"), "overwrite": c("falsy"), "flag": F.lit(None).cast("boolean"), "flag_blank": c("flag_falsy"), "appended": held})
    s = p.select(c("p_partkey").alias("k"), c("p_brand").alias("falsy"), c("p_brand").alias("blank"), c("p_brand").alias("overwrite"), (c("p_size") % 2 == 0).alias("flag"), (c("p_size") > 25).alias("flag_falsy"), (c("p_size") > 25).alias("flag_blank"), F.array("p_type").alias("unioned"), F.array("p_type").alias("appended"))
    joined = t.alias("t").join(s.alias("s"), "k")
    made = merge.merge_columns(joined, {"falsy": "falsy", "blank": "blank", "overwrite": "overwrite", "flag": "defined", "flag_falsy": "falsy", "flag_blank": "blank", "unioned": "union", "appended": "append"})
    return joined.select(c("k").alias("p_partkey"), *((F.array_join(v, ",") if k in ("unioned", "appended") else v).alias(k) for k, v in made.items()))


@query(f"""WITH b AS (SELECT p_partkey AS o, lower(p_name || p_size) AS h, {n1('p_brand')} AS t FROM part WHERE p_partkey % 2 = 0),
h AS (SELECT h, max(o) AS o FROM b GROUP BY h), t AS (SELECT t, max(o) AS o FROM b GROUP BY t)
SELECT p.p_partkey, h.o AS by_handle, t.o AS by_title, coalesce(h.o, t.o) AS at FROM part p LEFT JOIN h ON h.h = lower(p.p_name || p.p_size) LEFT JOIN t ON t.t = {n1('p.p_brand')} WHERE p.p_partkey % 2 = 1""")
def q_two_key_lookup(spark, sf):
    p = read(spark, sf, "part").select(c("p_partkey").alias("_ord"), F.concat("p_name", c("p_size").cast("string")).alias("handle"), c("p_brand").alias("title"))
    out = match.two_key_lookup(p.filter("_ord % 2 = 1"), p.filter("_ord % 2 = 0"))
    return out.select(c("_ord").alias("p_partkey"), "by_handle", "by_title", "at")


_UPSERT_SQL = rf"""
WITH RECURSIVE p AS (SELECT p_partkey AS o, p_name || p_size AS handle, p_name || p_type || p_brand AS title, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS price, p_brand AS tag FROM part),
k AS (SELECT *, lower(handle) AS h, {n1('title')} AS t FROM p),
bh AS (SELECT h, max(o) AS at FROM k WHERE o % 3 <> 0 GROUP BY h), bt AS (SELECT t, max(o) AS at FROM k WHERE o % 3 <> 0 GROUP BY t),
i AS (SELECT k.*, bh.at AS by_h, bt.at AS by_t, row_number() OVER (ORDER BY o) AS n FROM k LEFT JOIN bh USING (h) LEFT JOIN bt USING (t) WHERE o % 3 = 0),
walk AS (
  SELECT 0::BIGINT AS n, []::VARCHAR[] AS hs, []::VARCHAR[] AS ts, []::BIGINT[] AS ats, NULL::BIGINT AS o, NULL::VARCHAR AS kind, NULL::BIGINT AS target
  UNION ALL
  SELECT n, CASE WHEN kind = 'append' THEN list_append(hs, h) ELSE hs END, CASE WHEN kind = 'append' THEN list_append(ts, t) ELSE ts END, CASE WHEN kind = 'append' THEN list_append(ats, o) ELSE ats END, o, kind,
    CASE WHEN kind = 'append' THEN o WHEN by_h IS NOT NULL THEN by_h WHEN list_contains(hs, h) THEN ats[list_position(hs, h)] WHEN by_t IS NOT NULL THEN by_t ELSE ats[list_position(ts, t)] END
  FROM (SELECT i.*, hs, ts, ats, CASE WHEN by_h IS NOT NULL THEN 'base' WHEN list_contains(hs, h) THEN 'new' WHEN by_t IS NOT NULL THEN 'base' WHEN list_contains(ts, t) THEN 'new' ELSE 'append' END AS kind
        FROM walk w JOIN i ON i.n = w.n + 1)),
plan AS (SELECT o, kind, target FROM walk WHERE n > 0), u AS (SELECT plan.*, p.price, p.tag FROM plan JOIN p USING (o) WHERE kind <> 'append')"""


@query(_UPSERT_SQL + """,
top AS (SELECT max(o) + 1 AS top FROM p WHERE o % 3 <> 0), s AS (SELECT target, arg_min(price, o) FILTER (WHERE price <> '') AS price FROM u GROUP BY target),
tags AS (SELECT target, string_agg(tag, ',' ORDER BY o) AS tags FROM (SELECT u.target, u.tag, min(u.o) AS o FROM u JOIN p ON p.o = u.target AND p.tag <> u.tag GROUP BY ALL) GROUP BY target)
SELECT p.o + CASE WHEN p.o % 3 = 0 THEN top ELSE 0 END AS _ord, handle, title, CASE WHEN p.price = '' THEN coalesce(s.price, '') ELSE p.price END AS price, tag || coalesce(',' || tags, '') AS tags
FROM p, top LEFT JOIN s ON s.target = p.o LEFT JOIN tags ON tags.target = p.o WHERE p.o % 3 <> 0 OR p.o IN (SELECT o FROM plan WHERE kind = 'append')""")
def q_upsert(spark, sf):
    """A sequential upsert: later rows see what earlier ones appended."""
    base, new = _upsert_rows(spark, sf)
    return match.upsert(base, new, {"price": "falsy", "series": "union"}).select("_ord", "handle", "title", "price", F.array_join("series", ",").alias("tags"))


@query(_UPSERT_SQL + """
SELECT plan.o AS p_partkey, kind, plan.target, kind <> 'append' AND (
  (t.price = '' AND p.price <> '' AND NOT EXISTS (SELECT 1 FROM u WHERE u.target = plan.target AND u.o < plan.o AND u.price <> ''))
  OR (t.tag <> p.tag AND NOT EXISTS (SELECT 1 FROM u WHERE u.target = plan.target AND u.o < plan.o AND u.tag = p.tag))) AS changed
FROM plan JOIN p USING (o) JOIN p t ON t.o = plan.target""")
def q_upsert_changes(spark, sf):
    """Which incoming rows changed a row, and what each of them did."""
    base, new = _upsert_rows(spark, sf)
    return match.upsert_changes(base, new, {"price": "falsy", "series": "union"}).withColumnRenamed("_ord", "p_partkey")


def _upsert_rows(spark, sf) -> tuple[DataFrame, DataFrame]:
    price = F.when(c("p_partkey") % 4 == 0, "").otherwise(c("p_type"))
    p = read(spark, sf, "part").select(c("p_partkey").alias("_ord"), F.concat("p_name", c("p_size").cast("string")).alias("handle"), F.concat("p_name", "p_type", c("p_brand")).alias("title"), price.alias("price"), F.array("p_brand").alias("series"))
    return p.filter("_ord % 3 <> 0"), p.filter("_ord % 3 = 0")


@query(rf"""WITH r AS (SELECT p_partkey AS o, p_name || ' ' || p_type AS title, CASE WHEN p_partkey % 5 = 0 THEN 'shop' ELSE '' END AS src, p_brand AS pid, CASE WHEN p_size % 6 = 0 THEN 'Mystery' ELSE 'Pop! ' || p_type END AS tag FROM part),
t AS (SELECT {n1('title')} AS k, max(o) AS o, arg_max(tag, o) AS tag FROM r WHERE src = '' GROUP BY 1),
m AS (SELECT r.o, t.o AS target, r.pid FROM r JOIN t ON t.k = {n1('r.title')} AND regexp_matches(t.tag, '(?i)^(funko )?pop') WHERE r.src <> '')
SELECT r.o AS p_partkey, r.title, coalesce(CASE WHEN g.target IS NOT NULL THEN 'shop' END, r.src) AS src, coalesce(g.pid, CASE WHEN r.src <> '' THEN r.pid ELSE '' END) AS pid
FROM r LEFT JOIN (SELECT target, arg_min(pid, o) AS pid FROM m GROUP BY target) g ON g.target = r.o WHERE r.o NOT IN (SELECT o FROM m)""")
def q_title_dedupe(spark, sf):
    p = read(spark, sf, "part")
    shop = c("p_partkey") % 5 == 0
    rows = p.select(c("p_partkey").alias("_ord"), F.concat("p_name", F.lit(" "), "p_type").alias("title"), F.when(shop, "shop").otherwise("").alias("funkoSource"), F.when(shop, c("p_brand")).otherwise("").alias("pid"), F.array(F.when(c("p_size") % 6 == 0, "Mystery").otherwise(F.concat(F.lit("Pop! "), "p_type"))).alias("series"), F.lit(None).cast("boolean").alias("available"))
    return match.title_dedupe(rows).select(c("_ord").alias("p_partkey"), "title", c("funkoSource").alias("src"), "pid")


def _fuzzy_rows(spark, sf) -> DataFrame:
    p = read(spark, sf, "part")
    src = c("p_partkey") % 3 == 0
    title = F.when(src, F.concat("p_name", F.lit(" ("), "p_type", F.lit(") #"), (c("p_partkey") % 100).cast("string"))).otherwise(F.concat("p_name", F.lit(" "), "p_type"))
    number = F.when(~src & (c("p_partkey") % 7 != 0), (c("p_partkey") % 100).cast("string"))
    return p.select(c("p_partkey").alias("_ord"), F.concat(F.lit("h"), c("p_partkey").cast("string")).alias("handle"), title.alias("title"), number.alias("funkoNumber"), F.lit("").alias("funkoNumberFromTitle"), F.when(src, V.PRICED_SOURCE).otherwise("").alias("funkoSource"), F.when(src, c("p_brand")).otherwise("").alias("upc"))


def _fuzzy_sql(fallback: bool) -> str:
    extra = " UNION ALL SELECT a.o, min(b.o), 1 FROM a JOIN b ON a.c = b.c GROUP BY a.o UNION ALL SELECT a.o, min(b.o), 2 FROM a JOIN b ON a.p = b.p AND b.p <> '' GROUP BY a.o" if fallback else ""
    return rf"""WITH r AS (SELECT p_partkey AS o, p_partkey % 3 = 0 AS src, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' (' || p_type || ')' ELSE p_name || ' ' || p_type END AS title, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 7 <> 0 THEN (p_partkey % 100)::VARCHAR ELSE '' END AS num, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE '' END AS upc FROM part),
k AS (SELECT *, {core('title')} AS c, {core("regexp_replace(title, '[(][^)]*[)]', ' ', 'g')")} AS p FROM r),
a AS (SELECT * FROM k WHERE src), b AS (SELECT * FROM k WHERE NOT src),
m AS (SELECT a.o, min(b.o) AS target, 0 AS rank FROM a JOIN b ON a.num = b.num AND a.num <> '' AND (a.c = b.c OR a.p = b.p OR a.p = b.c OR a.c = b.p OR
 (least(len(string_split(a.c, ' ')), len(string_split(b.c, ' '))) >= 2 AND CASE WHEN len(string_split(a.c, ' ')) <= len(string_split(b.c, ' ')) THEN list_has_all(string_split(b.c, ' '), string_split(a.c, ' ')) ELSE list_has_all(string_split(a.c, ' '), string_split(b.c, ' ')) END)) GROUP BY a.o{extra}),
x AS (SELECT o, arg_min(target, rank) AS target FROM m GROUP BY o),
g AS (SELECT target, arg_min(k.upc, k.o) AS upc FROM x JOIN k ON k.o = x.o GROUP BY target)
SELECT k.o AS p_partkey, CASE WHEN k.upc = '' THEN coalesce(g.upc, '') ELSE k.upc END AS upc FROM k LEFT JOIN g ON g.target = k.o WHERE k.o NOT IN (SELECT o FROM x)"""


@query(_fuzzy_sql(False))
def q_blocked_dedupe(spark, sf):
    return match.blocked_dedupe(_fuzzy_rows(spark, sf)).select(c("_ord").alias("p_partkey"), "upc")


@query(_fuzzy_sql(True))
def q_dedupe_fallback(spark, sf):
    return match.blocked_dedupe(_fuzzy_rows(spark, sf), from_title=False, fallback_exact=True).select(c("_ord").alias("p_partkey"), "upc")


@query("""WITH f AS (SELECT p_partkey AS o, p_name || '-' || (p_partkey % 50 + p_size * 100) AS id FROM part), k AS (SELECT DISTINCT (s_suppkey * 37 % 5000)::VARCHAR AS k FROM supplier),
x AS (SELECT o, id, row_number() OVER (PARTITION BY regexp_extract(id, '(\\d+)$', 1) ORDER BY o) AS rn FROM f) SELECT o AS p_partkey, id FROM x WHERE rn = 1 AND regexp_extract(id, '(\\d+)$', 1) NOT IN (SELECT k FROM k)""")
def q_id_antijoin(spark, sf):
    found = read(spark, sf, "part").select(c("p_partkey").alias("_ord"), F.concat("p_name", F.lit("-"), (c("p_partkey") % 50 + c("p_size") * 100).cast("string")).alias("id"))
    known = read(spark, sf, "supplier").select((c("s_suppkey") * 37 % 5000).cast("string").alias("id"))
    return match.new_ids(found, known).select(c("_ord").alias("p_partkey"), "id")


_ROW = "CASE p_partkey % 4 WHEN 0 THEN p_name || ' #' || p_size WHEN 1 THEN p_name || ' [' || p_type || '] #' || p_size WHEN 2 THEN 'Large ' || p_name || ' [Chase] #' || (p_size + 1) ELSE p_name || ' #' || (p_size + 1) END"
_REC = "CASE p_partkey % 3 WHEN 0 THEN p_name ELSE p_name || ' (' || p_type || ')' END"


@query(f"""WITH r AS (SELECT p_partkey, p_size::VARCHAR AS n, {_REC} AS a, {_ROW} AS b FROM part),
t AS (SELECT *, lower(b) AS low, {VARIANT_SQL.format(x='a')} AS w, {VARIANT_SQL.format(x='b')} AS h, {CORE_SQL.format(x='a')} AS ca, {CORE_SQL.format(x='b')} AS cb, regexp_extract(b, '#(\\d+)', 1) AS m FROM r),
g AS (SELECT *, len(list_filter(ca, lambda x: NOT contains(low, x))) = 0 AS covered, list_sort(ca) = list_sort(cb) AND len(ca) > 0 AS exact, len(list_filter(w, lambda x: contains(low, x))) AS hits, len(list_filter(h, lambda x: NOT list_contains(w, x))) AS miss FROM t)
SELECT p_partkey, 10 * hits - 4 * miss + CASE WHEN n = m THEN 8 ELSE -3 END AS score,
 CASE WHEN len(w) = 0 THEN CASE WHEN len(h) > 0 THEN 'row is a variant' WHEN NOT covered THEN 'name mismatch' ELSE 'base' END WHEN hits > 0 AND covered THEN 'variant' WHEN miss = 0 AND exact THEN 'approximate' ELSE 'variant mismatch' END AS reason,
 CASE WHEN len(w) = 0 THEN len(h) = 0 AND covered ELSE (hits > 0 AND covered) OR (miss = 0 AND exact) END AS ok, len(w) > 0 AND NOT (hits > 0 AND covered) AND miss = 0 AND exact AS approximate FROM g""")
def q_match_gate(spark, sf):
    t = read(spark, sf, "part").select("p_partkey", c("p_size").cast("string").alias("n"), F.expr(_REC).alias("a"), F.expr(_ROW).alias("b"))
    return t.select("p_partkey", match.score(c("a"), c("n"), c("b")).alias("score"), match.gate(c("a"), c("b")).alias("g")).select("p_partkey", "score", "g.reason", "g.ok", "g.approximate")


@query("""WITH x AS (SELECT a.p_partkey AS rec, b.p_partkey AS pos, 10 * (b.p_type = a.p_type)::INT - (b.p_brand = a.p_brand)::INT AS score FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size)
SELECT rec, arg_min(pos, (-(score - 0.01 * pos), pos)) AS pos FROM x GROUP BY rec""")
def q_best_row(spark, sf):
    x = match.contenders(read(spark, sf, "part"), "p_partkey", ["p_name", "p_size"], like="p_type", unlike="p_brand")
    score = 10 * c("same_like").cast("int") - c("same_unlike").cast("int")
    return match.best_rows(x.select("rec", "pos", score.alias("score")), "rec").select("rec", "pos")


def _order_tags(spark, sf) -> DataFrame:
    x = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(read(spark, sf, "part").select("p_partkey", "p_name", "p_type"), c("l_partkey") == c("p_partkey"))
    tag = F.when(c("p_type") == "PROMO", F.concat(F.lit("Pop! "), "p_name")).otherwise(F.concat("p_name", F.lit(" Gift Set")))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", tag.alias("tag"))


_TAGS_SQL = "x AS (SELECT l_orderkey, CASE WHEN p_type = 'PROMO' THEN 'Pop! ' || p_name ELSE p_name || ' Gift Set' END AS tag FROM lineitem JOIN part ON l_partkey = p_partkey)"


@query(f"WITH {_TAGS_SQL} SELECT tag, count(*) AS freq FROM x GROUP BY tag")
def q_tag_frequency(spark, sf):
    tags = _order_tags(spark, sf).groupBy("l_orderkey").agg(F.collect_list("tag").alias("series"))
    return derive.tag_frequency(tags)


@query(f"WITH {_TAGS_SQL}, f AS (SELECT tag, count(*) AS n FROM (SELECT DISTINCT l_orderkey, tag FROM x) GROUP BY tag) SELECT l_orderkey, arg_min(tag, (n, tag)) AS set_tag FROM (SELECT DISTINCT l_orderkey, tag FROM x WHERE tag LIKE '% Gift Set') JOIN f USING (tag) GROUP BY l_orderkey")
def q_rarest_tag(spark, sf):
    tags = _order_tags(spark, sf).groupBy("l_orderkey").agg(F.array_sort(F.collect_set("tag")).alias("series"))
    return derive.rarest_tag(tags, "l_orderkey")


_SLUG = "CASE p_partkey % 4 WHEN 0 THEN 'disney' WHEN 1 THEN 'wwe-' || replace(p_name, ' ', '-') ELSE replace(p_name, ' ', '-') END"


@query(rf"""WITH s AS (SELECT p_partkey, {_SLUG} AS slug, CASE WHEN p_size % 3 = 0 THEN p_name || '. FYE' WHEN p_size % 3 = 1 THEN 'Walmart' ELSE p_name || ' Convention' END AS ser FROM part),
l AS (SELECT *, array_to_string(list_transform(string_split(slug, '-'), lambda w: CASE WHEN w = 'wwe' THEN 'WWE' ELSE upper(left(w, 1)) || substr(w, 2) END), ' ') AS label FROM s)
SELECT p_partkey, label, 'Pop! ' || label AS category, CASE WHEN slug = 'disney' THEN '' ELSE label END AS from_url, CASE WHEN ser LIKE '%. FYE' THEN replace(ser, '. FYE', '') ELSE '' END AS from_series FROM l""")
def q_grouping(spark, sf):
    p = read(spark, sf, "part").withColumn("slug", F.expr(_SLUG))
    url = F.concat(F.lit("https://x.example/game/funko-pop-"), "slug", F.lit("/item"))
    series = F.when(c("p_size") % 3 == 0, F.concat("p_name", F.lit(". FYE"))).when(c("p_size") % 3 == 1, "Walmart").otherwise(F.concat("p_name", F.lit(" Convention")))
    return p.select("p_partkey", X.slug_label(c("slug")).alias("label"), X.category_of(F.lit(None), url).alias("category"), X.franchise_from_url(url).alias("from_url"), X.franchise_from_series(series).alias("from_series"))


_STORED = "CASE WHEN o_orderkey % 5 = 0 THEN 'none' WHEN o_orderkey % 5 = 1 THEN '' ELSE 'shop' END"


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'none' WHEN s = '' THEN '{V.PRICED_SOURCE}' ELSE s END AS price_source, CASE WHEN o_orderkey % 3 = 0 THEN 'none' WHEN s IN ('', 'none') THEN '{V.PRICED_SOURCE}' ELSE s END AS restamped FROM (SELECT o_orderkey, {_STORED} AS s FROM orders)""")
def q_provenance(spark, sf):
    t = read(spark, sf, "orders").select("o_orderkey", F.expr(_STORED).alias("s"), F.when(c("o_orderkey") % 3 != 0, c("o_totalprice").cast("string")).alias("v"))
    none = F.lit("")
    return t.select("o_orderkey", derive.price_source(c("s"), c("v"), none, none).alias("price_source"), derive.restamp(c("s"), none, c("v"), none).alias("restamped"))


def _coverage(spark, sf) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(read(spark, sf, "labels"), "doc_id", "left")
    return report.coverage(d, c("n_chars") > 0, c("quality").isNotNull(), c("lang") == "en", c("toxic") == 1, c("doc_id") % 3 == 0, c("doc_id") % 4 == 0)


_COV = """d AS (SELECT d.doc_id, coalesce(n_chars > 0, false) AS pa, quality IS NOT NULL AS pr, coalesce(lang = 'en', false) AS li, coalesce(toxic = 1, false) AS ap, d.doc_id % 3 = 0 AS u, d.doc_id % 4 = 0 AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
k AS (SELECT count(*) AS total, count(*) FILTER (pa) AS priceable, count(*) FILTER (li) AS linked, count(*) FILTER (pa AND pr) AS priced, count(*) FILTER (pr AND ap) AS approx, count(*) FILTER (pa AND NOT pr) AS unpriced, count(*) FILTER (pa AND NOT pr AND u) AS unpriced_upc, count(*) FILTER (pa AND NOT pr AND n) AS unpriced_number,
 count(*) FILTER (pa AND NOT pr AND u AND n) AS unpriced_both, count(*) FILTER (pa AND NOT pr AND NOT u AND NOT n) AS unpriced_neither, count(*) FILTER (pa AND NOT pr AND li) AS unpriced_linked, count(*) FILTER (pa AND pr AND NOT u) AS priced_no_upc FROM d)"""
_PCT = "CASE WHEN {b} = 0 THEN '0%' ELSE ((2000 * {a} + {b}) // (2 * {b})) // 10 || '.' || ((2000 * {a} + {b}) // (2 * {b})) % 10 || '%' END"


@query(f"WITH {_COV} SELECT *, {_PCT.format(a='priced', b='priceable')} AS priced_pct, {_PCT.format(a='unpriced_neither', b='unpriced')} AS neither_pct FROM k")
def q_coverage(spark, sf):
    return _coverage(spark, sf)


@query(f"""WITH {_COV} SELECT CASE WHEN unpriced = 0 THEN 'every row is priced' ELSE coalesce(nullif(concat_ws('; ', CASE WHEN unpriced_upc / unpriced >= 0.30 THEN 'many unpriced rows have a code: search by code' END, CASE WHEN unpriced_neither / unpriced >= 0.40 THEN 'many unpriced rows have no identifier: fill identifiers first' END,
 CASE WHEN unpriced_linked / unpriced >= 0.15 THEN 'many unpriced rows are linked: fetch their prices again' END, CASE WHEN unpriced_number / unpriced >= 0.50 THEN 'most unpriced rows have a number: search by title and number' END), ''), 'no single cause') END AS messages FROM k""")
def q_verdict(spark, sf):
    return report.verdict(_coverage(spark, sf)).select(F.array_join("messages", "; ").alias("messages"))


def _exportable(spark, sf) -> DataFrame:
    p = read(spark, sf, "pages")
    n = F.lpad((c("page_id") * 7919).cast("string"), 11, "0")
    odd = sum((F.substring(n, i, 1).cast("int") for i in range(1, 12, 2)), F.lit(0))
    even = sum((F.substring(n, i, 1).cast("int") for i in range(2, 12, 2)), F.lit(0))
    upc = F.when(c("page_id") % 7 == 0, "").when(c("page_id") % 7 == 1, F.concat(n, F.lit("0"))).otherwise(F.concat(n, ((10 - (3 * odd + even) % 10) % 10).cast("string")))
    handle = F.regexp_extract("url", r"/([^/?#]*)(?:[?#].*)?$", 1)
    text = lambda x: F.lit(x).cast("string")
    return p.select(
        c("page_id").alias("_ord"), upc.alias("upc"), handle.alias("handle"), F.when(c("page_id") % 11 == 0, "x").otherwise(F.concat(F.lit("Title "), c("page_id").cast("string"))).alias("title"), text(None).alias("franchise"),
        F.when(c("page_id") % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Pop! Vinyl"), F.concat(F.lit("Line "), (c("page_id") % 5).cast("string")), F.lit("Shop Exclusive"))).alias("series"),
        (c("page_id") % 90).cast("string").alias("funkoNumber"), text("").alias("funkoNumberFromTitle"), F.when(c("page_id") % 2 == 0, "$12.50").otherwise("0").alias("price"), text("").alias("imageName"), text("").alias("exclusiveRetailer"),
        (c("page_id") % 3 == 0).alias("isVaulted"), F.lit(False).alias("isChase"), F.lit(None).cast("boolean").alias("isExclusive"),
    )


_EXPORT = r"""n AS (SELECT page_id AS o, lpad((page_id * 7919)::VARCHAR, 11, '0') AS n, regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1) AS handle, CASE WHEN page_id % 11 = 0 THEN 'x' ELSE 'Title ' || page_id END AS name FROM pages),
u AS (SELECT *, CASE WHEN o % 7 = 0 THEN '' WHEN o % 7 = 1 THEN n || '0' ELSE n || (10 - list_sum(list_transform(range(1, 12), lambda i: substr(n, i, 1)::INT * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END)) % 10) % 10 END AS upc FROM n),
r AS (SELECT *, CASE WHEN upc = '' THEN 'no_upc' WHEN handle = '' OR handle LIKE '%.html' THEN 'no_handle' WHEN (10 - list_sum(list_transform(range(1, 12), lambda i: substr(upc, i, 1)::INT * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END)) % 10) % 10 <> substr(upc, 12, 1)::INT THEN 'bad_upc' WHEN length(name) < 2 THEN 'no_name' WHEN o % 13 = 0 THEN 'no_franchise' END AS reason FROM u)"""


@query(f"WITH {_EXPORT} SELECT o AS page_id, upc, handle, name, 'Line ' || o % 5 AS franchise, 'Pop! Vinyl' AS category, '#' || o % 90 AS series_number, CASE WHEN o % 2 = 0 THEN 12.5::DOUBLE END AS retail_price, 'Shop' AS retailer, CASE WHEN o % 3 = 0 THEN true END AS vaulted FROM r WHERE reason IS NULL")
def q_export(spark, sf):
    out, _ = derive.export(_exportable(spark, sf), F.lit("2026-01-01"))
    return out.select(c("_ord").alias("page_id"), "upc", "handle", "name", "franchise", "category", c("seriesNumber").alias("series_number"), c("retailPrice").alias("retail_price"), c("exclusiveRetailer").alias("retailer"), c("isVaulted").alias("vaulted"))


@query(f"WITH {_EXPORT} SELECT coalesce(reason, 'exported') AS reason, count(*) AS n FROM r GROUP BY reason")
def q_reject_reasons(spark, sf):
    _, counts = derive.export(_exportable(spark, sf), F.lit("2026-01-01"))
    return counts.select(F.coalesce("reject_reason", F.lit("exported")).alias("reason"), "n")


@query(r"""SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS raw_title, len(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1))::INT AS n_links, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1)[1] AS first_link FROM pages""")
def q_page_links(spark, sf):
    return read(spark, sf, "pages").select("page_id", html.page_title(c("html")).alias("raw_title"), F.size(html.links(c("html"))).alias("n_links"), F.get(html.links(c("html")), F.lit(0)).alias("first_link"))


@query("WITH s AS (SELECT 'funko-pop-' || replace(p_name, ' ', '-') AS slug, p_brand FROM part) SELECT p_brand, array_to_string(list_sort(list_distinct(list_append(list(slug), 'funko-pop-disney'))), ',') AS slugs FROM s GROUP BY p_brand")
def q_console_slugs(spark, sf):
    page = F.concat_ws(" ", F.collect_list(F.concat(F.lit('<a href="/console/funko-pop-'), F.translate("p_name", " ", "-"), F.lit('">x</a>'))))
    t = read(spark, sf, "part").groupBy("p_brand").agg(page.alias("html"))
    return t.select("p_brand", F.array_join(F.array_sort(html.console_slugs(c("html"), F.array(F.lit("funko-pop-disney")))), ",").alias("slugs"))


@query("SELECT o_orderkey, o_custkey::INT AS declared FROM orders")
def q_declared_total(spark, sf):
    t = read(spark, sf, "orders")
    page = F.concat(F.lit("<p>Showing 1-20 of "), F.format_number(c("o_custkey"), 0), F.lit(" Items</p>"))
    return t.select("o_orderkey", html.declared_total(page).alias("declared"))


@query("SELECT o_orderkey, 'S' || o_orderkey % 9 AS section, 'F' || o_custkey AS franchise FROM orders")
def q_breadcrumb(spark, sf):
    t = read(spark, sf, "orders")
    crumb = lambda i, name: F.concat(F.lit('{"@type":"ListItem","position":%d,"item":{"@id":"u","name":"' % i), name, F.lit('"}}'))
    items = F.concat_ws(",", crumb(3, F.concat(F.lit("F"), c("o_custkey").cast("string"))), crumb(1, F.lit("Home")), crumb(2, F.concat(F.lit("S"), (c("o_orderkey") % 9).cast("string"))))
    page = F.concat(F.lit('<script type="application/ld+json">{bad</script><script type="application/ld+json">[{"@type":"BreadcrumbList","itemListElement":['), items, F.lit("]}]</script>"))
    return t.select("o_orderkey", html.franchise_of(html.breadcrumbs(page)).alias("f")).select("o_orderkey", "f.section", "f.franchise")


@query("SELECT p_brand, 'series' AS dim, p_type AS name, 1000 + min(p_size) FILTER (true) AS count FROM (SELECT p_brand, p_type, p_size FROM part) GROUP BY p_brand, p_type")
def q_facet_vocabulary(spark, sf):
    line = F.concat(F.lit("Refine by Series: "), "p_type", F.lit(" (1,"), F.lpad(c("p_size").cast("string"), 3, "0"), F.lit(")"))
    t = read(spark, sf, "part").groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_size", line.alias("l")))), lambda x: x["l"]), "\n").alias("html"))
    return html.facet_vocabulary(t, c("html"), "p_brand")


@query("""SELECT p_name AS key, coalesce(array_to_string(list_sort(list_distinct(list(p_type) FILTER (p_size % 3 = 0))), ','), '') AS fandom, coalesce(array_to_string(list_sort(list_distinct(list(p_type) FILTER (p_size % 3 = 1))), ','), '') AS license,
 coalesce(array_to_string(list_sort(list_distinct(list(p_type) FILTER (p_size % 3 = 2))), ','), '') AS series_tags FROM part GROUP BY p_name""")
def q_facet_tags(spark, sf):
    dim = F.get(F.array(F.lit("fandom"), F.lit("license"), F.lit("series")), c("p_size") % 3)
    tags = derive.facet_tags(read(spark, sf, "part").select(c("p_name").alias("key"), dim.alias("dim"), c("p_type").alias("value")))
    return tags.select("key", *(F.array_join(F.coalesce(k, F.array().cast("array<string>")), ",").alias(k) for k in ("fandom", "license", "series_tags")))


_NOW = "TIMESTAMP '1998-06-01 00:00:00'"


@query(f"""SELECT o_orderkey FROM (SELECT *, o_orderkey % 2 = 0 AS priced, o_orderkey % 3 <> 0 AS has_upc FROM orders) WHERE NOT priced OR NOT has_upc OR o_orderdate < {_NOW} - INTERVAL 90 DAY""")
def q_candidates(spark, sf):
    t = read(spark, sf, "orders").withColumn("_ord", c("o_orderkey"))
    out = incremental.price_candidates(t, c("o_orderkey") % 2 == 0, F.when(c("o_orderkey") % 3 != 0, "1").otherwise(""), c("o_orderdate").cast("string"), F.expr(_NOW), True, 90)
    return out.select("o_orderkey")


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN true ELSE o_orderdate < {_NOW} - INTERVAL 90 DAY END AS stale FROM orders")
def q_stale(spark, sf):
    at = F.when(c("o_orderkey") % 20 == 0, "soon").when(c("o_orderkey") % 10 != 0, c("o_orderdate").cast("string"))
    return read(spark, sf, "orders").select("o_orderkey", incremental.stale(at, F.expr(_NOW), 90).alias("stale"))


@query("SELECT p_partkey FROM part WHERE p_size % 4 <> 0 AND (p_size % 4 <> 1) AND p_partkey % 3 <> 0")
def q_reference_candidates(spark, sf):
    p = read(spark, sf, "part")
    rows = p.select(c("p_partkey").alias("_ord"), F.when(c("p_size") % 4 == 0, "").when(c("p_size") % 4 == 1, "x.html").otherwise(c("p_name")).alias("handle"), F.when(c("p_partkey") % 3 == 0, "7").alias("hdbid"), F.lit(None).cast("boolean").alias("hdbChecked"), F.lit("").alias("upc"), F.lit("").alias("funkoNumber"), F.array("p_type").alias("series"))
    return incremental.reference_candidates(rows).select(c("_ord").alias("p_partkey"))


@query("""WITH r AS (SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY l_orderkey) SELECT o_orderkey, coalesce(rows, 0) AS rows, (o_orderkey % 12)::BIGINT AS target, o_orderkey % 17 <> 0 AND coalesce(rows, 0) > 0 AND (o_orderkey % 12 = 0 OR coalesce(rows, 0) >= o_orderkey % 12 - 5) AS done FROM orders LEFT JOIN r ON l_orderkey = o_orderkey""")
def q_completeness(spark, sf):
    targets = read(spark, sf, "orders").select("o_orderkey", (c("o_orderkey") % 12).alias("target"), (c("o_orderkey") % 17 == 0).alias("failed"))
    return incremental.complete_sets(read(spark, sf, "lineitem").select(c("l_orderkey").alias("o_orderkey")), targets, "o_orderkey")


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'error')")
def q_resume(spark, sf):
    done = spark.createDataFrame([("click",), ("error",), ("click",)], "event_type string")
    return incremental.unfinished(read(spark, sf, "events").select("event_id", "event_type"), done, "event_type")


@query("SELECT event_id, (props ->> '$.k')::INT AS k FROM events")
def q_json_props(spark, sf):
    return read(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT p_type, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn FROM part) WHERE rn <= 5")
def q_limit_per_dim(spark, sf):
    return incremental.first_per(read(spark, sf, "part").select("p_type", "p_partkey"), "p_type", 5, "p_partkey")


@query("SELECT p_partkey AS _ord, left(p_name || ' ' || p_type, 10) AS title FROM part ORDER BY p_partkey LIMIT 8")
def q_samples(spark, sf):
    return report.samples(read(spark, sf, "part").select(c("p_partkey").alias("_ord"), F.concat("p_name", F.lit(" "), "p_type").alias("title")), 8, 10)


@query("""SELECT 'both' AS side, count(*) AS n FROM (SELECT p_name FROM part WHERE p_size < 25 INTERSECT SELECT p_name FROM part WHERE p_size >= 25) UNION ALL SELECT 'left', count(*) FROM (SELECT p_partkey FROM part WHERE p_size < 25 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49) UNION ALL SELECT 'any', count(*) FROM (SELECT p_brand FROM part UNION SELECT p_type FROM part)""")
def q_set_ops(spark, sf):
    p = read(spark, sf, "part")
    both = p.filter("p_size < 25").select("p_name").intersect(p.filter("p_size >= 25").select("p_name"))
    left = incremental.unfinished(p.filter("p_size < 25").select("p_partkey"), read(spark, sf, "lineitem").filter("l_quantity > 49").select(c("l_partkey").alias("p_partkey")), "p_partkey").distinct()
    either = p.select("p_brand").union(p.select("p_type")).distinct()
    n = lambda df, side: df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return n(both, "both").union(n(left, "left")).union(n(either, "any"))


@query(r"""
WITH h AS (SELECT doc_id, replace(lower(coalesce(text, '')), ' ', '-') || '-(#' || doc_id || '-x)' AS h FROM documents),
e AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(h, '-?&amp;-?', '-', 'g'), '-?&[a-z]+;-?', '-', 'g'), '-?\[[^\]]*\]-?', '-', 'g') AS h FROM h),
n AS (SELECT doc_id, replace(regexp_replace(regexp_replace(h, '[()]', '', 'g'), '-?#[0-9]*-?', '-', 'g'), ',', '') AS h FROM e),
s AS (SELECT doc_id, strip_accents(regexp_replace(h, '[''‘’./:]', '-', 'g')) AS h FROM n)
SELECT doc_id, regexp_replace(regexp_replace(h, '-+', '-', 'g'), '^-|-$', '', 'g') AS handle FROM s""")
def q_url_handle(spark, sf):
    h = F.concat(F.translate(F.lower(X.blank(c("text"))), " ", "-"), F.lit("-(#"), c("doc_id").cast("string"), F.lit("-x)"))
    return read(spark, sf, "documents").select("doc_id", X.url_handle(h).alias("handle"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS released FROM orders")
def q_release_date(spark, sf):
    d = c("o_orderdate")
    raw = F.when(c("o_orderkey") % 4 == 0, F.date_format(d, "MMMM d, yyyy")).when(c("o_orderkey") % 4 == 1, F.date_format(d, "MMM d, yyyy")).when(c("o_orderkey") % 4 == 2, F.date_format(d, "yyyy-MM-dd")).otherwise("soon")
    return read(spark, sf, "orders").select("o_orderkey", X.release_date(raw).alias("released"))


@query("""SELECT o_orderkey, CASE o_orderkey % 12 WHEN 3 THEN strftime(o_orderdate, '%Y-%m') || '-01' WHEN 4 THEN strftime(o_orderdate, '%Y') || '-01-01' WHEN 9 THEN strftime(o_orderdate, '%Y-%m') || '-01' WHEN 10 THEN NULL WHEN 11 THEN NULL
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS released FROM orders""")
def q_free_dates(spark, sf):
    """Release dates in the free forms that pages have."""
    d, k = c("o_orderdate"), c("o_orderkey") % 12
    forms = ("EEEE, MMMM d, yyyy", "d MMM yyyy", "MMM. d yyyy", "MMMM yyyy", "yyyy", "M/d/yyyy", "yyyy/M/d", "d-MMM-yy", "yyyy MMMM d", "yyyy-MM")
    made = F.get(F.array(*(F.date_format(d, f) for f in forms), F.date_format(d, "'about' MMMM yyyy"), F.lit("June 99, 2020")), k.cast("int"))
    return read(spark, sf, "orders").select("o_orderkey", X.release_date(F.concat(F.lit(" "), made)).alias("released"))


@query("SELECT sum((p_size % 2 = 0)::INT)::BIGINT AS p_size, sum((p_name LIKE 'red%')::INT)::BIGINT AS p_name, sum((p_size % 2 = 0 OR p_name LIKE 'red%')::INT)::BIGINT AS any_field FROM part")
def q_change_count(spark, sf):
    p = read(spark, sf, "part")
    after = p.withColumns({"p_size": F.when(c("p_size") % 2 == 0, None).otherwise(c("p_size")), "p_name": F.when(c("p_name").startswith("red"), F.upper("p_name")).otherwise(c("p_name"))})
    return report.changes(p, after, ["p_size", "p_name"], "p_partkey")
