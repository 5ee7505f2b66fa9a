"""Joins of record linkage: two-key lookup and upsert, title and blocked fuzzy dedup, scoring and gate."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import fixed_values as V
from shelfmark.functions import text as X
from shelfmark.operators import merge, predicates
from shelfmark.operators.graph import components
from shelfmark.session import stash


def _last_by(rows: DataFrame, key: Column, order: str = "_ord") -> DataFrame:
    """``(k, at)``: the last row of each key that is not blank."""
    return rows.select(key.alias("k"), F.col(order).alias("at")).filter(F.coalesce(F.col("k") != "", F.lit(False))).groupBy("k").agg(F.max("at").alias("at"))


def two_key_lookup(rows: DataFrame, base: DataFrame, title_key: Callable[[Column], Column] = X.normalise_title) -> DataFrame:
    """Add ``by_handle, by_title, at``: the base row that has the handle, else the title; last one wins."""
    handles = _last_by(base, F.lower("handle")).withColumnsRenamed({"k": "_hk", "at": "by_handle"})
    titles = _last_by(base, title_key(F.col("title"))).withColumnsRenamed({"k": "_tk", "at": "by_title"})
    keyed = rows.withColumns({"_h": F.lower("handle"), "_t": title_key(F.col("title"))})
    out = keyed.join(handles, F.col("_h") == F.col("_hk"), "left").join(titles, F.col("_t") == F.col("_tk"), "left")
    return out.withColumn("at", F.coalesce("by_handle", "by_title")).drop("_h", "_t", "_hk", "_tk")


#: Rounds before what is left is looked at by components, and the rows of a component that is replayed at once.
ROUNDS, REPLAY = 10, 10_000


def _replay(group: pd.DataFrame) -> pd.DataFrame:
    """The rows of a component that are appended, in order: those that meet neither key before them."""
    handles, titles, out = set(), set(), []
    for at, h, t in group.sort_values("_ord")[["_ord", "h", "t"]].itertuples(index=False):
        if h not in handles and t not in titles:
            out.append((at, h, t))
            handles |= {h} - {None}
            titles |= {t} - {None}
    return pd.DataFrame(out, columns=["_ord", "h", "t"])


def _appended(rows: DataFrame) -> DataFrame:
    """Of ``rows(_ord, h, t)``, those that a pass in order appends: no appended row before has their handle or title.

    In rounds: a row that is the least under both its keys is appended, and what shares a key with it is not.
    Rows of one key take part in many tasks. Few rounds settle nearly all; what is left falls into components,
    of which small ones are replayed in order, and long chains of rows that wait for each other go on in rounds.
    """
    key_sets = {"h": lambda d: d.filter("h is not null"), "t": lambda d: d.filter("t is not null")}
    keyless = rows.filter("h is null and t is null")
    left = stash(rows.filter("h is not null or t is not null").groupBy("h", "t").agg(F.min("_ord").alias("_ord")).select("_ord", "h", "t"), "undecided")
    parts, turn = [keyless], 0
    while not left.isEmpty():
        turn += 1
        if turn % ROUNDS == 0:
            made, left = _small_components(left)
            parts.append(made)
            continue
        marked = left
        for k, some in key_sets.items():
            least = some(left).groupBy(F.col(k).alias("k")).agg(F.min("_ord").alias(f"_{k}"))
            marked = marked.join(least, F.col(k) == F.col("k"), "left").drop("k")
        made = stash(marked.filter("_ord = coalesce(_h, _ord) and _ord = coalesce(_t, _ord)").select("_ord", "h", "t"), "appended")
        rest = left.join(made.select("_ord"), "_ord", "left_anti")
        for k, some in key_sets.items():
            rest = rest.join(some(made).select(F.col(k).alias("k")), F.col(k) == F.col("k"), "left_anti")
        parts.append(made)
        left = stash(rest, "undecided")
    return reduce(DataFrame.unionByName, parts)


def _small_components(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What components of few rows append, and the rows of the others."""
    node = {k: F.when(F.col(k).isNotNull(), F.xxhash64(F.lit(k), k)) for k in ("h", "t")}
    keyed = left.withColumns({"u": F.coalesce(node["h"], node["t"]), "v": F.coalesce(node["t"], node["h"])})
    found = components(keyed.select("u", "v"))
    keyed = keyed.join(found, F.col("u") == F.col("node"), "left").select("_ord", "h", "t", F.coalesce("component", "u").alias("c"))
    sized = stash(keyed.join(keyed.groupBy("c").agg(F.count("*").alias("n")), "c"), "components")
    made = sized.filter(F.col("n") <= REPLAY).groupBy("c").applyInPandas(lambda g: _replay(g), left.schema)
    return stash(made, "appended"), sized.filter(F.col("n") > REPLAY).select("_ord", "h", "t")


def assign_upsert(incoming: DataFrame, base: DataFrame) -> DataFrame:
    """``(_ord, kind, target)``: what each incoming row does in a sequential upsert.

    kind ``base``: it merges into the base row ``target``; ``new``: into the earlier incoming row
    ``target``; ``append``: it becomes a row. A handle is looked up before a title, and a key of the base
    before one of an appended row. Which rows are appended is found in rounds, and the rest is joins: the
    result equals that of one pass over all rows in order.
    """
    found = stash(two_key_lookup(incoming.select("_ord", "handle", "title"), base), "lookup")
    final = found.filter("by_handle is not null").select("_ord", F.lit("base").alias("kind"), F.col("by_handle").alias("target"))
    some = lambda x: F.nullif(x, F.lit(""))
    rest = found.filter("by_handle is null").select("_ord", some(F.lower(F.col("handle"))).alias("h"), some(X.normalise_title(F.col("title"))).alias("t"), "by_title")
    added = stash(_appended(rest.filter("by_title is null").select("_ord", "h", "t")), "appended")
    handles = added.filter("h is not null").select(F.col("h").alias("_hk"), F.col("_ord").alias("_ha"))
    titles = added.filter("t is not null").select(F.col("t").alias("_tk"), F.col("_ord").alias("_ta"))
    met = rest.join(handles, F.col("h") == F.col("_hk"), "left").join(titles, F.col("t") == F.col("_tk"), "left")
    met = met.join(added.select(F.col("_ord").alias("_own")), F.col("_ord") == F.col("_own"), "left")
    before = lambda c: F.coalesce(F.col(c) < F.col("_ord"), F.lit(False))
    kind = F.when(F.col("_own").isNotNull(), "append").when(before("_ha"), "new").when(F.col("by_title").isNotNull(), "base").otherwise("new")
    target = F.when(F.col("_own").isNotNull(), F.col("_ord")).when(before("_ha"), F.col("_ha")).when(F.col("by_title").isNotNull(), F.col("by_title")).otherwise(F.col("_ta"))
    return final.unionByName(met.select("_ord", kind.alias("kind"), target.alias("target")))


def _planned(base: DataFrame, incoming: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The base with appended rows, and updates with the row each of them merges into."""
    top = base.agg(F.coalesce(F.max("_ord"), F.lit(-1)) + 1).first()[0]
    rows = incoming.join(plan, "_ord")
    added = rows.filter("kind = 'append'").drop("kind", "target").withColumn("_ord", F.col("_ord") + top)
    updates = rows.filter("kind <> 'append'").withColumn("target", F.when(F.col("kind") == "new", F.col("target") + top).otherwise(F.col("target")))
    return base.unionByName(added, allowMissingColumns=True), updates


def upsert(base: DataFrame, incoming: DataFrame, policy: dict[str, str]) -> DataFrame:
    """The base with incoming rows merged in by ``policy`` or appended; ``_ord`` of appended rows follows the base.

    Several rows that merge into one target apply in order: fills take the first truthy value,
    overwrites the last.
    """
    rows, updates = _planned(base, incoming, stash(assign_upsert(incoming, base), "upsert"))
    return apply_updates(rows, updates, policy)


def upsert_changes(base: DataFrame, incoming: DataFrame, policy: dict[str, str]) -> DataFrame:
    """``(_ord, kind, target, changed)`` of each incoming row: whether it changed the row it merged into.

    A row that is appended is not a change. Rows of one target count in order: one that brings what an earlier one
    brought changes nothing.
    """
    plan = stash(assign_upsert(incoming, base), "upsert")
    rows, updates = _planned(base, incoming, plan)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    state = rows.select(F.col("_ord").alias("target"), *(F.col(f).alias(f"_t_{f}") for f in policy))
    met = stash(updates.select("_ord", "target", *policy).join(state, "target"), "met")
    hits = []
    for field, name in policy.items():
        new, old, kind = F.col(field), F.col(f"_t_{field}"), kinds[field]
        truthy = merge.is_truthy(new, kind)
        if name in ("falsy", "blank"):  # the first that says something, where the target does not
            fills = merge.POLICIES[name](old, new, kind)
            some = met.filter(truthy & ~fills.eqNullSafe(old))
            hits.append(some.groupBy("target").agg(F.min("_ord").alias("_ord")).select("_ord"))
        elif name in ("overwrite", "defined"):  # another value than the one before it
            said = met.filter(truthy if name == "overwrite" else new.isNotNull())
            last = F.lag(new).over(Window.partitionBy("target").orderBy("_ord"))
            first = F.row_number().over(Window.partitionBy("target").orderBy("_ord")) == 1
            hits.append(said.select("_ord", (~new.eqNullSafe(F.when(first, old).otherwise(last))).alias("hit")).filter("hit").select("_ord"))
        elif name == "if_empty":
            some = met.filter((F.coalesce(F.size(old), F.lit(0)) <= 0) & (F.size(new) > 0))
            hits.append(some.groupBy("target").agg(F.min("_ord").alias("_ord")).select("_ord"))
        else:  # the first to bring an element that the target lacks
            items = met.select("_ord", "target", F.explode(F.array_except(F.coalesce(new, F.array().cast("array<string>")), F.coalesce(old, F.array().cast("array<string>")))).alias("item"))
            hits.append(items.groupBy("target", "item").agg(F.min("_ord").alias("_ord")).select("_ord"))
    hit = reduce(DataFrame.unionByName, hits).distinct().select(F.col("_ord").alias("_hit"))
    out = plan.join(hit, F.col("_ord") == F.col("_hit"), "left")
    return out.select("_ord", "kind", "target", F.col("_hit").isNotNull().alias("changed"))


def apply_updates(rows: DataFrame, updates: DataFrame, policy: dict[str, str]) -> DataFrame:
    """Merge ``updates`` (with ``target`` naming a row's ``_ord``) into ``rows``, several to a row in order."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    aggs = []
    for field, name in policy.items():
        c, order = F.col(field), F.col("_ord")
        if name in ("falsy", "blank"):
            aggs.append(F.min_by(c, F.when(merge.is_truthy(c, kinds[field]), order)).alias(field))
        elif name == "overwrite":
            aggs.append(F.max_by(c, F.when(merge.is_truthy(c, kinds[field]), order)).alias(field))
        elif name == "defined":
            aggs.append(F.max_by(c, F.when(c.isNotNull(), order)).alias(field))
        else:
            aggs.append(merge.ordered_append(field).alias(field))
    one = updates.groupBy("target").agg(*aggs).alias("s")
    joined = rows.alias("t").join(one, F.col("t._ord") == F.col("s.target"), "left")
    made = merge.merge_columns(joined, policy)
    return joined.select(*(made[c].alias(c) if c in made else F.col(f"t.{c}").alias(c) for c in rows.columns))


def title_dedupe(catalog: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """Shop rows merge into the last unsourced row of their title, if that is of the main line, and go.

    A row is never its own target, also where it comes before the shop row.
    """
    fields = fields or {"available": "defined", "funkoSource": "overwrite"} | {f: "falsy" for f in ("pid", "price", "productUrl", "funkoPrimaryImage", "popType") if f in catalog.columns}
    keyed = catalog.withColumn("_tk", X.normalise_title(F.col("title")))
    targets = keyed.filter(~X.truthy(F.col("funkoSource")) & (F.col("_tk") != "")).groupBy("_tk").agg(F.max("_ord").alias("target"), F.max_by("series", "_ord").alias("_series"))
    targets = targets.filter(predicates.pop_guard(F.col("_series"))).drop("_series")
    shop = keyed.filter(X.truthy(F.col("funkoSource")) & (F.col("funkoSource") != V.PRICED_SOURCE) & (F.col("_tk") != ""))
    moved = shop.join(targets, "_tk").drop("_tk")
    kept = catalog.join(moved.select("_ord"), "_ord", "left_anti").select(*catalog.columns)
    return apply_updates(kept, moved, fields)


def short_tokens_shared(a: Column, b: Column) -> Column:
    """All words of the shorter name are in the longer, and the shorter has two at least."""
    x, y = (F.filter(F.split(c, " "), lambda w: w != "") for c in (a, b))
    short, long = F.when(F.size(x) <= F.size(y), x).otherwise(y), F.when(F.size(x) <= F.size(y), y).otherwise(x)
    return (F.size(short) >= 2) & (F.size(F.array_except(short, long)) == 0)


def _contained(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(ao, target)``: names of one number of which the shorter's words, two at least, are all in the longer.

    Each name is posted under the rarest of its words, and asks under all of its words: a shorter name
    meets every longer one under its rarest word, whichever side it is on.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))
    x = a.select("ao", F.col("an").alias("n"), F.col("ac").alias("name_a"), words(F.col("ac")).alias("w"))
    y = b.select(F.col("bo").alias("target"), F.col("bn").alias("n"), F.col("bc").alias("name_b"), words(F.col("bc")).alias("w"))
    # canonical rows of one name and number: the first stands for all
    y = y.groupBy("n", "name_b").agg(F.min("target").alias("target"), F.first("w").alias("w"))
    x1, y1 = x.select("ao", "n", "name_a", F.explode("w").alias("word")), y.select("target", "n", "name_b", F.explode("w").alias("word"))
    often = x1.select("n", "word").unionAll(y1.select("n", "word")).groupBy("n", "word").agg(F.count("*").alias("often"))
    rarest = lambda rows, key: rows.join(often, ["n", "word"]).groupBy(*key).agg(F.min_by("word", F.struct("often", "word")).alias("word"))
    xr, yr = rarest(x1, ["ao", "n", "name_a"]), rarest(y1, ["target", "n", "name_b"])
    met = xr.join(y1, ["n", "word"]).select("ao", "name_a", "target", "name_b").unionAll(x1.join(yr, ["n", "word"]).select("ao", "name_a", "target", "name_b"))
    return met.filter(short_tokens_shared(F.col("name_a"), F.col("name_b"))).select("ao", "target")


def blocked_pairs(probes: DataFrame, canon: DataFrame, from_title: bool = True, fallback_exact: bool = False) -> DataFrame:
    """``(_ord, target)``: for each probe the first canonical row of its number whose name agrees.

    Names are computed once a row and joined with the number: equal names by equality, names whose words
    are within another's through the shorter one's rarest word of that number. ``fallback_exact`` also
    takes the first equal name where a probe has no number or no match.
    """
    title = F.col("title")

    def keyed(df: DataFrame, p: str) -> DataFrame:
        extra = F.col("funkoNumberFromTitle") if from_title else None
        return df.select(F.col("_ord").alias(f"{p}o"), X.number_of(F.col("funkoNumber"), title, extra).alias(f"{p}n"), X.core_name(title).alias(f"{p}c"), X.core_no_parens(title).alias(f"{p}p"))

    a, b = keyed(probes, "a"), keyed(canon, "b")
    named = a.filter((F.col("an") != "") & (F.col("ac") != ""))
    # equal names of one number are equi-joins; the first canonical row of each key is all that counts
    found = []
    for x, y in (("c", "c"), ("p", "p"), ("p", "c"), ("c", "p")):
        first = b.filter(F.col("bn") != "").groupBy("bn", f"b{y}").agg(F.min("bo").alias("target"))
        found.append(named.join(first, (F.col("an") == F.col("bn")) & (F.col(f"a{x}") == F.col(f"b{y}"))).select("ao", "target"))
    # one name's words within the other's: the shorter list is met at each of its words but by its rarest alone
    found.append(_contained(named, b.filter((F.col("bn") != "") & (F.col("bc") != ""))))
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    pairs = pairs.withColumn("rank", F.lit(0))
    if fallback_exact:
        for i, c in enumerate(("c", "p"), 1):
            first = b.filter(F.col(f"b{c}") != "").groupBy(f"b{c}").agg(F.min("bo").alias("target"))
            pairs = pairs.unionByName(a.join(first, F.col(f"a{c}") == F.col(f"b{c}")).select("ao", "target", F.lit(i).alias("rank")))
    return pairs.groupBy(F.col("ao").alias("_ord")).agg(F.min_by("target", F.struct("rank", "target")).alias("target"))


def blocked_dedupe(catalog: DataFrame, fields: tuple[str, ...] = V.DEDUPE_FIELDS, from_title: bool = True, fallback_exact: bool = False) -> DataFrame:
    """Priced duplicates fill blanks of the row they duplicate, and go."""
    priced = predicates.is_priced_source(F.col("funkoSource"), F.col("handle") if fallback_exact else None)
    probes, canon = catalog.filter(priced), catalog.filter(~priced)
    pairs = stash(blocked_pairs(probes, canon, from_title, fallback_exact), "pairs")
    moved = probes.join(pairs, "_ord")
    kept = catalog.join(pairs.select("_ord"), "_ord", "left_anti").select(*catalog.columns)
    return apply_updates(kept, moved, {f: "blank" for f in fields if f in catalog.columns})


def new_ids(found: DataFrame, existing: DataFrame, id_col: str = "id", tail_tolerant: bool = True, limit: int | None = None) -> DataFrame:
    """Rows of ``found`` whose id was not seen before, in the base or earlier in ``found``; the first ``limit`` of them, if given."""
    key = X.id_tail(F.col(id_col)) if tail_tolerant else F.col(id_col)
    first = found.withColumn("_k", key).withColumn("_rn", F.row_number().over(Window.partitionBy("_k").orderBy("_ord"))).filter("_rn = 1")
    known = existing.select(key.alias("_k")).distinct()
    new = first.join(known, "_k", "left_anti").drop("_k", "_rn")
    return new if limit is None else new.orderBy("_ord").limit(limit)


def name_covered(title: Column, row: Column) -> Column:
    low = F.lower(X.blank(row))
    return F.forall(X.core_tokens(title), lambda w: F.contains(low, w))


def name_exact(title: Column, row: Column) -> Column:
    a, b = (F.array_join(F.array_sort(X.core_tokens(c)), " ") for c in (title, row))
    return (a != "") & (a == b)


def score(title: Column, number: Column, row: Column) -> Column:
    """Wanted variant words found, less other variant words, and whether the numbers agree."""
    low = F.lower(X.blank(row))
    want, have = X.variant_tokens(title), X.variant_tokens(row)
    n, m = X.digits(number), F.regexp_extract(X.blank(row), r"#(\d+)", 1)
    hits, misses = F.size(F.filter(want, lambda w: F.contains(low, w))), F.size(F.filter(have, lambda w: ~F.array_contains(want, w)))
    both = (n != "") & (m != "")
    return 10 * hits - 4 * misses + F.when(both & (n == m), 8).when(both, -3).otherwise(0)


def gate(title: Column, row: Column, matched_by: Column | None = None, strict_base: bool = False) -> Column:
    """Struct (ok, reason, approximate): whether the best row may be taken.

    ``strict_base`` asks a base row for the exact name, where the data model asks for coverage only.
    """
    want, have, low = X.variant_tokens(title), X.variant_tokens(row), F.lower(X.blank(row))
    made = lambda ok, reason, approx=False: F.struct(F.lit(ok).alias("ok"), F.lit(reason).alias("reason"), F.lit(approx).alias("approximate"))
    covered, exact = name_covered(title, row), name_exact(title, row)
    hit = F.exists(want, lambda w: F.contains(low, w))
    other = F.exists(have, lambda w: ~F.array_contains(want, w))
    base = F.when(F.size(have) > 0, made(False, "row is a variant")).when(~(exact if strict_base else covered), made(False, "name mismatch")).otherwise(made(True, "base"))
    rule = F.when(F.size(want) == 0, base).when(hit & covered, made(True, "variant")).when(~other & exact, made(True, "approximate", True)).otherwise(made(False, "variant mismatch"))
    if matched_by is None:
        return rule
    return F.when(F.coalesce(matched_by.isin("upc", "upc-multi"), F.lit(False)), made(True, "upc")).otherwise(rule)


def best_rows(candidates: DataFrame, key: str, score_col: str = "score", pos: str = "pos") -> DataFrame:
    """The row of most score a key, earlier listed rows a hundredth better each."""
    # in hundredths, so that whole scores stay exact: binary fractions would part rows that are level
    w = Window.partitionBy(key).orderBy((F.col(score_col) * F.lit(100).cast("long") - F.col(pos)).desc(), F.col(pos).asc_nulls_last())
    return candidates.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def contenders(rows: DataFrame, key: str, group: list[str], like: str, unlike: str) -> DataFrame:
    """``(rec, pos, same_like, same_unlike)``: each row beside those of its group of which one is its ``best_rows``, five at most.

    For scores of these two alone, that an equal ``like`` does not lower and an equal ``unlike`` does not raise; ``pos`` is the other
    row's key. Any row but the first and the first of another ``unlike`` is then behind one of these two, among the rows of the
    same ``like`` as well as in the group. A row that lacks either field has no scores: the first of its group is its best.
    """
    lacks, one = F.col(like).isNull() | F.col(unlike).isNull(), F.struct("_pos", like, unlike)

    def two(df: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(lacks, F.col("_pos").asc_nulls_last())
        return df.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2").groupBy(*by)

    firsts = rows.groupBy(*group, like, unlike).agg(F.min(key).alias("_pos"))
    near = two(firsts, [*group, like]).agg(F.collect_list(one).alias("_near"))
    far = two(firsts.filter(~lacks).groupBy(*group, unlike).agg(F.min_by(like, "_pos").alias(like), F.min("_pos").alias("_pos")), group).agg(F.collect_list(one).alias("_far"))
    least = firsts.groupBy(*group).agg(F.array(F.min_by(one, F.col("_pos"))).alias("_least"))
    leads = near.join(least, group).join(far, group, "left")
    met = F.array_distinct(F.concat("_near", "_least", F.coalesce("_far", F.array().cast(far.schema["_far"].dataType))))
    # stored, so that their size is known: where there are few, they are broadcast and no row is shuffled by its group
    leads = stash(leads.select(*(F.col(g).alias(f"_{g}") for g in group), F.col(like).alias("_like"), met.alias("_met")), "leads")
    same = reduce(Column.__and__, (F.col(g) == F.col(f"_{g}") for g in group), F.col(like).eqNullSafe(F.col("_like")))
    pairs = rows.join(leads, same).select(F.col(key).alias("rec"), like, unlike, F.explode("_met").alias("_b"))
    return pairs.select("rec", F.col("_b._pos").alias("pos"), (F.col(f"_b.{like}") == F.col(like)).alias("same_like"), (F.col(f"_b.{unlike}") == F.col(unlike)).alias("same_unlike"))


def match_listings(records: DataFrame, listings: DataFrame) -> DataFrame:
    """The best listing row of each record and the gate's decision.

    ``listings(query_key, name, console, pos, ...)``: rows that a search for a code or a title gave;
    their places count among the rows of figures. A valid code is tried first (one row: taken; more: the
    best); records without such rows go by title and number, the verified one or else the title's.
    """
    place = F.row_number().over(Window.partitionBy("query_key").orderBy("pos")) - 1
    known = listings.filter(predicates.listing_console(F.col("console"))).withColumn("pos", place)
    records = records.drop(*(set(listings.columns) & set(records.columns)))
    number = F.when(X.truthy(F.col("funkoNumber")), F.col("funkoNumber"))
    if "funkoNumberFromTitle" in records.columns:
        number = F.coalesce(number, F.col("funkoNumberFromTitle"))
    rec = records.withColumns({"_upc": X.normalise_upc(F.col("upc")), "_q": X.search_query(F.col("title"), number)})
    by_code = rec.join(known, F.col("_upc") == F.col("query_key"))
    n = F.count("*").over(Window.partitionBy("_ord"))
    by_code = by_code.withColumn("matched_by", F.when(n == 1, "upc").otherwise("upc-multi"))
    by_title = rec.join(by_code.select("_ord").distinct(), "_ord", "left_anti").join(known, F.col("_q") == F.col("query_key")).withColumn("matched_by", F.lit("title"))
    every = by_code.unionByName(by_title).withColumn("score", score(F.col("title"), F.col("funkoNumber"), F.col("name")))
    return best_rows(every, "_ord").withColumn("match", gate(F.col("title"), F.col("name"), F.col("matched_by"))).drop("_upc", "_q")


def facet_join(catalog: DataFrame, tags: DataFrame) -> DataFrame:
    """Add facet arrays to the rows they name: ``tags(key, fandom, license, series_tags)``, key a handle else a title, in any case."""
    handles = catalog.groupBy(F.lower("handle").alias("k")).agg(F.max("_ord").alias("target")).filter("k <> ''")
    titles = catalog.groupBy(X.facet_title(F.col("title")).alias("k")).agg(F.min("_ord").alias("target")).filter("k <> ''")
    t = tags.withColumns({"_fk": X.facet_title(F.col("key"))})
    t = t.join(handles.withColumnsRenamed({"k": "_h", "target": "_a"}), F.lower("key") == F.col("_h"), "left").join(titles.withColumnsRenamed({"k": "_t", "target": "_b"}), F.col("_fk") == F.col("_t"), "left")
    t = t.withColumn("target", F.coalesce("_a", "_b")).filter("target is not null").withColumn("_ord", F.monotonically_increasing_id())
    named = {"funkoFandom": "fandom", "funkoLicense": "license", "funkoSeries": "series_tags"}
    updates = t.select("_ord", "target", *(F.array_sort(F.col(b)).alias(a) for a, b in named.items()))
    return apply_updates(catalog, updates, dict.fromkeys(named, "union"))
