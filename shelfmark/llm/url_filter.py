"""URL filters: fixed rules, then association rules mined from labelled URLs.

Method. A URL becomes a set of tokens: scheme, the host's name and each domain above it, path words
(digits as ``#``), file ending, query keys, fragment. FP-growth over the labelled sets, with the label
as one more item, gives the token combinations above ``min_support``; rules whose consequent is a
label are kept above ``min_confidence``, and dropped if a rule on a part of their tokens is as
confident. They match by an inverted index: each rule is posted under the rarest of its tokens, a URL
looks up its tokens, and a posted rule applies if all its tokens are there. The rule with most
confidence, then support, decides; without any the verdict is allow.

The number of rules is bounded by the support threshold, not by the corpus, and is checked: up to
``INLINE`` rules the index is a literal in the plan; beyond that it is a join on the token. Either way
distinct token sets are judged, not URLs, and the verdicts are joined back.

Cases. A null URL or one without ``://`` has an empty host and path, no tokens, and is allowed.
Repeated URLs are judged alike. No labels: no rules, allow. Extra columns are not read; html is never
scanned.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import table
from shelfmark.session import stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict)
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
MIN_SUPPORT = 0.005
LEAST_COUNT = 20
MIN_CONFIDENCE = 0.6
INLINE = 2000
BLOCK, ALLOW = "label=block", "label=allow"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column) -> Column:
    """Struct ``(rule, verdict)`` of the longest fitting rule, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, v in sorted(RULES, key=lambda r: len(r[0] + r[1])):  # the last one wrapped is tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(out)
    return out


def tokens_of(url: Column) -> Column:
    """The URL's distinct tokens; numbers lose their digits, so tokens are words that many URLs share."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, n), ".")))
    first = F.array(F.concat(F.lit("sub="), F.element_at(labels, 1)))
    words = F.transform(F.filter(F.split(path, "/"), lambda w: w != ""), lambda w: F.concat(F.lit("path="), F.regexp_replace(w, "[0-9]+", "#")))
    ending = F.array(F.concat(F.lit("end="), F.regexp_extract(path, r"\.(\w{1,5})$", 1)))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda w: w != ""), lambda w: F.concat(F.lit("key="), F.substring_index(w, "=", 1)))
    rest = F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"(?s)^(.*?)://", 1)), F.when(url.contains("#"), F.lit("fragment")))
    made = F.array_distinct(F.array_compact(F.concat(suffixes, first, words, ending, keys, rest)))
    return F.when((host != "") | (path != ""), F.filter(made, lambda t: ~t.endswith("="))).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, least: int = LEAST_COUNT) -> DataFrame:
    """``(antecedent, verdict, confidence, support)`` from rows of ``(url, bad boolean)``.

    A combination seen less than ``least`` times shows nothing, however few the labels, so the support is at least that.
    """
    rows = labelled.filter(F.col("bad").isNotNull()).select(tokens_of(F.col("url")).alias("tokens"), "bad").filter(F.size("tokens") > 0)
    baskets = stash(rows.select(F.concat("tokens", F.array(F.when(F.col("bad"), BLOCK).otherwise(ALLOW))).alias("items")), "baskets")
    n = baskets.count()
    support = min(1.0, max(min_support, least / max(n, 1)))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.filter(F.col("consequent")[0].isin(BLOCK, ALLOW))
    rules = stash(
        found.select(F.array_sort("antecedent").alias("antecedent"), F.when(F.col("consequent")[0] == BLOCK, "block").otherwise("allow").alias("verdict"), "confidence", "support"),
        "rules",
    )
    # a rule adds nothing if it leaves a token out and is as confident: look each shorter set up by equality
    shorter = rules.select("verdict", "confidence", "antecedent", F.explode("antecedent").alias("t")).filter(F.size("antecedent") > 1)
    shorter = shorter.select("verdict", "confidence", "antecedent", F.array_remove("antecedent", F.col("t")).alias("part"))
    part = rules.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("c"))
    idle = shorter.join(part, ["part", "verdict"]).filter("c >= confidence").select("antecedent", "verdict").distinct()
    return rules.join(idle, ["antecedent", "verdict"], "left_anti").select("antecedent", "verdict", "confidence", "support")


def posted(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """The inverted index: each rule under the rarest of its tokens among the labelled URLs."""
    count = labelled.select(F.explode(tokens_of(F.col("url"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    keyed = rules.select("*", F.explode("antecedent").alias("token")).join(count, "token", "left")
    return keyed.groupBy("antecedent", "verdict", "confidence", "support").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))


def _better() -> Column:
    """Sort key of a matched rule: most confidence, support and tokens, block before allow, then by name."""
    return F.struct(F.col("confidence"), F.col("support"), F.size("antecedent"), F.col("verdict"), F.array_join("antecedent", " "))


def learned(pages: DataFrame, index: DataFrame, inline: int = INLINE) -> DataFrame:
    """Add ``learned`` (verdict of the best mined rule, or null) to rows with ``url``."""
    head = index.orderBy(F.desc("confidence"), F.desc("support"), F.desc(F.size("antecedent")), F.desc("verdict"), F.desc(F.array_join("antecedent", " "))).limit(inline + 1).collect()
    if not head:
        return pages.withColumn("learned", F.lit(None).cast("string"))
    # URLs have far fewer token sets than there are URLs: each set is judged once and joined back
    tokens = F.col("_tokens")
    keyed = pages.withColumn("_tokens", tokens_of(F.col("url")))
    sets = stash(keyed.select("_tokens").distinct(), "token-sets")
    if len(head) > inline:
        hit = sets.select("_tokens", F.explode("_tokens").alias("token")).join(index, "token").filter(F.size(F.array_except("antecedent", "_tokens")) == 0)
        judged = hit.groupBy("_tokens").agg(F.max_by("verdict", _better()).alias("learned"))
    else:
        posts: dict[str, list[int]] = {}
        for i, r in enumerate(head):
            posts.setdefault(r["token"], []).append(i)
        index_map = F.create_map(*(x for t, ids in posts.items() for x in (F.lit(t), F.array(*map(F.lit, ids)))))
        needs = F.array(*(F.array(*map(F.lit, r["antecedent"])) for r in head))
        verdicts = F.array(*(F.lit(r["verdict"]) for r in head))
        asked = F.flatten(F.array_compact(F.transform(tokens, lambda t: F.try_element_at(index_map, t))))
        met = F.filter(asked, lambda i: F.size(F.array_except(F.get(needs, i), tokens)) == 0)
        judged = sets.select("_tokens", F.get(verdicts, F.array_min(met)).alias("learned"))
    return keyed.join(judged, "_tokens", "left").drop("_tokens")


def judge(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """``host, path, rule, verdict, learned`` for every row with a ``url``."""
    out = learned(pages, posted(mine(labelled), labelled))
    out = out.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    out = out.withColumn("_fixed", fixed_rule(F.col("host"), F.col("path")))
    return out.withColumns({"rule": F.col("_fixed.rule"), "verdict": F.coalesce("_fixed.verdict", "learned", F.lit("allow"))}).drop("_fixed")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """A page shows the document whose number ends its path; a label of that document is the page's."""
    number = F.try_to_number(F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})[^/]*/?$", 1), F.lit("9" * 18)).cast("long")
    marks = labels.groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("bad"))
    return pages.select("url", number.alias("doc_id")).join(marks, "doc_id").select("url", "bad")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge(pages, labelled_urls(pages, table(spark, sf_dir, "labels")))
    return out.select("page_id", "host", "path", "rule", "verdict")
