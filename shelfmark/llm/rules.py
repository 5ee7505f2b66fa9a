"""Quality rules with thresholds that adapt to language and source.

Method. Each text gives four whole-number measures: thousandths of a character of mean word length,
and hundred-thousandths of symbols, of repeated lines and of words in repeated windows. Texts that pass
the base rules go into a log-linear histogram for each language, source and measure (seven leading
bits, so values are at most 1/64 off); such sketches merge by adding counts, in any order, to the same
result. Fences are read from them and from nothing else: a quantile of the group, and as many times
as ``MEASURES`` says its distance from the median beyond it. For word length there is one on either
side. Where the quantile is the median, its distance says nothing: the fence is then half way from
there to the lower quarter of what the sketch has beyond, and at least one cell away, so it never has
width zero in a group that has anything beyond. A text is kept if each of its measures' cells lies within the fences of its language and
source. Sources with under ``least`` such texts use the merged sketch of their language, small
languages that of the corpus.

The levels say which part of a group is looked on as its bulk, not what value is too much: where a
tenth of a source is full of symbols, that is how the source is. Repeats have no bulk but zero, and
labels show no tie between them and quality, so only what lies far beyond a group's last thousandth is
rejected for them.

Cases. Null and empty texts have no words: base_failed. A null language or source is a group of its
own. A text of any length is measured whole. Repeated rows are measured each and count each. A group
without a text that passes the base rules has nothing to judge. An empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import as_bytes, per_batch, table
from shelfmark.session import stash

LEAST = 50
#: Measure: (thousandths of the group up to the fence's quantile, how many times its distance from the median lies beyond, a lower fence too).
MEASURES: dict[str, tuple[int, int, bool]] = {"mean_len": (900, 3, True), "symbol_share": (900, 3, False), "dup_share": (999, 3, False), "repeat_share": (999, 3, False)}
#: Thousandths of what lies beyond the median, where the quantile is the median: half way there is the fence.
BEYOND = 250
BITS = 7
WINDOW_WORDS = 8
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(c for c in range(256) if c not in SYMBOLS)


def repeated_words(words: list[bytes], width: int = WINDOW_WORDS) -> int:
    """Words in windows that are found twice or more.

    Windows are compared exactly: pairs of ids become ids of twice the length, three times over.
    """
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    step = 1
    while step < width:
        _, ids = np.unique(ids[:-step] * (ids.max() + 1) + ids[step:], return_inverse=True)
        step *= 2
    hit = np.bincount(ids)[ids] > 1
    if not hit.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measures(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.split()
    chars = len(b"".join(words).decode())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, len(text.translate(None, _NOT_SYMBOL)), len(lines) - len(set(lines)), repeated_words(words), len(lines)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

    def make():
        def run(batch: pa.RecordBatch) -> dict[str, list]:
            got = [measures(t) for t in as_bytes(batch.column("text"))]
            return {n: [g[i] for g in got] for i, n in enumerate(names)}

        return run

    return per_batch(docs.select(*dict.fromkeys([*keep, "text"])), make, ", ".join(f"{n} long" for n in names), keep)


def shares() -> dict[str, Column]:
    part = lambda a, b, k: F.when(F.col(b) > 0, F.expr(f"{k} * {a} div {b}")).otherwise(F.lit(0)).cast("long")
    return {"mean_len": part("word_chars", "n_words", 1000), "symbol_share": part("n_symbols", "word_chars", 100_000), "dup_share": part("n_dup_lines", "n_lines", 100_000), "repeat_share": part("n_repeat_words", "n_words", 100_000)}


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def bin_of(value: Column) -> Column:
    """The lower end of the value's cell in the log-linear sketch."""
    drop = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(rows: DataFrame) -> DataFrame:
    """``(level, lang, source, measure, bin, n)``; level 0: language and source, 1: language, 2: all."""
    cells = F.array(*(F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in MEASURES))
    fine = rows.select("lang", "source", F.explode(cells).alias("x")).groupBy("lang", "source", "x.measure", "x.bin").agg(F.count("*").alias("n"))
    none = F.lit(None).cast("string")
    levels = F.array(*(F.struct(F.lit(i).alias("level"), a.alias("lang"), b.alias("source")) for i, (a, b) in enumerate(((F.col("lang"), F.col("source")), (F.col("lang"), none), (none, none)))))
    return fine.select(F.explode(levels).alias("g"), "measure", "bin", "n").groupBy("g.level", "g.lang", "g.source", "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, least: int = LEAST) -> DataFrame:
    """One row of lower and upper bounds, as cells, for each language and source."""
    group = ["level", "lang", "source", "measure"]
    run = Window.partitionBy(*group).orderBy("bin")
    s = sketch.withColumn("upto", F.sum("n").over(run)).withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    at = lambda level: F.min(F.when(F.col("upto") * 1000 >= F.col("total") * level, F.col("bin")))
    level = F.lit(None).cast("int")
    for m, (l, _, _) in MEASURES.items():
        level = F.when(F.col("measure") == m, l).otherwise(level)
    q = s.withColumn("high", level).groupBy(*group).agg(F.max("total").alias("total"), at(1000 - F.col("high")).alias("low"), at(F.lit(500)).alias("mid"), at(F.col("high")).alias("top"))
    beyond = s.join(q.filter("top = mid").select(*(F.col(g).alias(f"_{g}") for g in group), "top"), reduce(and_, (F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group))).filter("bin > top")
    past = F.sum("n").over(run)
    rest = beyond.withColumns({"past": past, "all": F.sum("n").over(Window.partitionBy(*group))}).groupBy(*group).agg(F.min(F.when(F.col("past") * 1000 >= F.col("all") * BEYOND, F.col("bin"))).alias("next"))
    rest = rest.select(*(F.col(g).alias(f"_{g}") for g in group), "next")
    q = q.join(rest, reduce(and_, (F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group)), "left").drop(*(f"_{g}" for g in group))
    half = F.col("top") + F.greatest(F.lit(1), F.expr("(next - top) div 2"))
    upper = {m: F.when(F.col("next").isNotNull(), half).otherwise(F.col("top") + reach * (F.col("top") - F.col("mid"))) for m, (_, reach, _) in MEASURES.items()}
    lower = {m: F.col("low") - reach * (F.col("mid") - F.col("low")) if both else F.lit(0) for m, (_, reach, both) in MEASURES.items()}
    wide = q.groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"),
        *(F.max(F.when(F.col("measure") == m, v)).alias(f"{m}_lo") for m, v in lower.items()),
        *(F.max(F.when(F.col("measure") == m, v)).alias(f"{m}_hi") for m, v in upper.items()),
    )
    bounds = [c for c in wide.columns if c.endswith(("_lo", "_hi"))]
    groups = wide.filter("level = 0").select("lang", "source")
    none = F.lit(None).cast("string")
    ladder = ((F.col("lang"), F.col("source")), (F.col("lang"), none), (none, none))
    steps = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), a.alias("l"), b.alias("s")) for i, (a, b) in enumerate(ladder))))
    asked = groups.select("lang", "source", steps.alias("g")).alias("a")
    w = wide.alias("w")
    met = asked.join(w, (F.col("a.g.level") == F.col("w.level")) & F.col("a.g.l").eqNullSafe(F.col("w.lang")) & F.col("a.g.s").eqNullSafe(F.col("w.source")))
    met = met.filter((F.col("w.total") >= least) | (F.col("w.level") == 2))
    best = met.groupBy("a.lang", "a.source").agg(F.min_by(F.struct(*(F.col(f"w.{b}").alias(b) for b in bounds)), F.col("w.level")).alias("b"))
    return best.select(F.col("lang").alias("_q_lang"), F.col("source").alias("_q_source"), "b.*")


def judge(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """Add the measures, the fences and ``base_failed, kept`` to measured rows that have ``lang, source``."""
    rows = stash(rows.withColumns(shares()).withColumn("base_failed", base_failed()), "measured")
    bounds = fences(sketches(rows.filter("not base_failed")), least)
    out = rows.join(bounds, F.col("lang").eqNullSafe(F.col("_q_lang")) & F.col("source").eqNullSafe(F.col("_q_source")), "left").drop("_q_lang", "_q_source")
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & bin_of(F.col(m)).between(F.col(f"{m}_lo"), F.col(f"{m}_hi"))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    out = judge(measured(docs, ["doc_id", "lang", "source"]))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT rid, i, len(w) AS n, CASE WHEN i + 7 <= len(w) THEN array_to_string(w[i:i + 7], ' ') END AS win FROM p),
c AS (SELECT rid, i, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY rid, win) > 1 THEN 1 ELSE 0 END AS hit FROM k),
v AS (SELECT rid, max(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS cov FROM c),
rep AS (SELECT rid, sum(cov)::BIGINT AS n FROM v GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT rid, count(*)::BIGINT AS n, (count(*) - count(DISTINCT line))::BIGINT AS dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT d.rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(ln.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(ln.n, 0) AS n_lines
      FROM d LEFT JOIN rep USING (rid) LEFT JOIN ln USING (rid)),
-- four rows a text: the measure and its value with all but the seven leading bits cleared
x AS (SELECT rid, doc_id, lang, source, base_failed, measure, v - v % (1::BIGINT << greatest(floor(log2(greatest(v, 1)) + 1e-9)::INTEGER - 6, 0)) AS cell
      FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
              unnest(['mean_len', 'symbol_share', 'dup_share', 'repeat_share']) AS measure,
              unnest([coalesce(1000 * word_chars // nullif(n_words, 0), 0), coalesce(100000 * n_symbols // nullif(word_chars, 0), 0),
                      coalesce(100000 * n_dup_lines // nullif(n_lines, 0), 0), coalesce(100000 * n_repeat_words // nullif(n_words, 0), 0)]) AS v
            FROM m)),
g AS (SELECT lang, source, measure, list_sort(list(cell)) AS cells FROM x WHERE NOT base_failed GROUP BY ALL),
g1 AS (SELECT lang, measure, list_sort(flatten(list(cells))) AS cells FROM g GROUP BY ALL),
g2 AS (SELECT measure, list_sort(flatten(list(cells))) AS cells FROM g GROUP BY ALL),
-- sorted cells of the group that is large enough; a quantile is the first cell with that share of texts up to it
s AS (SELECT g.lang, g.source, g.measure, CASE WHEN len(g.cells) >= 50 THEN g.cells WHEN len(g1.cells) >= 50 THEN g1.cells ELSE g2.cells END AS c
      FROM g JOIN g1 ON g1.measure = g.measure AND g1.lang IS NOT DISTINCT FROM g.lang JOIN g2 ON g2.measure = g.measure),
f AS (SELECT lang, source, measure,
        CASE WHEN measure = 'mean_len' THEN q10 - 3 * (q50 - q10) ELSE 0 END AS lo,
        CASE WHEN qt = q50 AND len(far) > 0 THEN qt + greatest(1, (far[(len(far) * 250 + 999) // 1000] - qt) // 2) ELSE qt + 3 * (qt - q50) END AS hi
      FROM (SELECT *, list_filter(c, lambda v: v > qt) AS far
            FROM (SELECT lang, source, measure, c, c[greatest((len(c) * 100 + 999) // 1000, 1)] AS q10, c[(len(c) * 500 + 999) // 1000] AS q50,
                    c[(len(c) * CASE WHEN measure IN ('mean_len', 'symbol_share') THEN 900 ELSE 999 END + 999) // 1000] AS qt FROM s))),
o AS (SELECT x.rid, bool_and(cell BETWEEN lo AND hi) AS inside
      FROM x JOIN f ON f.measure = x.measure AND f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source GROUP BY x.rid)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND coalesce(inside, true) AS kept
FROM m LEFT JOIN o USING (rid)
"""
