"""Document fingerprints by Order MinHash, in DataFrame functions alone.

Method. A text's k-mers are ``K`` consecutive words, numbered by occurrence, so that a repeated k-mer
counts as often as it stands. Numbered k-mers are put in order by their hash. Each of ``2**BITS``
entries starts from a point of its own in hash space and takes the ``PICKS`` k-mers that follow it,
round the end, which are the minimal ones under that rotation of the hash. Their k-mers are put back
in text order and hashed as a tuple: two texts agree in an entry if they hold the same picks in the
same order, so moved passages count as changes, which they do not in a set signature.

Two texts that have a share J of their numbered k-mers in common, in order, agree in J**PICKS of all
entries. ``likeness`` inverts this and gives 2J / (1 + J), the share of one text that is kept in the
other: about a half for a text whose second half was replaced.

Words are runs of other than blanks, cut at ``WORD_CHARS`` characters so that a text without blanks
has k-mers too. A text of fewer than K words has one k-mer of all of them, one without words has
none; two texts without words are alike (1), one of them is unlike any other text (0).

The next document is found by narrow rows (id, length, hash of the text, place in the files) in
ranges of ids, so equal ids are no hot key; texts meet once, by place.

Cases. Null texts are empty ones. Ids in order, null ids last; rows of one id in order of their text's
hash, and rows equal in both are told apart by their place. One document is its own next. Texts are
taken whole, whatever their length. Empty tables give no rows. Columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import table
from shelfmark.llm.positions import FILE, ROW, placed
from shelfmark.session import stash

K, PICKS, BITS, WORD_CHARS = 3, 2, 6, 16
#: Low bits of a packed k-mer: its place in the text, which a string of 2 GB cannot exceed. The rest is its hash.
PLACE_BITS = 30


def signature(df: DataFrame, text: str, out: str, k: int = K, picks: int = PICKS, bits: int = BITS) -> DataFrame:
    """Add ``out``, an array of ``2**bits`` entries of 32 bits, for the string column ``text``.

    Each step is a projection of its own, so that none is evaluated twice.
    """
    low = (1 << PLACE_BITS) - 1
    keep = [F.col(f"`{c}`") for c in df.columns]

    def step(frame: DataFrame, **made: str) -> DataFrame:
        return frame.select(*keep, *(F.expr(e).alias(c) for c, e in made.items()))

    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{WORD_CHARS}}}"), F.lit(0))
    df = df.select(*keep, words.alias("_w"))
    at = ", ".join(f"_w[i + {j}]" for j in range(k))
    pack = f"(({{}}) & {~low}L) | {{}}"
    df = step(
        df,
        _kmers=f"""CASE WHEN size(_w) >= {k} THEN transform(sequence(0, size(_w) - {k}), i -> {pack.format(f"xxhash64({at})", "i")})
                        WHEN size(_w) > 0 THEN array(xxhash64(_w) & {~low}L) ELSE array() END""",
    )
    df = step(df, _kmers="_kmers", _s="sort_array(_kmers)")
    # where the k-mer is that before it, or of another entry: both show in the bits that differ
    df = step(
        df,
        _kmers="_kmers",
        _s="_s",
        _marks=f"CASE WHEN size(_s) > 1 THEN filter(sequence(1, size(_s) - 1), i -> width_bucket(shiftrightunsigned(_s[i] ^ _s[i - 1], {PLACE_BITS}), 1, {1 << 64 - bits - PLACE_BITS}, 1) != 1) ELSE array() END",
    )
    repeat = f"shiftrightunsigned(_s[i] ^ _s[i - 1], {PLACE_BITS}) = 0"
    df = step(df, _kmers="_kmers", _s="_s", _marks="_marks", _again=f"filter(_marks, i -> {repeat})")
    # occurrence numbers of repeats: 1, 2, .. within each run of one k-mer, whose places in order are consecutive
    df = step(
        df,
        _kmers="_kmers",
        _s="_s",
        _marks="_marks",
        _again="_again",
        _runs="CASE WHEN size(_again) > 0 THEN filter(sequence(0, size(_again) - 1), j -> j = 0 OR _again[j] != _again[j - 1] + 1) ELSE array() END",
    )
    df = step(
        df,
        _kmers="_kmers",
        _s="_s",
        _marks="_marks",
        _again="_again",
        _number="flatten(transform(_runs, (a, j) -> sequence(1, coalesce(get(_runs, j + 1), size(_again)) - a)))",
    )
    numbered = pack.format(f"xxhash64(shiftright(_s[i], {PLACE_BITS}), cast(n as bigint))", f"(_s[i] & {low}L)")
    others = "flatten(transform(concat(array(-1), _again), (a, j) -> slice(_s, a + 2, coalesce(get(_again, j), size(_s)) - a - 1)))"
    df = step(
        df,
        _kmers="_kmers",
        _t=f"CASE WHEN size(_again) = 0 THEN _s ELSE sort_array(concat({others}, zip_with(_again, _number, (i, n) -> {numbered}))) END",
        _firsts="CASE WHEN size(_again) = 0 THEN _marks END",
    )
    entry = f"(shiftright({{}}, {64 - bits}) + {1 << bits - 1})"  # the entry whose point lies at or below a hash
    df = step(
        df,
        _kmers="_kmers",
        _t="_t",
        _edges=f"""CASE WHEN size(_t) = 0 THEN array() WHEN _firsts IS NOT NULL THEN concat(array(0), _firsts) WHEN size(_t) = 1 THEN array(0)
                        ELSE concat(array(0), filter(sequence(1, size(_t) - 1), i -> shiftrightunsigned(_t[i] ^ _t[i - 1], {64 - bits}) != 0)) END""",
    )
    before = f"coalesce({entry.format('get(_t, get(_edges, j - 1))')}, -1)"
    df = step(
        df,
        _kmers="_kmers",
        _t="_t",
        _starts=f"""CASE WHEN size(_t) > 0 THEN concat(
                        flatten(transform(_edges, (a, j) -> array_repeat(a, cast({entry.format("_t[a]")} - {before} as int)))),
                        array_repeat(0, cast({(1 << bits) - 1} - {entry.format("element_at(_t, -1)")} as int))) ELSE array_repeat(-1, {1 << bits}) END""",
    )
    picked = f"array_sort(transform(sequence(0, least({picks}, size(_t)) - 1), p -> _t[(a + p) % size(_t)] & {low}L))"
    made = f"xxhash64(transform({picked}, q -> shiftright(_kmers[cast(q as int)], {PLACE_BITS})))"
    return step(df, **{out: f"transform(_starts, a -> CASE WHEN a < 0 THEN 0 ELSE cast(shiftright({made}, 32) as int) END)"})


def fingerprint(entries: Column) -> Column:
    """Eight hex digits an entry."""
    return F.array_join(F.transform(entries, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column, picks: int = PICKS) -> Column:
    """The share of one text that is kept in the other, in order, as their entries tell (0 to 1)."""
    agree = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    j = F.pow(agree / F.size(a), F.lit(1.0 / picks))
    return 2 * j / (1 + j)


def next_places(rows: DataFrame) -> DataFrame:
    """``place, doc_id, n`` of each row, and the place and length of the row before it in order (of the first: the last)."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("h").asc(), F.col(FILE).asc(), F.col(ROW).asc()]
    ranges = stash(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("part").orderBy(*order)
    me = F.struct(F.col(FILE).alias("f"), F.col(ROW).alias("r"), F.col("n").alias("n"))
    key = F.struct(F.col("doc_id").isNull(), "doc_id", "h", FILE, ROW)
    # one row a range: its last document, handed to the range after it
    tails = ranges.groupBy("part").agg(F.max_by(me, key).alias("tail"))
    in_order = Window.orderBy("part")
    tails = tails.select("part", F.coalesce(F.lag("tail").over(in_order), F.last("tail").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("tail"))
    found = ranges.withColumn("prev", F.lag(me).over(within)).join(F.broadcast(tails), "part")
    prev = F.coalesce("prev", "tail")
    return found.select(FILE, ROW, "doc_id", "n", prev["f"].alias("prev_file"), prev["r"].alias("prev_row"), prev["n"].alias("prev_n"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document, its text whose second half comes from the start of the next document, and both signatures.

    ``doc_id, n_chars, edited, sig, edited_sig, next_sig``.
    """
    text = F.coalesce("text", F.lit(""))
    rows = placed(docs).select(FILE, ROW, "doc_id", text.alias("text"))
    narrow = rows.select(FILE, ROW, "doc_id", F.length("text").alias("n"), F.xxhash64("text").alias("h"))
    signed = signature(rows.select(FILE, ROW, "text"), "text", "sig").select(FILE, ROW, "sig")
    places = stash(signed.join(next_places(narrow), [FILE, ROW]), "signed")  # read twice
    met = rows.select(FILE, ROW, "text").join(places, [FILE, ROW])
    own = met.select(FILE, ROW, "doc_id", "n", "sig", F.expr("substring(text, 1, cast(n - n div 2 as int))").alias("head"))
    given = met.select(F.col("prev_file").alias(FILE), F.col("prev_row").alias(ROW), F.expr("substring(text, 1, cast(prev_n div 2 as int))").alias("tail"), F.col("sig").alias("next_sig"))
    both = own.join(given, [FILE, ROW]).select("doc_id", F.col("n").cast("long").alias("n_chars"), F.concat("head", "tail").alias("edited"), "sig", "next_sig")
    return signature(both, "edited", "edited_sig")


def op12_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sig")).alias("fingerprint"),
        fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
