"""Normalisers and extractors as column expressions; null counts as the empty string throughout."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import fixed_values as V

#: White space of the data model: Java's \s lacks the non-breaking and ideographic blanks.
WS = r"[\s\u00A0\uFEFF\p{Z}]"


def blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def truthy(c: Column) -> Column:
    """A string that is neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def sub(c: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(c, pattern, by)


def trim(c: Column) -> Column:
    return sub(c, rf"^{WS}+|{WS}+\z")


def words_of(pattern: str) -> str:
    """A case-blind search for whole words, with ASCII boundaries."""
    return f"(?i){V.B0}(?:{pattern}){V.B1}"


def normalise_title(t: Column) -> Column:
    return F.trim(sub(F.lower(blank(t)), "[^a-z0-9]+", " "))


def facet_title(t: Column) -> Column:
    """As normalise_title, without a leading product-line word: another key."""
    return F.trim(sub(sub(F.lower(blank(t)), r"^pop!?\s+"), "[^a-z0-9]+", " "))


def sanitise(t: Column) -> Column:
    return trim(sub(blank(t), f"{WS}+", " "))


def clean_price(raw: Column) -> Column:
    """The last dollar amount of a text that tells of a reduction, else the first; '' if none."""
    found = F.transform(F.regexp_extract_all(blank(raw), F.lit(r"(\$\s*\d+\.\d{2})"), 1), lambda m: sub(m, "[^0-9.]"))
    reduced = blank(raw).rlike(r"(?i)reduced|off|" + V.B0 + "to" + V.B1)
    return F.coalesce(F.when(reduced, F.get(F.reverse(found), F.lit(0))).otherwise(F.get(found, F.lit(0))), F.lit(""))


def dirty_price(p: Column) -> Column:
    return truthy(p) & (p.contains("\n") | p.rlike("(?i)reduced|off") | (F.length(p) > 12))


def pop_type(title: Column) -> Column:
    """Struct (popType, name) of a title."""
    t = trim(blank(title))
    sub_type = trim(sub(F.regexp_extract(t, V.POP_SUBTYPES, 1), r"\s+", " "))
    named = F.when(sub_type != "", trim(sub(t, V.POP_SUBTYPES))).otherwise(trim(sub(t, r"(?i)^Pop!\s+")))
    return F.struct(F.when(sub_type != "", sub_type).otherwise("Standard").alias("popType"), named.alias("name"))


def search_query(title: Column, number: Column) -> Column:
    base = trim(sub(sub(sub(blank(title), r"[\(\[][^\)\]]*[\)\]]", " "), r"#\s*\d+", " "), r"\s+", " "))
    n = sub(blank(number), "[^0-9]")
    return F.concat(base, F.when(n != "", F.concat(F.lit(" #"), n)).otherwise(""), F.lit(" funko"))


def variant_tokens(title: Column) -> Column:
    """Words in brackets, in order, repeats kept."""
    parts = F.regexp_extract_all(blank(title), F.lit(r"[\(\[]([^\)\]]*)[\)\]]"), 1)
    words = F.flatten(F.transform(parts, lambda p: F.split(p, r"\s+")))
    made = F.transform(words, lambda w: sub(F.lower(w), "[^a-z0-9]"))
    return F.filter(made, lambda w: (w != "") & ~w.isin(*V.VARIANT_STOPWORDS))


def core_tokens(title: Column) -> Column:
    """Words of a name without brackets, number, line tail and stopwords."""
    t = sub(sub(sub(blank(title), r"[\(\[][^\)\]]*[\)\]]", " "), r"#\s*\d+", " "), r"(?i)funko\s+pop.*", " ")
    return F.filter(F.split(F.lower(t), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(*V.NAME_STOPWORDS))


def _five_entities(t: Column) -> Column:
    for name, char in (("amp", "&"), ("quot", '"'), ("#39", "'"), ("lt", "<"), ("gt", ">")):
        t = sub(t, f"(?i)&{name};", char)
    return t


def core_name(title: Column) -> Column:
    t = sub(sub(F.lower(_five_entities(blank(title))), r"#\s*\d+[a-z]?", " "), r"\[[^\]]*\]", " ")
    # the last of these words ends in a mark, after which a boundary needs a word character
    t = sub(t, rf"{V.B0}(?:bottle opener|box|pop! protector){V.B1}", " ")
    return F.trim(sub(t, "[^a-z0-9]+", " "))


def core_no_parens(title: Column) -> Column:
    return core_name(sub(blank(title), r"\([^)]*\)", " "))


def _no_zeros(n: Column) -> Column:
    return F.when(truthy(n), F.coalesce(F.nullif(sub(n, "^0+"), F.lit("")), F.lit("0")))


def number_of(verified: Column, title: Column, from_title: Column | None = None) -> Column:
    in_title = F.nullif(F.regexp_extract(blank(title), r"#\s*(\d+)", 1), F.lit(""))
    found = [_no_zeros(verified.cast("string"))] + ([_no_zeros(from_title.cast("string"))] if from_title is not None else [])
    return F.coalesce(*found, _no_zeros(in_title), F.lit(""))


def normalise_upc(raw: Column) -> Column:
    groups = F.split(blank(raw), "[^0-9]+")
    good = F.get(F.filter(groups, lambda g: F.length(g).isin(12, 13)), F.lit(0))
    digits = sub(blank(raw), "[^0-9]")
    return F.coalesce(good, F.when(F.length(digits) >= 12, F.substring(digits, 1, 12)))


def valid_upc(upc: Column) -> Column:
    """12 digits with a right check digit, or 13 digits."""
    u = blank(upc)
    total = sum((F.substring(u, i + 1, 1).try_cast("int") * (3 if i % 2 == 0 else 1) for i in range(11)), F.lit(0))
    check = (10 - total % 10) % 10 == F.substring(u, 12, 1).try_cast("int")
    return F.when(u.rlike(r"^\d{13}\z"), True).when(u.rlike(r"^\d{12}\z"), check).otherwise(False)


def usable_upc(upc: Column) -> Column:
    """The looser rule of the coverage report."""
    return F.trim(blank(upc)).rlike(r"^\d{11,13}\z")


def _decode_one(m: re.Match) -> str:
    code = m[1]
    if code[0] != "#":
        return V.ENTITIES.get(code.lower(), m[0])
    number = int(code[2:], 16) if code[1] in "xX" else int(code[1:]) if code[1:].isdigit() else -1
    return chr(number) if 0 <= number <= 0x10FFFF and not 0xD800 <= number < 0xE000 else m[0]


@F.pandas_udf(T.StringType())
def _decode(s: pd.Series) -> pd.Series:
    rx = re.compile(r"&(#x?[0-9a-f]+|[a-z]+);", re.IGNORECASE)
    return s.map(lambda t: t if t is None or "&" not in t else rx.sub(_decode_one, t))


def decode_entities(t: Column) -> Column:
    """Named and numbered references in one pass; unknown ones stay. Python, as Spark has no such function."""
    return _decode(t)


def clean_decoded(t: Column) -> Column:
    """What cleaning a title does after entities are decoded."""
    s = F.translate(t, "\u2018\u2019\u201c\u201d", "''\"\"")
    s = sub(s, rf"(?i)^(?:Funko{WS}+)?Pop!?{WS}+(?!{WS}|\z)")
    s = sub(s, rf"(?i){WS}*\(Bobble-?Head\){WS}*\z")
    return trim(sub(s, WS + "{2,}", " "))


def clean_title(t: Column) -> Column:
    return clean_decoded(decode_entities(t))


TITLE_NUMBER = r"\s*#(\d{1,6})" + V.B1


def number_in_title(t: Column) -> Column:
    return F.nullif(F.regexp_extract(blank(t), TITLE_NUMBER, 1), F.lit(""))


def without_number(t: Column) -> Column:
    """The title less its first number."""
    return trim(sub(sub(blank(t), rf"(?s)\A(.*?){TITLE_NUMBER}", "$1"), WS + "{2,}", " "))


@F.pandas_udf(T.StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else "".join(c for c in unicodedata.normalize("NFD", t) if not "\u0300" <= c <= "\u036f"))


#: What a handle's parts become, in turn.
HANDLE_PARTS = ((r"-?&amp;-?", "-"), (r"-?&[a-z]+;-?", "-"), (r"-?\[[^\]]*\]-?", "-"), (r"[()]", ""), (r"-?#\d*-?", "-"), (",", ""), (r"['\u2018\u2019./:]", "-"))


def url_handle(handle: Column) -> Column:
    h = blank(handle)
    for pattern, by in HANDLE_PARTS:
        h = sub(h, pattern, by)
    return sub(sub(strip_accents(h), "-+", "-"), r"^-|-\z")


def slug_label(slug: Column) -> Column:
    acronyms = F.create_map(*(F.lit(x) for kv in V.CONSOLE_ACRONYMS.items() for x in kv))
    label = lambda w: F.coalesce(F.try_element_at(acronyms, w), F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w))))
    return F.array_join(F.transform(F.split(slug, "-"), label), " ")


def url_slug(url: Column) -> Column:
    return F.regexp_extract(blank(url), r"/game/funko-pop-([a-z0-9-]+)/", 1)


def category_of(console: Column, url: Column) -> Column:
    slug = F.when(truthy(console), F.regexp_extract(console, r"(?s)^funko-pop-(.+)\z", 1)).otherwise(url_slug(url))
    return F.when(slug != "", F.concat(F.lit("Pop! "), slug_label(slug))).otherwise("")


def franchise_from_url(url: Column) -> Column:
    slug = url_slug(url)
    return F.when((slug == "") | slug.isin(*V.UMBRELLA_CONSOLES), "").otherwise(slug_label(slug))


def franchise_from_series(series: Column) -> Column:
    seg = trim(F.split(blank(series), "[.,]")[0])
    low = F.lower(seg)
    event = F.lit(False)
    for k in V.SERIES_EVENT_KW:
        event = event | low.contains(k)
    return F.when(low.isin(*V.SERIES_HARD_NOISE) | ((F.size(F.split(seg, r"\s+")) <= 4) & event), "").otherwise(seg)


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")


def named_date(raw: Column) -> Column:
    """``yyyy-M-d`` of a date with a month's name, in any order and with or without a weekday; without a day its first one.

    Names count by their first three letters. Of two numbers the one that is no day is the year; a year of two
    digits is one of 1950 to 2049. With anything else in the text it is no date.
    """
    t = F.lower(trim(blank(raw)))
    number = lambda i: F.get(F.regexp_extract_all(t, F.lit(r"\d+"), 0), F.lit(i)).try_cast("int")
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(t, rf"\b({'|'.join(MONTHS)})", 1))
    one, two = number(0), number(1)
    year_first = two.isNull() | (one > 31)
    year, day = F.when(year_first, one).otherwise(two), F.when(two.isNull(), 1).when(one > 31, two).otherwise(one)
    year = F.when(year < 50, year + 2000).when(year < 100, year + 1900).otherwise(year)
    word = rf"(?:{'|'.join(MONTHS)})[a-z]*\.?"
    rest = rf"(?:(?:{'|'.join(WEEKDAYS)})[a-z]*[,.]?\s+)?"
    plain = t.rlike(rf"^{rest}(?:{word}(?:[\s,-]+\d{{1,2}})?[\s,-]+\d{{2,4}}|\d{{1,2}}[\s,-]+{word}[\s,-]+\d{{2,4}}|\d{{3,4}}[\s,-]+{word}(?:[\s,-]+\d{{1,2}})?)$")
    return F.when(plain, F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month.cast("string"), day.cast("string")))


def release_date(raw: Column) -> Column:
    """The calendar date of a text in the forms that people write: by numbers, year first or month first, or with a month's name."""
    t = trim(blank(raw))
    forms = ("yyyy-MM-dd", "yyyy-MM", "yyyy", "yyyy/M/d", "M/d/yyyy", "M-d-yyyy")
    return F.coalesce(*(F.try_to_date(t, f) for f in forms), F.try_to_date(named_date(raw), "yyyy-M-d")).cast("string")


def digits(c: Column) -> Column:
    return sub(blank(c), "[^0-9]")


def id_tail(c: Column) -> Column:
    """Trailing digits of an id, or the id."""
    return F.coalesce(F.nullif(F.regexp_extract(blank(c), r"(\d+)\z", 1), F.lit("")), blank(c))


def pct(part: Column, whole: Column) -> Column:
    """Per cent with one decimal, half up; 0% of nothing."""
    tenths = F.expr("cast(1 as bigint)") * F.floor((2000 * part + whole) / (2 * whole))
    return F.when(whole == 0, "0%").otherwise(F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%")))
