"""Every catalog query against its SQL on the smallest tables."""

import decimal
import math
import os
import re
import unicodedata

import duckdb
import pytest

from shelfmark.plans import catalog_queries as Q
from shelfmark.plans import page_queries  # noqa: F401  (adds its queries to the same tables)

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return int(v) if isinstance(v, float) and v == int(v) else v


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, DIR)
    cursor = duck.execute(Q.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(plain(r[names.index(k)]) for k in sorted(names)) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(plain(r[k]) for k in sorted(names)) for r in df.collect()), key=repr)
    assert got == want


def test_upsert_query_conserves_rows(spark):
    n = Q.read(spark, DIR, "part").count()
    assert 0 < Q.q_upsert(spark, DIR).count() <= n


def brute_handle(text, doc_id):
    """The reference's replacements, one by one."""
    h = (text or "").lower().replace(" ", "-") + f"-(#{doc_id}-x)"
    for pattern, by in ((r"-?&amp;-?", "-"), (r"-?&[a-z]+;-?", "-"), (r"-?\[[^\]]*\]-?", "-"), (r"[()]", ""), (r"-?#[0-9]*-?", "-"), (",", ""), ("['\u2018\u2019]", "-"), (r"\.", "-"), ("/", "-"), (":", "-")):
        h = re.sub(pattern, by, h)
    h = re.sub("[\u0300-\u036f]", "", unicodedata.normalize("NFD", h))
    return re.sub(r"^-|-\Z", "", re.sub("-+", "-", h))


def test_url_handle_takes_whole_documents(spark, tmp_path):
    texts = ["Beauty &amp; the Beast", "Salt &copy; Pepper", "Stitch [NYCC] Baker", "a/b: c", "[a\nb] line\nline [open", "Mr. Freeze, it's \u2018x\u2019", "long " * 20 + "caf\u00e9 #125 &amp; [x] end.", "", None, "\u65e5\u672c & \u2603 caf\u00e9"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for sf in (str(tmp_path), DIR):
        want = sorted((r["doc_id"], brute_handle(r["text"], r["doc_id"])) for r in Q.read(spark, sf, "documents").collect())
        assert sorted(map(tuple, Q.q_url_handle(spark, sf).collect())) == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
