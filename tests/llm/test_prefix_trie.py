"""The prefix trie against a dictionary of tuples."""

import hashlib
import random
import zlib

import duckdb
import pandas as pd
import pytest

from shelfmark.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = own.get(base, [])[:h] + ts[h:] if rebuild else ts
    nodes = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for k in nodes:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k, members in nodes.items():
        words = len(k[-1][1].encode().split()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(members) - 1) * words
    out = []
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(k))))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids.get(k, 0), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def some_rows(seed, convs=80, length=6):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.1:
            continue  # bases that are absent
        for i in range(rng.randrange(1, length)):
            rows.append((c - 20, i if rng.random() > 0.1 else None, rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", "a", "ab c d", None, "", " x\ny "])))
    rows += [(None, 1, "user", "lost"), rows[0], rows[0]]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed,prime", [(1, T.PRIME), (2, 101), (3, 5)])
def test_rebuilt_equals_brute_force_and_sql(spark, tmp_path, seed, prime):
    rows = some_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert got(T.trie(df, T.REBUILT, prime)) == want
    if prime == T.PRIME:
        frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
        con = duckdb.connect()
        con.register("frame", frame)
        con.execute("CREATE VIEW conversations AS SELECT * FROM frame")
        assert sorted((tuple(r) for r in con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({T.ORACLE})").fetchall()), key=str) == want


def test_plain_conversations_and_one_that_holds_most_rows(spark):
    rng = random.Random(4)
    rows = [(7, i, "user", f"turn {i}") for i in range(300)] + [(8, i, "user", f"turn {i}") for i in range(150)]
    rows += [(c, i, "user", f"turn {i}" if i < 2 else str(rng.random())) for c in range(100, 130) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(T.trie(df)) == brute(rows, rebuild=False)


def test_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.trie(empty, T.REBUILT).count() == 0
    assert T.trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).count() == 0
    rows = [(3, 0, "user", "a"), (9, 0, "user", "a " * 50_000), (1 << 40, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' AS depth", "1 AS f", "2 AS n_convs")
    assert got(T.trie(df, T.REBUILT)) == brute(rows)


def test_scan_and_power_equal_python(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    for prime in (T.PRIME, 101):
        field = T.field_of(0, prime)
        t = rng.integers(0, prime, 200)
        sizes = [1, 60, 3, 100, 36]
        place = np.concatenate([np.arange(n) for n in sizes])
        want, f = [], 0
        for x, p in zip(t.tolist(), place.tolist()):
            f = ((f if p else 0) * field.base + x) % prime
            want.append(f)
        assert field.scan(t, place).tolist() == want
        n = rng.integers(0, 10**9, 50)
        assert field.power(n).tolist() == [pow(field.base, int(x), prime) for x in n]
        assert field.sub(t[:5], t[5:10]).tolist() == [(a - b) % prime for a, b in zip(t[:5].tolist(), t[5:10].tolist())]
