"""Token alignment against whole texts encoded by the libraries and spans compared pair by pair."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import alignment

ODD = ["a▁b c", "x\x00y z", " lead", "trail ", "two  blanks", "a \n b", "\ttab tab\t", "naïve café — dash", "日本語 テキスト", "emoji 👩‍👩‍👧 ok", " nbsp  em", "x\x1cy \x1f z", "'s don't I'll", "<s> </s> <unk> <|endoftext|> <0x41>", "a" * 3000, "é ́x", "﻿bom", "1 234,567.89"]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*alignment.tokenizer_paths())


def brute(docs, pair):
    rows, pairs = [], []
    for doc, text in docs:
        a, b = ([], []) if not text else (list(pair.a.encode(" " + text, add_special_tokens=False).ids), list(pair.b.encode(text)))
        spell = [b"".join(pair.bytes[k][t] for t in ids) for k, ids in enumerate((a, b))]
        want = (" " + text).encode() if text else b""
        if not text or spell[0] != want or spell[1] != want:
            a, b = [], []
        spans = []
        for k, ids in enumerate((a, b)):
            at, out = 0, []
            for t in ids:
                out.append((at, at + len(pair.bytes[k][t])))
                at = out[-1][1]
            spans.append(out)
        ends = [{e for _, e in s} for s in spans]
        cuts = sorted(ends[0] & ends[1])
        groups, links, start = [], [], 0
        for c in cuts:
            ga, gb = ([i for i, (s, e) in enumerate(spans[k]) if start <= s and e <= c] for k in (0, 1))
            groups.append(",".join(str(a[i]) for i in ga) + "|" + ",".join(str(b[i]) for i in gb))
            links += [(a[i], b[j]) for i in ga for j in gb if spans[0][i][0] < spans[1][j][1] and spans[1][j][0] < spans[0][i][1]]
            start = c
        rows.append((doc, len(a), len(b), len(groups), ";".join(groups)))
        pairs.append(links)
    count = Counter(p for links in pairs for p in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return sorted((d, na, nb, ng, len(ls), sum(count[p] == top[p[0]] for p in ls), sum(count[p] for p in ls), hashlib.sha256(g.encode()).hexdigest() if na else "") for (d, na, nb, ng, g), ls in zip(rows, pairs))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("entries", [1, 40, 10**6])
def test_equals_brute_force(spark, docs, pair, monkeypatch, entries):
    monkeypatch.setattr(alignment, "BLOCK_ENTRIES", entries)
    rows = [(r[0] if r[0] is not None else -1, r[1]) for r in docs.select("doc_id", "text").collect() if len(r[1] or "") < 10_000]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, " ".join(ODD[6:9]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("own")).repartition(3)
    assert rows_of(alignment.align(df, text_out=False).documents()) == brute(rows, pair)


def test_rank_library_equals_the_vocabularys_own(pair, docs):
    assert pair.by_rank
    texts = [r[0] or "" for r in docs.select("text").collect()] + ODD
    assert [pair.by_rank.encode_ordinary(" " + t) for t in texts] == [e.ids for e in pair.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_nulls_empty_tables_and_real_output(spark, none, pair):
    assert alignment.align(none).documents().count() == 0
    df = spark.createDataFrame([(None, "hello world"), (None, None), (3, "hello world")], "doc_id long, text string")
    found = alignment.align(df)
    got = {r["groups"] for r in found.documents().filter("n_a > 0").collect()}
    assert len(got) == 1 and got.pop().count(";") == 1
    pairs = {(r["a"], r["b"]): r["n_docs"] for r in found.pairs().collect()}
    assert set(pairs.values()) == {2}


def test_transducer_keeps_the_dangling_side():
    t = alignment.Transducer(([b"ab", b"c", b"abc", b"x"], [b"a", b"bc", b"abc"]))
    w = t.width
    assert t.run([0, 1], [0, 1]) == ([2], [2], [0, 1, w + 1])
    assert (0, b"ab") in t.states and (0, b"b") in t.states and (1, b"c") in t.states
    assert t.moves[t.numbers[(0, b"b")]] == {1: t.numbers[(1, b"c")]}
    assert t.run([2, 2], [2, 2]) == ([1, 2], [1, 2], [2 * w + 2] * 2)
    assert t.run([3], [0]) is None and t.run([2], [0]) is None and t.run([0], [2]) is None and t.run([], [0]) is None
    assert t.run([], []) == ([], [], [])


def test_a_full_table_sheds_half_and_keeps_its_answers(spark, docs, pair):
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(60))) for i in range(60)]
    words = alignment.Words(*alignment.tokenizer_paths(), 40)
    words.learn([f"word{i}" for i in range(50)] + ["end "])
    before = {w: (words.groups[i], words.links_of(np.array([i]))[0].tolist()) for w, i in words.known.items()}
    words.met = np.arange(51)
    assert words.full()
    words.shed()
    assert len(words.known) == 26 and "end " in words.known
    assert all(before[w] == (words.groups[i], words.links_of(np.array([i]))[0].tolist()) for w, i in words.known.items())
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(alignment.align(df, text_out=False, keep=40).documents()) == brute(rows, pair)
