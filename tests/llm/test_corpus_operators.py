"""Operators over the whole corpus, against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import chat, decontam, mixing, positions, simhash, token_files, url_filter
from tests.llm import brute

SF = "/root/testdata/sf0.001"
tuples = lambda df, *c: sorted((tuple(r) for r in (df.select(*c) if c else df).collect()), key=repr)


def test_decontam_equals_brute_force(spark, docs, none):
    bench = spark.createDataFrame([(1, "brown fox jumps over a lazy dog and then it goes"), (2, "One, TWO"), (3, None), (4, ""), (2, "one two"), (12, "word1 word2"), (None, "a")], "item_id long, text string")
    key = docs.select("doc_id", "text")
    want = sorted(brute.decontam([tuple(r) for r in key.collect()], [tuple(r) for r in bench.filter("item_id is not null").collect()]), key=repr)
    found = decontam.hits(docs, bench)
    cols = ("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("h"), (F.col("n_hit") > 0).alias("c"))
    assert tuples(found, *cols) == want
    assert tuples(decontam.hits(docs, bench, block_words=3), *cols) == want
    assert decontam.hits(none, bench).count() == 0 and decontam.hits(docs, bench.limit(0)).filter("n_hit > 0").isEmpty()
    clean = decontam.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[5] for w in want)


def test_decontam_blocks_keep_repeated_rows_apart(spark):
    text = "a b c d e f g h i j k l"
    docs = spark.createDataFrame([(1, text)] * 6, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([("x", "a b c d e f g h i j"), ("y", "c d e f g h i j k l"), ("z", "q r")], "item_id string, text string")
    got = decontam.hits(docs, bench, block_words=10).collect()
    assert [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got] == [(1, 12, 12, ["x", "y"])] * 6


def test_one_stored_index_answers_all_blocks(spark, docs, monkeypatch):
    built = []
    real = decontam.build_index
    monkeypatch.setattr(decontam, "build_index", lambda d: built.append(1) or real(d))
    bench = spark.createDataFrame([("x", "the quick brown fox"), ("y", "word1 word2 word3"), ("z", "moron. LOSER")], "item_id string, text string")
    got = decontam.hits(docs, bench, block_words=3)
    want = brute.decontam([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()])
    assert len(built) == 1 and len(list(decontam.blocks_of(bench, 3))) == 3
    assert tuples(got, "doc_id", "n_words", "n_hit") == sorted((w[:3] for w in want), key=repr)


@pytest.mark.parametrize("shard_words", [1, 50, 29_990])
def test_the_index_holds_all_terms_in_any_shards(docs, shard_words):
    index = decontam.build_index(docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text"), shard_words)
    got = {}
    for row in index.collect():
        terms, bounds = decontam._terms(row["terms"], row["term_sizes"]), np.frombuffer(row["bounds"], "<i8")
        assert terms == sorted(set(terms))
        words, at = {}, 0
        for t, n, size in zip(terms, np.frombuffer(row["counts"], "<i4"), np.frombuffer(row["sizes"], "<i4")):
            places = decontam.decoded(np.frombuffer(row["postings"], np.uint8)[at : at + size])
            assert len(places) == n
            words |= dict.fromkeys(places.tolist(), t)
            at += size
        for number, key, a, b in zip(row["rows"], row["doc_ids"], bounds, bounds[1:]):
            got[number] = (key, [words[i].decode() for i in range(a, b)])
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = {c: c + 32 for c in range(65, 91)}
    want = [(None if r["doc_id"] is None else f"d{r['doc_id']}", rx.findall((r["text"] or "").translate(low))) for r in docs.collect()]
    assert sorted(got.values(), key=repr) == sorted(want, key=repr)


def test_coding_round_trip():
    rng = np.random.default_rng(9)
    for top in (2, 1 << 7, 1 << 14, 1 << 21, 1 << 30):
        gaps = rng.integers(0, top, 500)
        blob, size = decontam.coded(gaps)
        assert decontam.decoded(blob).tolist() == np.cumsum(gaps).tolist() and size.sum() == len(blob)


def test_near_match_is_reported_and_does_not_contaminate(spark):
    bench = spark.createDataFrame([(1, "zeta eta theta iota kappa lambda mu nu xi omicron")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "lambda kappa mu eta x zeta iota theta xi omicron nu"), (2, "zeta only")], "doc_id long, text string")
    assert tuples(decontam.hits(docs, bench), "doc_id", "n_hit", "near") == [(1, 0, ["1"]), (2, 0, [])]


def test_near_passes_over_terms_without_postings_and_takes_short_items(spark, tmp_path):
    bench = spark.createDataFrame([(1, "zeta eta theta iota kappa lambda absent"), (2, "omicron pi rho"), (3, "solo solo"), (4, "tau gone")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "iota theta x eta zeta lambda y kappa"), (2, "rho and pi and omicron"), (3, "solo tau"), (4, "omicron pi rho")], "doc_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = [(1, 1, "1"), (2, 1, "2"), (3, 0, ""), (4, 0, "")]
    assert tuples(decontam.op6_near(spark, str(tmp_path)), "doc_id", "n_near", "near") == want
    assert tuples(decontam.hits(docs, bench, block_words=3), "doc_id", F.array_join("near", ",").alias("n")) == [(d, n) for d, _, n in want]


def test_simhash_equals_brute_force(docs, none, spark):
    keyed = docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text")
    rows = [tuple(r) for r in keyed.collect()]
    prints = [(d, brute.simhash(t)) for d, t in rows]
    assert {d: simhash.fingerprint(t.encode() if t is not None else None) & (1 << 64) - 1 for d, t in rows} == dict(prints)
    got = simhash.grouped(simhash.fingerprints(keyed, ["doc_id"]))
    assert dict(tuples(got, "doc_id", "component_id")) == brute.components(sorted(prints))
    assert simhash.grouped(simhash.fingerprints(none, ["doc_id"])).count() == 0
    kept = simhash.dedup(docs)
    texts = [r["text"] for r in kept.collect()]
    assert kept.columns == docs.columns and Counter(texts)[docs.filter("doc_id = 5").first()["text"]] == 1
    assert sum(t is None or not t.split() for t in texts) == 1
    assert simhash.dedup(none).count() == 0


def test_dedup_keeps_one_of_a_component_whatever_its_ids(spark):
    rng = random.Random(5)
    words = [[f"w{rng.randrange(5000)}" for _ in range(300)] for _ in range(2)]
    bits = lambda a, b: (brute.simhash(a) ^ brute.simhash(b)).bit_count()
    texts = []
    for w in words:
        whole = " ".join(w)
        near = next(t for i in range(300) if 1 <= bits(whole, t := " ".join(w[:i] + w[i + 1 :])) <= 3)
        texts.append((whole, near))
    (a, a2), (b, b2) = texts
    assert bits(a, b) > 3
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.dedup(frame([(None, a), (None, a2), (1, b), (2, b2)]))
    assert kept.count() == 2 and kept.filter("doc_id = 1").count() == 1
    assert {r["text"] in (a, a2) for r in simhash.dedup(frame([(7, a), (8, a2), (7, b)])).collect()} == {True, False}


@pytest.mark.parametrize("seed,spread", [(0, 64), (1, 14), (2, 64)])
def test_links_lose_no_component(spark, seed, spread):
    rng = random.Random(seed)
    bits = rng.sample(range(64), spread)
    fps = set()
    for _ in range(60):
        f = sum(rng.getrandbits(1) << b for b in bits)
        for _ in range(rng.randint(1, 6)):
            fps.add(f)
            f ^= sum(1 << b for b in rng.sample(bits, rng.randint(1, 4)))
    fps = sorted(fps)
    want = brute.components([(i, f) for i, f in enumerate(fps)])
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.grouped(spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long"))
    assert dict(tuples(got, "doc_id", "component_id")) == want


@pytest.mark.parametrize("seed,hot", [(3, 30), (4, 5), (5, 1)])
def test_hot_values_are_split_without_loss(spark, seed, hot):
    """Few bits ever change, so that all parts but one have the same value in every fingerprint."""
    rng = random.Random(seed)
    bits = rng.sample(range(64), 12)
    fps = sorted({sum(rng.getrandbits(1) << b for b in bits) | 1 << 63 for _ in range(250)})
    signed = [f - (1 << 64) for f in fps]
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = simhash.grouped(spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long"), hot=hot)
    assert dict(tuples(got, "doc_id", "component_id")) == brute.components(list(enumerate(fps)))
    edges = {tuple(r) for r in simhash.links(classes, hot=hot).collect()}
    assert edges and all((a ^ b).bit_count() <= 3 for a, b in edges)


def test_dedup_of_repeated_rows_and_odd_columns(spark):
    rows = [(1, "a b c d", "x", "s"), (1, "a b c d", "y", "s"), (1, "a b c d", "y", "s"), (2, "quite another text of words", "x", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, `odd.name` string").withColumn("m", F.create_map("lang", "lang")).withColumn("_metadata", F.lit("own"))
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert {r["_metadata"] for r in kept.collect()} == {"own"}
    assert len({tuple(r["lang"] for r in simhash.dedup(docs.repartition(n)).orderBy("doc_id").collect()) for n in (1, 2, 3)}) == 1


def test_rows_are_found_by_place(spark, tmp_path):
    rng = random.Random(14)
    made = [(i % 7, f"text {i % 5}", None if i % 3 else "x") for i in range(300)]
    spark.createDataFrame(made, "doc_id long, text string, `a.b` string").repartition(5).write.parquet(f"{tmp_path}/docs")
    frames = [spark.read.parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/docs").groupBy("doc_id", "text", "`a.b`").agg(F.count("*").alias("k")), spark.createDataFrame([], "doc_id long, text string")]
    for docs in frames:
        at = positions.placed(docs)
        places = at.select(positions.FILE, positions.ROW).collect()
        assert len(set(places)) == len(places) == docs.count()
        for others in (0, 1, 2):
            n = {tuple(p): rng.randint(0, 4) for p in places if rng.random() < 0.6}
            counts = spark.createDataFrame([(*p, k) for p, k in n.items()], f"{positions.FILE} long, {positions.ROW} long, n int")
            want = Counter()
            for r in at.collect():
                want[tuple(r)[:-2]] += n.get(tuple(r)[-2:], others)
            got = positions.repeated(at, counts, others)
            assert got.columns == docs.columns and Counter(map(tuple, got.collect())) == +want


def test_runs_over_many_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    fps = list(range(0, 1 << 16, 97)) + [(1 << 40) + i for i in range(40)]
    want = brute.components(list(enumerate(fps)))
    try:
        spark.conf.set(key, "7")
        got = simhash.grouped(spark.createDataFrame(list(enumerate(fps)), "doc_id long, fp long"))
        assert dict(tuples(got, "doc_id", "component_id")) == want
    finally:
        spark.conf.set(key, old)


def test_forest_and_fit():
    rng = np.random.default_rng(4)
    fps = np.unique(rng.integers(0, 1 << 14, 4000).astype(np.uint64) * np.uint64(0x0004000100010001))
    old = simhash.LARGE_RUN
    want = simhash.forest(fps)
    try:
        simhash.LARGE_RUN = 500
        got = simhash.forest(fps)
    finally:
        simhash.LARGE_RUN = old
    ids = {int(f): i for i, f in enumerate(fps)}

    def groups(edges):
        root = list(range(len(fps)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = find(ids[a]), find(ids[b])
            root[max(x, y)] = min(x, y)
        return [find(i) for i in range(len(fps))]

    assert groups(want) == groups(got) and len(want) < len(fps)
    for n in (10, 10**6, 10**10):
        p = simhash.fit_partition(rng.integers(0, 1 << 63, 500).astype(np.uint64), n)
        assert sum(p.masks) == (1 << 64) - 1 and sum(p.thresholds) == simhash.RADIUS - len(p.masks) + 1


def test_token_files_equal_the_library(docs, none, tmp_path):
    one = docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text")
    want = brute.tokens([tuple(r) for r in one.collect()], token_files.tokenizer_path())
    assert tuples(token_files.encode(one).drop("shard")) == sorted(want, key=repr)
    every = token_files.encode(docs, folder=f"file://{tmp_path}/ids").collect()
    assert len(every) == docs.count() and [r["doc_id"] for r in sorted(every, key=lambda r: r["start"])][-2:] == [None, None]
    assert sum(r["n_tokens"] for r in every) == max(r["start"] + r["n_tokens"] for r in every)
    assert token_files.encode(none).count() == 0


def test_encoder_equals_the_library_on_odd_text():
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(token_files.tokenizer_path())
    e = token_files.Encoder(token_files.tokenizer_path(), keep=60)  # so few that words are shed all the time
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "\u00a0", "a", "é", "'s", "'", "7", ".", "!!", "word", "don't", "<|endoftext|>", "中", " \n", "\x1c", "\u3000", "\x85", "\u200b"]
    for _ in range(200):
        texts = [None, "", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(0, 40)))]
        ids, sizes = e.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes)
        for t, a, b in zip(texts, ends - sizes, ends):
            assert ids[a:b].tolist() == [*tk.encode(t or "", add_special_tokens=False).ids, 0], repr(t)
    assert [len(x) for x in e.encode(pa.array([], pa.string()))] == [0, 0]


@pytest.mark.parametrize("shard_ids", [1, 7, 50, 10**6])
def test_lookup_over_all_shards(spark, docs, none, tmp_path, shard_ids):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(token_files.tokenizer_path())
    rows = docs.filter("doc_id is null or doc_id <> 8").select("doc_id", "text")  # 8: one very long text
    rows = rows.unionByName(rows.limit(0)).unionByName(spark.createDataFrame([(5, f"five {i}") for i in range(9)] + [(-3, "minus")], "doc_id long, text string"))
    made = token_files.write(rows, f"file://{tmp_path}/ids", token_files.tokenizer_path(), shard_ids)
    want = Counter((r["doc_id"], tuple([*tk.encode(r["text"] or "", add_special_tokens=False).ids, 0])) for r in rows.collect())
    asked = spark.createDataFrame([(k,) for k in [*range(-5, 30), None, None, 5, 5, 10**12, -(10**12)]], "doc_id long")
    got = made.lookup(asked).collect()
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u2").tolist())) for r in got) == want
    starts = sorted((r["start"], len(r["ids"]) // 2) for r in got)
    assert [a for a, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
    assert made.lookup(asked.filter("doc_id > 100")).isEmpty() and made.lookup(asked.limit(0)).isEmpty()
    assert made.files.count() >= (len(got) if shard_ids == 1 else 1)
    nothing = token_files.write(none, f"file://{tmp_path}/none", token_files.tokenizer_path())
    assert nothing.files.isEmpty() and nothing.lookup(asked).isEmpty()


def test_perfect_hash_and_unknown_keys(tmp_path):
    import pyarrow.fs as pf

    fs = pf.LocalFileSystem()
    ids = sorted(random.Random(6).sample(range(-10**9, 10**9), 3000)) + [None]
    ids[10] = ids[11]
    token_files.write_shard(fs, f"{tmp_path}/s", 2, ids, [1] * len(ids), [np.arange(len(ids), dtype="<u2").tobytes()])
    shard = token_files.Shard(fs, f"{tmp_path}/s")
    assert all(r in shard.rows_of(k) and shard.tokens(r).tolist() == [r] for r, k in enumerate(ids))
    assert len(shard.rows_of(ids[10])) == 2
    assert sum(len(shard.rows_of(k)) for k in range(2 * 10**9, 2 * 10**9 + 3000)) == 0


def test_mixing(spark, docs, none):
    rows = docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    got = mixing.allot(rows).collect()
    assert len(got) == docs.count() and all(0 <= r["copies"] <= 3 for r in got)
    total = sum(r["size"] for r in got)
    targets = {r["source"]: (r["target"], r["source_size"]) for r in got}
    assert abs(sum(t for t, _ in targets.values()) - total) < 1e-6 * total and all(t <= 3 * s + 1e-6 for t, s in targets.values())
    assert mixing.allot(rows.limit(0)).count() == 0 and mixing.mix(none).count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    many = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"), (F.col("id") % 50 + 1).alias("size"))
    per = mixing.allot(many).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n")).collect()
    assert all(abs(r["n"] - r["t"]) <= 60 for r in per)


def test_mixing_repeated_ids_agree_between_runs(spark):
    rows = [(7, f"{w} {v}", None, "a" if i % 3 else "b", 0) for i, (w, v) in enumerate(itertools.product("abcdefgh", repeat=2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    once = tuples(mixing.mix(docs.repartition(5, "text")))
    assert once == tuples(mixing.mix(docs.repartition(2, "n_chars").orderBy(F.desc("text")))) and len(set(once)) > 20


def test_targets_refill_by_weight(spark):
    sizes = {"a": 1, "b": 500, "c": 10, "d": 489, None: 0}
    df = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = {r["source"]: r["target"] for r in df.collect()}
    weight = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    target, fixed = {}, {}
    while True:
        rest, w = 1000 - sum(fixed.values()), sum(v for k, v in weight.items() if k not in fixed)
        target = fixed | {k: rest * v / w for k, v in weight.items() if k not in fixed}
        over = {k: 3.0 * sizes[k] for k, t in target.items() if k not in fixed and t > 3 * sizes[k]}
        if not over:
            break
        fixed |= over
    assert got == pytest.approx(target)


def legal(seq):
    q = list(seq)[1:] if seq and seq[0] == 0 else list(seq)
    return len(q) % 2 == 0 and len(q) > 0 and all(r == 1 + i % 2 for i, r in enumerate(q))


def cheapest(codes):
    best = 10**9
    for roles in itertools.product(range(3), repeat=len(codes)):
        base = sum(0 if r == k else chat.UNKNOWN if k < 0 else chat.RELABEL for r, k in zip(roles, codes))
        for merged in itertools.product([0, 1], repeat=len(codes)):
            if any(m and (i == 0 or roles[i] != roles[i - 1]) for i, m in enumerate(merged)):
                continue
            kept = [r for r, m in zip(roles, merged) if not m]
            for k in range(5):
                cost = base + chat.MERGE * sum(merged) + chat.INSERT * k
                if cost >= best:
                    break
                n = len(kept) + k
                fits = any(legal([next(a) if i in pos else next(b) for i in range(n)]) for pos in itertools.combinations(range(n), k) for ins in itertools.product(range(3), repeat=k) for a, b in [(iter(ins), iter(kept))])
                if fits:
                    best = cost
                    break
    return best


def test_repair_costs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(40):
        codes = [rng.randint(-1, 2) for _ in range(rng.randint(1, 4))]
        cut = rng.randint(0, len(codes))
        _, total = chat.chunk_states([chat.chunk_matrix(p) for p in (codes[:cut], codes[cut:]) if p])
        assert total == cheapest(codes)


def test_chat_cases(spark, monkeypatch):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", "again"), (1, 2, "assistant", None), (2, 0, "assistant", "x"), (2, None, "tool", ""), (None, 0, " System ", "s"), (3, 0, None, "q"), (3, 0, None, "q")]
    rows += [(9, i, ["user", "assistant"][i % 2], f"t{i}") for i in range(2001)]
    turns = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, cost string")
    got = chat.repair(turns).collect()
    assert len(got) == len(rows)
    by = {}
    for r in sorted(got, key=lambda r: (repr(r["conv_id"]), r["turn"] is None, r["turn"] or 0)):
        by.setdefault(r["conv_id"], []).append(r)
    text = lambda c: "".join(r["rendered"] for r in by[c])
    assert text(1) == "<|im_start|>user\nhi\nagain<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert text(None) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [r["action"] for r in by[9]] == ["keep"] * 2000 + ["insert"] and by[9][0]["cost"] == chat.INSERT
    for r in by.values():
        roles = [x for p in "".join(t["rendered"] for t in r).split("<|im_start|>")[1:] for x in [chat.ROLES.index(p.split("\n")[0])]]
        assert legal(roles)
    assert chat.repair(turns.limit(0)).count() == 0


def test_url_rules(spark):
    urls = [
        ("https://A.Example.com/en/7x?q", "a.example.com", "/en/7x", "example.com/en/7", "allow"), ("http://b.com/en/1", "b.com", "/en/1", "com/en/", "block"), ("x://example.net/de/8", "example.net", "/de/8", "example.net/de/8", "block"),
        ("x://n.net/de/", "n.net", "/de/", "net/de/", "allow"), ("x://o.org/es/#f", "o.org", "/es/", "org/es/", "block"), ("x://notcom/en/", "notcom", "/en/", None, "allow"), ("x://com/en/", "com", "/en/", "com/en/", "block"),
        (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("x://h", "h", "", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"), ("x://h\n.com/en/", "h\n.com", "/en/", "com/en/", "block"),
    ]
    pages = spark.createDataFrame([(i, u[0], "own") for i, u in enumerate(urls)], "page_id long, url string, host string")
    out = url_filter.judge(pages.drop("host"), pages.select("url", F.lit(True).alias("bad")).limit(0))
    assert [tuple(r) for r in out.orderBy("page_id").select("url", "host", "path", "rule", "verdict").collect()] == urls


def test_mined_rules_match_by_both_paths(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.3
        host = "spam.example" if bad and rng.random() < 0.9 else f"h{i % 5}.example"
        rows.append((f"https://{host}/{'ad' if bad else 'x'}/{i}?{'utm' if i % 2 else 'p'}=1", bad))
    lab = spark.createDataFrame(rows, "url string, bad boolean")
    index = url_filter.posted(url_filter.mine(lab, 0.02, 0.8), lab).cache()
    pages = spark.createDataFrame([("https://w.spam.example/ad/9?utm=2",), ("https://h1.example/x/1?p=3",), (None,)], "url string")
    a, b = (dict(tuples(url_filter.learned(pages, index, inline), "url", "learned")) for inline in (2000, 1))
    assert a == b and a["https://w.spam.example/ad/9?utm=2"] == "block" and a["https://h1.example/x/1?p=3"] == "allow" and a[None] is None
    mined = {(tuple(r["antecedent"]), r["verdict"]): r["confidence"] for r in url_filter.mine(lab, 0.02, 0.8).collect()}
    sets = [(set(r[0]), bad) for r, bad in zip(lab.select(url_filter.tokens_of(F.col("url"))).collect(), [x[1] for x in rows])]
    for (ante, verdict), conf in mined.items():
        hit = [bad for s, bad in sets if s >= set(ante)]
        assert conf == pytest.approx(sum(bad == (verdict == "block") for bad in hit) / len(hit))


@pytest.mark.parametrize("seed,support,confidence", [(1, 0.05, 0.6), (2, 0.1, 0.3), (3, 0.02, 0.7)])
def test_mined_rules_are_all_rules(spark, seed, support, confidence):
    """Every token combination is counted; what passes the thresholds and no shorter rule makes idle is mined, and no more."""
    rng = random.Random(seed)
    rows = [(f"http://{rng.choice('ab')}.{rng.choice('xy')}.z/{rng.choice(['p', 'q'])}/{i}" + rng.choice(["", "?k=1", "#f"]), rng.random() < (0.8 if i % 3 else 0.2)) for i in range(150)]
    rows += [(None, True), ("http://a.x.z/p/1", None), rows[0], rows[0]]
    lab = spark.createDataFrame(rows, "url string, bad boolean")
    got = {(tuple(r["antecedent"]), r["verdict"]): (round(r["confidence"], 9), round(r["support"], 9)) for r in url_filter.mine(lab, support, confidence, least=3).collect()}
    sets = [(frozenset(r["t"]), r["bad"]) for r in lab.filter("bad is not null").select(url_filter.tokens_of(F.col("url")).alias("t"), "bad").collect() if r["t"]]
    n, count, hits = len(sets), {}, {}
    for tokens, bad in sets:
        for k in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), k):
                count[part] = count.get(part, 0) + 1
                key = (part, "block" if bad else "allow")
                hits[key] = hits.get(key, 0) + 1
    least = max(support, 3 / n)
    found = {k: h / count[k[0]] for k, h in hits.items() if h >= least * n and h / count[k[0]] >= confidence}
    idle = {(part, v) for part, v in found for t in part if len(part) > 1 and found.get((tuple(x for x in part if x != t), v), -1) >= found[(part, v)]}
    assert got == {k: (round(c, 9), round(hits[k] / n, 9)) for k, c in found.items() if k not in idle} and got


def test_rendered_repairs_equal_brute_force(spark):
    """What is rendered keeps all texts in order, is legal, and costs what the cheapest repair costs."""
    rng = random.Random(17)
    names = ["system", "user", "assistant", "tool"]
    convs = {c: [rng.choice(names) for _ in range(rng.randint(1, 4))] for c in range(60)}
    rows = [(c, i, r, f"<{c}.{i}>") for c, roles in convs.items() for i, r in enumerate(roles)]
    by = {}
    for r in chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect():
        by.setdefault(r["conv_id"], []).append(r)
    for c, roles in convs.items():
        turns = sorted(by[c], key=lambda r: r["turn"])
        text = "".join(t["rendered"] for t in turns)
        blocks = [b.split("\n", 1) for b in text.split("<|im_start|>")[1:]]
        assert all(body.endswith("<|im_end|>\n") for _, body in blocks)
        assert legal([chat.ROLES.index(r) for r, _ in blocks])
        assert "".join(body.removesuffix("<|im_end|>\n").replace("\n", "") for _, body in blocks) == "".join(f"<{c}.{i}>" for i in range(len(roles)))
        # each turn's text stands in a block of the role that it was given
        for t in turns:
            assert next(r for r, body in blocks if f"<{c}.{t['turn']}>" in body) == t["new_role"]
        cost = sum((chat.UNKNOWN if t["role"] == "tool" else chat.RELABEL) * (t["role"] != t["new_role"]) + chat.MERGE * ("merge" in t["action"]) + chat.INSERT * t["n_inserted"] for t in turns)
        assert {t["cost"] for t in turns} == {cost} == {cheapest([chat.role_code(r) for r in roles])}
        assert sum(t["n_inserted"] for t in turns) == sum(body == "<|im_end|>\n" for _, body in blocks)


@pytest.mark.parametrize("shard_words", [40, 10**6])
def test_near_matches_equal_brute_force(spark, monkeypatch, shard_words):
    monkeypatch.setattr(decontam, "SHARD_WORDS", shard_words)
    rng = random.Random(23)
    vocab = [f"v{i}" for i in range(40)]
    weight = [i + 1 for i in range(40)]
    docs = [(d, " ".join(rng.choices(vocab, weight, k=rng.randint(0, 120)))) for d in range(40)]
    bench = [(i, " ".join(rng.choices(vocab + ["absent"], weight + [5], k=rng.randint(1, 14)))) for i in range(30)]
    count = {}
    for _, t in docs:
        for w in t.split():
            count[w] = count.get(w, 0) + 1
    want = {d: set() for d, _ in docs}
    unsure = set()
    for item, text in bench:
        terms = sorted({w for w in text.split()}, key=lambda w: count.get(w, 0))
        asked = min(decontam.NEAR_TERMS, len(terms))
        rare = [w for w in terms if w in count]
        if len(rare) < asked or asked < 2:
            continue
        tie = [count[w] for w in rare]
        if tie[0] == tie[1] or len(rare) > asked and tie[asked - 1] == tie[asked]:
            unsure.add(str(item))
            continue
        for d, t in docs:
            ws = t.split()
            at = {w: [i for i, x in enumerate(ws) if x == w] for w in rare[:asked]}
            if any(all(any(abs(i - j) <= decontam.NEAR_SPAN for j in at[w]) for w in rare[1:asked]) for i in at[rare[0]]):
                want[d].add(str(item))
    exact = {r[0]: r for r in brute.decontam(docs, bench)}
    found = decontam.hits(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(bench, "item_id long, text string"))
    some = 0
    for r in found.collect():
        assert r["n_hit"] == exact[r["doc_id"]][2]
        assert set(r["near"]) - unsure == want[r["doc_id"]] - unsure - set(r["items"]), r["doc_id"]
        some += len(set(r["near"]) - unsure)
    assert some > 20 and len(unsure) < 25
