"""Order MinHash against a plain version, its order sense, and the edited texts against slicing."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import order_minhash as omh


def _h(data, seed):
    return xxhash.xxh64_intdigest(data, seed)


def chained_words(words, seed=42):
    for w in words:
        seed = _h(w.encode(), seed)
    return seed


def chained(values, seed=42):
    for v in values:
        seed = _h((v & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return seed


def signed(x, bits):
    return x - (1 << bits) if x >> bits - 1 else x


def plain(text, k=omh.K, picks=omh.PICKS, bits=omh.BITS):
    words = re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")
    grams = [words[i : i + k] for i in range(len(words) - k + 1)] if len(words) >= k else [words] if words else []
    shift = omh.PLACE_BITS
    kmers = [signed(chained_words(g) >> shift, 64 - shift) for g in grams]
    seen, numbered = {}, []
    for place, x in enumerate(kmers):
        n = seen.get(x, 0)
        seen[x] = n + 1
        numbered.append((signed(chained([x, n]) >> shift, 64 - shift) if n else x, place))
    numbered.sort()
    out = []
    for b in range(1 << bits):
        if not numbered:
            out.append(0)
            continue
        start = next((i for i, (x, _) in enumerate(numbered) if (x >> 64 - shift - bits) + (1 << bits - 1) >= b), 0)
        places = sorted(numbered[(start + p) % len(numbered)][1] for p in range(min(picks, len(numbered))))
        out.append(signed(chained([kmers[p] for p in places]) >> 32, 32))
    return out


def signatures(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(2)
    return [r["sig"] for r in omh.signature(df, "text", "sig", **how).orderBy("i").collect()]


@pytest.mark.parametrize("how", [{}, {"k": 1, "picks": 3, "bits": 3}, {"k": 5, "picks": 1, "bits": 4}])
def test_equals_the_plain_version(spark, how):
    rng = random.Random(5)
    texts = [None, "", " \n ", "one", "two words", "a a a a a a a", "x" * 100, "the cat sat the cat sat the cat sat on"]
    texts += [" ".join(rng.choice(["a", "b", "cc", "ddd", "é"]) for _ in range(n)) for n in (3, 4, 10, 50, 400)]
    texts += [" ".join(f"w{rng.randrange(5000)}" for _ in range(3000)), "same line\n" * 500]
    assert signatures(spark, texts, **how) == [plain(t, **how) for t in texts]


def test_likeness_follows_edits_and_order(spark):
    rng = random.Random(7)
    words = [f"w{rng.randrange(9000)}" for _ in range(2000)]
    few = [w if i % 50 else "edit" for i, w in enumerate(words)]
    half = words[:1000] + [f"v{rng.randrange(9000)}" for _ in range(1000)]
    blocks = [words[i : i + 20] for i in range(0, 2000, 20)]
    rng.shuffle(blocks)
    moved = [w for b in blocks for w in b]
    own, *others = (" ".join(x) for x in (words, few, half, moved, half[1000:]))
    rows = [(i, own, t) for i, t in enumerate([own, *others])]
    df = spark.createDataFrame(rows, "i int, a string, b string")

    def near(picks):
        both = omh.signature(omh.signature(df, "a", "x", picks=picks), "b", "y", picks=picks)
        return [r["n"] for r in both.orderBy("i").select(omh.likeness(F.col("x"), F.col("y"), picks).alias("n")).collect()]

    same, edited, halved, shuffled, unlike = near(2)
    assert same == 1 and unlike == 0 and 0.85 < edited < 1 and 0.35 < halved < 0.65
    as_set = near(1)[3]
    assert shuffled < as_set - 0.15  # moved blocks keep their k-mers and lose their order


def expected(rows):
    """Texts edited by slicing, of rows whose ids are distinct."""
    rows = sorted(rows)
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out[doc] = (len(text), text[: len(text) - half] + after[:half], after)
    return out


def test_edited_texts(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i * 7 - 300, rng.choice([None, "", "ab", "é" * 9, "naïve 日本語 text 👧 end", " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(90)))])) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in omh.op12_fingerprint(spark, str(tmp_path)).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    hexed = lambda t: "".join(f"{x & 0xFFFFFFFF:08x}" for x in plain(t))
    texts = dict(rows)
    for doc, (n, edited, after) in want.items():
        r = got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (hexed(texts[doc]), hexed(edited))
        assert 0 <= r["near_edited"] <= 1 and (r["near_next"] == 1) == (hexed(texts[doc]) == hexed(after))


def test_cases(spark, docs, none, tmp_path):
    assert omh.edited_fingerprints(none).count() == 0
    found = omh.edited_fingerprints(docs)
    assert found.count() == docs.count()
    assert sorted(found.columns) == sorted(["doc_id", "n_chars", "edited", "sig", "next_sig", "edited_sig"])
    again = omh.edited_fingerprints(docs.repartition(2))
    rows = lambda df: sorted((str(r["doc_id"]), r["edited"], tuple(r["sig"])) for r in df.collect())
    assert rows(found) == rows(again)
    # null ids come last, so the last of them is followed by the first id of all
    one = omh.edited_fingerprints(spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")).collect()
    assert [(r["edited"], r["sig"] == r["next_sig"]) for r in one] == [("a b a b"[:4] + "a b", True)]


def test_plan_has_no_python(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    plan = omh.op12_fingerprint(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "MapInPandas" not in plan
