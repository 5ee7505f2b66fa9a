"""Operators that judge one text at a time."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import licenses, quality, rules, toxicity
from shelfmark.llm.common import crc_mod

SF = "/root/testdata/sf0.01"


def accuracy(spark, df, label):
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = df.filter("held_out").join(lab, "doc_id").select("score", "predicted", label).collect()
    y, s = np.array([r[2] for r in rows]), np.array([r[0] for r in rows])
    wins = (s[y == 1][:, None] > s[y == 0][None, :]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).mean()
    return float(np.mean([r[1] == r[2] for r in rows])), float(wins)


def test_quality_on_held_out_rows(spark):
    df = quality.op2_quality(spark, SF)
    acc, auc = accuracy(spark, df, "quality")
    assert acc > 0.93 and auc > 0.9
    assert df.filter("score < 0 or score > 1 or score is null or held_out is null").isEmpty()


def test_quality_features_are_differences_of_compressed_sizes():
    import zstandard

    rng = random.Random(4)
    words = {1: "river stone cloud window garden".split(), 0: "buy now cheap $$$ click".split()}
    text = lambda y: " ".join(rng.choice(words[y]) + str(rng.randrange(30)) for _ in range(rng.randrange(20, 300))).encode()
    model = quality.fit([(text(i // 2 % 2), i // 2 % 2) for i in range(200)], {0: 30, 1: 70})
    coders = model.coders()

    def size(block, data):
        kind = zstandard.DICT_TYPE_FULLDICT if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        how = {"dict_data": zstandard.ZstdCompressionDict(data, dict_type=kind)} if data else {}
        return len(zstandard.ZstdCompressor(level=3, write_content_size=False, write_dict_id=False, **how).compress(block)) - 2

    for t in [text(0), text(1), b"x", text(1)[:257]]:
        blocks = [t[i : i + quality.BLOCK] for i in range(0, len(t), quality.BLOCK)]
        g, b, p = ([size(x, d) for x in blocks] for d in (model.good, model.bad, b""))
        d, e = [(y - x) / (x + y) for x, y in zip(g, b)], [(z - x) / z for x, z in zip(g, p)]
        n = len(t)
        assert model.features(t, coders) == pytest.approx([(sum(b) - sum(g)) / (sum(b) + sum(g)), (sum(p) - sum(g)) / n, (sum(p) - sum(b)) / n, min(d), max(d), min(e), max(e)])
    scores = model.score([text(1), text(0), b"", None], coders)
    assert scores[0] > 0.9 and scores[1] < 0.1 and scores[2] == scores[3] == 71 / 102


def test_toxicity_on_held_out_rows(spark):
    acc, auc = accuracy(spark, toxicity.op3_toxicity(spark, SF), "toxic")
    assert acc > 0.93 and auc > 0.75


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_cases(spark, docs, none, module, label):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(19)] + [(None, 1, 1), (3, None, None), (5, 0, 1)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0), labels.filter(f"{label} = 1")):
        model = module.train(docs, lab, crc_mod(F.col("doc_id"), 3) != 1)
        rows = module.score(docs, model, ["doc_id"]).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(none, model, ["doc_id"]).count() == 0


def test_grammar_scores_clauses():
    g = toxicity.fit([], {})
    score = lambda t: sum(s for s, _, _ in g.clauses(t.encode())[1])
    assert score("you idiot") > score("an idiot") > score("not an idiot") > 0
    assert score("he said an idiot") < score("an idiot")
    assert score("I will kill you") == score("you I will kill") > 0
    assert score("not here. an idiot") == score("an idiot")
    assert score("idiot moron") > 2 * score("idiot")
    assert g.clauses(b"ok. You idiot! fine")[1][0][1:] == (4, 13)


def test_a_target_counts_on_either_side():
    g = toxicity.fit([], {})
    score = lambda t: sum(s for s, _, _ in g.clauses(t.encode())[1])
    for text in ("I will kill you", "kill them", "hurt these people"):
        assert score(text) > 0
    assert score("kill them") == score("them kill")
    assert score("stupid people") == score("people stupid") > score("stupid thing")
    assert score("kill time") == 0 and score("kill time. you see") == 0 and score("you see. kill time") == 0
    assert 0 < score("I will not kill you") < score("I will kill you") > score("it said kill you") > 0
    assert g.clauses(b"ok. Kill them! fine")[1][0][1:] == (4, 13)


def test_context_counts_on_either_side():
    g = toxicity.fit([], {})
    score = lambda t: sum(s for s, _, _ in g.clauses(t.encode())[1])
    for text in ("we will murder them all", "I'll beat you", "you I will kill"):
        assert score(text) > 0, text
    assert score("an idiot he said") == score("he said an idiot") < score("he is an idiot") == score("an idiot he is")
    assert score("idiot you are") == score("you are idiot") > score("idiot")
    assert score("you are not an idiot") < score("you are an idiot, not a friend") == score("you are an idiot")
    assert score("an idiot. he said") == score("an idiot")


def test_threats_have_other_forms():
    g = toxicity.fit([], {})
    for text in ("they are killing you", "he hurts them", "you were burned", "she destroys you", "smashed them", "you got murdered"):
        assert g.clauses(text.encode())[1], text


def plain_sum(g, text):
    """What isolated words give: the weight of the insult words, wherever they stand."""
    return sum(g.words.get(w, (0, 0.0))[1] for w in text.translate(toxicity.ALNUM_LOWER).split() if g.words.get(w, (0,))[0] == toxicity.INSULT)


def test_contexts_change_held_out_predictions():
    """Texts of equal insult words, told apart by what stands around them: words alone cannot, the machine can."""
    rng = random.Random(21)
    filler = "river stone cloud window garden paper table winter morning letter".split()
    prose = lambda n: " ".join(rng.choice(filler) for _ in range(n))

    def made(y):
        word = rng.choice(["idiot", "moron", "loser"])
        hit = rng.choice([f"you {word}", f"{word} they"]) if y else rng.choice([f"never a {word}", f"{word} she wrote", f"he said {word}", f"not one {word}"])
        return f"{prose(12)}. {prose(3)} {hit} {prose(2)}. {prose(9)}".encode()

    sample = [(made(i % 2), i % 2) for i in range(400)]
    held = [(made(i % 2), i % 2) for i in range(200)]
    g = toxicity.fit(sample, {0: 200, 1: 200})
    p = toxicity.fitting.probability(g.calibrator, np.array([g.features(*g.clauses(t)) for t, _ in held]))
    y = np.array([y for _, y in held])
    assert ((p >= 0.5) == y).mean() > 0.97
    # the same fit on the plain sum: a single value for nearly all, so about half of them are wrong
    flat = lambda rows: np.array([[np.log1p(plain_sum(g, t))] for t, _ in rows])
    model = toxicity.fitting.logistic(flat(sample), np.array([float(v) for _, v in sample]), np.ones(len(sample)))
    assert ((toxicity.fitting.probability(model, flat(held)) >= 0.5) == y).mean() < 0.7


def plainly(run):
    """Score of a clause by the rules as they are written, without a machine."""
    kinds = [s for s, _ in run]
    total = seen = 0
    negated = False
    for symbol, weight in run:
        negated |= symbol == toxicity.NEGATION
        if symbol == toxicity.INSULT or symbol == toxicity.THREAT and toxicity.TARGET in kinds:
            total += weight * (1.5 if toxicity.TARGET in kinds else 1) * (0.5 if negated else 1) * (0.5 if toxicity.REPORT in kinds else 1) * (1.25 if seen else 1)
            seen += 1
    return total


def test_machine_equals_plain_rules():
    rng = random.Random(13)
    g = toxicity.fit([], {})
    words = {toxicity.OTHER: "thing", toxicity.INSULT: "idiot", toxicity.THREAT: "kill", toxicity.TARGET: "you", toxicity.NEGATION: "not", toxicity.REPORT: "said"}
    for _ in range(3000):
        clauses = [[(rng.randrange(6), 3.0) for _ in range(rng.randint(0, 7))] for _ in range(rng.randint(1, 3))]
        for c in clauses:
            assert g.weigh([x for x in c if x[0] != toxicity.OTHER]) == pytest.approx(plainly(c))
        text = ". ".join(" ".join(words[s] for s, _ in c) for c in clauses)
        assert sum(s for s, _, _ in g.clauses(text.encode())[1]) == pytest.approx(sum(map(plainly, clauses))), text


def test_grammar_learns_words_and_stems():
    rng = random.Random(1)
    plain = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(20))
    sample = [((plain() + f" zork{rng.choice('abcdefghij')}x blarg").encode() if i % 3 == 0 else plain().encode(), int(i % 3 == 0)) for i in range(300)]
    g = toxicity.fit(sample, {0: 200, 1: 100})
    assert b"blarg" in g.words and b"zork" in g.stems[4]
    features = lambda t: g.features(*g.clauses(t))
    assert features(b"alpha zorkqqx")[3] == 1.0 and features(b"alpha beta")[3] == 0.0


def test_repeated_words_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        w = [bytes([97 + rng.randrange(2)]) for _ in range(rng.randrange(0, 40))]
        wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        want = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(8)}
        assert rules.repeated_words(w) == len(want)


def test_rules_cases(docs, none):
    rows = {r["doc_id"]: r for r in rules.judge(rules.measured(docs, ["doc_id", "lang", "source"])).collect()}
    assert rows[0]["base_failed"] and not rows[0]["kept"] and rows[2]["n_words"] == 0
    assert (rows[17]["n_dup_lines"], rows[9]["n_symbols"], rows[10]["word_chars"]) == (2, 8, 13)
    assert rows[8]["n_words"] == 30_000 and rows[8]["base_failed"]
    assert rules.judge(rules.measured(docs, ["doc_id", "lang", "source"])).count() == docs.count()
    assert rules.judge(rules.measured(none, ["doc_id", "lang", "source"])).count() == 0


def many_measured(spark):
    """Two sources of one language, alike but in scale, a small third one, and rows that fail the base rules."""
    rng = random.Random(12)
    rows = []
    for source, k, n in (("a", 1, 400), ("b", 3, 400), ("few", 9, 30)):
        for i in range(n):
            far = i % 50 == 0
            rows.append((len(rows), "en", source, 1000, 1000 * (4 + k) + rng.randint(-200, 200) + 9000 * far, 20 * k + rng.randint(0, 40 * k) + 900 * far, k * (i % 7 == 0) + far, 10 * k * (i % 9 == 0) + far, 100))
    rows += [(10_000 + i, "en", "a", 19, 9, 9, 9, 0, 9) for i in range(50)] + [(20_000, None, None, 0, 0, 0, 0, 0, 0)]
    names = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    return spark.createDataFrame(rows, names)


def test_thresholds_follow_language_and_source(spark):
    rows = many_measured(spark)
    got = rules.judge(rows)
    by = {r["source"]: r for r in got.filter("doc_id < 10000").dropDuplicates(["source"]).collect()}
    for m in rules.MEASURES:
        assert by["a"][f"{m}_hi"] < by["b"][f"{m}_hi"], m
        assert by["few"][f"{m}_hi"] not in (by["a"][f"{m}_hi"], by["b"][f"{m}_hi"]) or m.endswith("share"), m
    alone = {r["source"]: r for r in rules.judge(rows, least=1).filter("doc_id < 10000").dropDuplicates(["source"]).collect()}
    assert by["a"].asDict().keys() == alone["a"].asDict().keys() and all(by["few"][f"{m}_hi"] != alone["few"][f"{m}_hi"] for m in ("mean_len", "symbol_share"))
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    far = [i for i in range(800) if i % 400 % 50 == 0]
    assert not any(kept[i] for i in far) and sum(kept[i] for i in range(800) if i not in far) > 770
    assert not any(kept[i] for i in range(10_000, 10_050)) and kept[20_000] is False


def test_fences_equal_quantiles_of_cells(spark):
    rows = many_measured(spark)
    got = {r["source"]: r for r in rules.judge(rows, least=1).filter("doc_id < 10000").dropDuplicates(["source"]).collect()}
    cell = lambda v: v >> max(v.bit_length() - 7, 0) << max(v.bit_length() - 7, 0)
    for source in ("a", "b", "few"):
        mine = [r for r in rows.collect() if r["source"] == source and r["n_words"] >= 20]
        values = {
            "mean_len": [1000 * r["word_chars"] // r["n_words"] for r in mine], "symbol_share": [100_000 * r["n_symbols"] // r["word_chars"] for r in mine],
            "dup_share": [100_000 * r["n_dup_lines"] // r["n_lines"] for r in mine], "repeat_share": [100_000 * r["n_repeat_words"] // r["n_words"] for r in mine],
        }
        for m, (level, reach, both) in rules.MEASURES.items():
            cells = sorted(map(cell, values[m]))
            q = lambda p: cells[max(-(-len(cells) * p // 1000), 1) - 1]  # noqa: B023, E731
            far = [c for c in cells if c > q(level)]
            if q(level) == q(500) and far:
                want = q(level) + max(1, (far[-(-len(far) * rules.BEYOND // 1000) - 1] - q(level)) // 2)
            else:
                want = q(level) + reach * (q(level) - q(500))
            assert got[source][f"{m}_hi"] == want
            assert got[source][f"{m}_lo"] == (q(1000 - level) - reach * (q(500) - q(1000 - level)) if both else 0)


def test_one_symbol_in_a_long_text_is_no_reason(spark):
    """A source of clean texts and some full of symbols: its fence lies between, not at zero."""
    names = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    rows = [(i, "en", "a", 1000, 5000, 500 + i if i < 6 else 1 if i == 6 else 0, 0, 0, 10) for i in range(100)]
    got = {r["doc_id"]: r for r in rules.judge(spark.createDataFrame(rows, names)).collect()}
    assert 0 < got[0]["symbol_share_hi"] < 10_000 and [i for i in range(100) if not got[i]["kept"]] == list(range(6))
    clean = {r["doc_id"]: r for r in rules.judge(spark.createDataFrame([(*r[:5], 0, *r[6:]) for r in rows], names)).collect()}
    assert all(r["kept"] for r in clean.values())


def test_sketches_merge_to_the_same(spark):
    rows = many_measured(spark).filter("n_words > 19").withColumns(rules.shares())
    key = ["level", "lang", "source", "measure", "bin"]
    whole = rules.sketches(rows)
    parts = rules.sketches(rows.filter("doc_id % 3 = 0")).unionByName(rules.sketches(rows.filter("doc_id % 3 <> 0"))).groupBy(*key).agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.select(*key, "n").collect()), key=repr) == sorted(map(tuple, parts.select(*key, "n").collect()), key=repr)


def test_license_scan(docs, none):
    rows = {r["doc_id"]: r for r in licenses.scan(docs, ["doc_id"]).collect()}
    assert (rows[13]["base_labels"], rows[13]["labels"], rows[13]["first_word"], rows[13]["score"]) == ("mit", "mit", 1, 1.0)
    assert (rows[14]["base_labels"], rows[14]["labels"], rows[14]["n_base"]) == ("", "apache-2", 0) and 0.9 < rows[14]["score"] < 1
    assert (rows[18]["n_base"], rows[18]["first_word"], rows[18]["last_word"]) == (2, 0, 3)
    assert (rows[0]["labels"], rows[0]["score"], rows[0]["first_word"]) == ("", 0.0, None)
    assert licenses.scan(none, ["doc_id"]).count() == 0


def test_seeds_miss_no_match():
    rng = random.Random(3)
    n = licenses.Notice(b"licensed under the apache license version 2 0", "a", 3)
    for _ in range(300):
        t = bytearray(n.text)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(t))
            kind = rng.randrange(3)
            if kind == 0:
                t[i] = rng.choice(b"abcxyz ")
            elif kind == 1:
                del t[i]
            else:
                t.insert(i, rng.choice(b"abcxyz"))
        text = b"some words before " + bytes(t) + b" and after"
        assert n.find(text) and n.pattern.search(text)


def test_a_better_match_hides_no_other():
    n = licenses.Notice(b"licensed under the apache license version 2 0", "a", 3)
    text = b"licensd under the apache license version 2 0 licensed under the apache license version 2 0"
    assert {(0, 44, 1), (45, 90, 0)} <= set(n.find(text))
    got = licenses.Scanner([("licensed under cc by 4 0", "cc-by", 1)]).scan(b"licensed under cc by 4 0. licensd under cc by 4 0! licensed undr cc by 4 0")
    assert got["spans"] == "cc-by:0-5:0;cc-by:6-11:1;cc-by:12-17:1"


@pytest.mark.parametrize("text,labels", [
    ("Licensed under the BSD license", "bsd"), ("released under the GPL license", "gpl"), ("licensed under the ISC license", "isc"), ("licensed under the EPL license", "epl"),
    ("licensed under the new license", ""), ("licensed under the old license", ""), ("Licensed under CC BY ND 4.0", "cc-by-nd"), ("GNU General Public License version 1", ""),
    ("licensed under the GNU General Public License version 1", ""), ("licensed under the GNU General Public License version 12", ""), ("licensed under the Apache License version 1 0", ""),
    ("licensed under the apach license, version 2.0", "apache-2"), ("licensd under the bsd license", "bsd"), ("licensed under the mti license", ""), ("licensed under cc by 3.0", "cc-by"),
    ("licensed under the GNU Lesser General Public License", "lgpl"), ("resublicensed under the bsd license", ""),
])
def test_names_are_not_edited(text, labels):
    assert licenses.Scanner().scan(text.encode())["labels"] == labels


@pytest.mark.parametrize("text,labels", [
    ("It is not licensed under the GPL license.", ""), ("This isn't released under the ISC License", ""), ("never licensed under the BSD 3-Clause License", ""), ("not licensed under the bsd license", ""),
    ("This is not free. Licensed under the GPL license", "gpl"), ("unlicensed under the isc license", ""), ("no code; BSD-2-Clause", "bsd-2"), ("Not the MIT License", ""),
    ("MIT License", "mit"), ("The MIT Licence", "mit"), ("BSD 3-Clause License", "bsd-3"), ("3-clause BSD license", "bsd-3"), ("BSD-2-Clause", "bsd-2"), ("GPLv3", "gpl-3"), ("GPL v2 or later", "gpl-2"), ("GNU GPL v3", "gpl-3"),
    ("LGPL v3", "lgpl"), ("Apache License, 2.0", "apache-2"), ("MPL 2.0", "mpl-2"), ("Boost Software License", "bsl"), ("CC0 1.0 Universal", "cc0"), ("bsd 4 clause license", ""), ("gpl v4", ""),
])
def test_denials_and_written_names(text, labels):
    assert licenses.Scanner().scan(text.encode())["labels"] == labels


def test_a_denied_notice_is_none():
    for text in ("unlicensed under the mit license", "not licensed under the MIT license", "not released under the mit license"):
        got = licenses.Scanner().scan(text.encode())  # the base phrase stays
        assert (got["base_labels"], got["labels"], got["spans"]) == ("mit", "mit", "")


def edits(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def test_scan_against_brute_force():
    rng = random.Random(11)
    pick = [0, 3, 4, 7, 10, 11, 14, 19, 25]
    notices = [licenses.NOTICES[i] for i in pick]
    scanner = licenses.Scanner(notices)
    labelled = 0
    for _ in range(500):
        words = []
        for _ in range(rng.randint(0, 3)):
            t = list(rng.choice([*notices, *notices, *licenses.NOTICES, ("licensed under the zlib license",), ("under the mit license",), ("cc by nc",)])[0])
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                i = rng.randrange(len(t))
                t[i : i + rng.randint(0, 1)] = rng.choice(["", "x", " ", "2"])
            words += [*"".join(t).split(), *rng.choices(["a", "license", "under", "not", "word"], k=rng.randint(0, 2))]
        flat = " ".join(words)
        found = []
        for text, label, most, names in notices:
            numbers, wanted = [w for w in text.split() if w.isdigit()], names.split()
            for i in range(len(words)):
                for j in range(i + 1, len(words) + 1):
                    span = " ".join(words[i:j])
                    if abs(len(span) - len(text)) <= most and (e := edits(span, text, most)) <= most:
                        have = [w for w in words[i:j] if w.isdigit()]
                        if any(w.isdigit() for w in wanted) and (not have or have != numbers[: len(have)]):
                            continue
                        rest = iter(words[i:j])
                        if all(any(w == n or len(n) > 4 and edits(w, n, 1) <= 1 for w in rest) for n in wanted):
                            no = any(w.encode() in licenses.DENIALS for w in words[max(0, i - licenses.REACH) : i]) or any(w[:2] == "un" and w[2:] in text.split() or w[:3] == "non" and w[3:] in text.split() for w in words[i:j])
                            found.append((e / len(text), -len(span), i, j, "" if no else label, e))
        taken = []
        for f in sorted(found):
            if all(f[3] <= t[2] or f[2] >= t[3] for t in taken):
                taken.append(f)
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        got = scanner.scan(flat.encode())
        assert (got["n_words"], got["n_base"]) == (len(words), len(places))
        assert (got["first_word"], got["last_word"]) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert got["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert got["labels"] == ",".join(sorted({x for _, x in places} | {t[4] for t in taken if t[4]})), flat
        spans = sorted((x.split(":")[0], int(x.split(":")[2])) for x in got["spans"].split(";") if x)
        assert spans == sorted((t[4], t[5]) for t in taken if t[4]), flat
        labelled += bool(taken)
    assert labelled > 120
