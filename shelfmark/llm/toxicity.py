"""Toxicity: a weighted finite-state grammar over clauses.

Method. A lexicon turns each word into a symbol with a weight: insult, threat, target, negation,
report, clause end or other. Five transducers read that stream and rewrite or weight it:

* ``threat``: a threat word counts only with a target in reach in the same clause;
* ``target``: an insult or threat near a person weighs more;
* ``negation``: what follows a negation in a clause weighs less;
* ``report``: what is said by others, a verb of saying in its clause, weighs less;
* ``insult``: a second insult in a clause weighs more than the first.

Besides its factor each weighted arc has marks: near a target, negated, reported. The weights that a
text's insults and threats have under each of these, and under none, are features of the calibrator, so
the labels decide how much a context counts; the factors are where it starts from.

They are composed once into one deterministic machine, which walks each text clause by clause; a
clause's score is the sum of its weighted arcs. Targets and verbs of saying count on either side of
the word: where the clause has them anywhere, the walk starts in the state that they lead to. A
negation counts forward only, to the end of its clause. A text is walked once, for its score and its
clauses. The insult words are a seed list and what the labelled sample shows beside it: words, and stems of four to six bytes with any ending, whose
documents are toxic far more often than others. Clause scores go through a logistic calibrator.

Cases. Null and empty texts have no clause and get the score of no evidence. A text is read whole.
Repeated rows get equal scores. Without labels the seeds alone decide. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import fitting
from shelfmark.llm.common import ALNUM_LOWER, as_bytes, crc_mod, per_batch, table

#: Bounds of the fit: labelled texts of a class, characters of a text that is learned from (all are scored
#: whole), and terms that are kept.
PER_CLASS = 3000
MAX_CHARS = 20_000
MAX_TERMS = 4000
STEMS = (4, 5, 6)
MIN_SHARE = 0.01

#: Marks of a weighted arc.
TARGETED, NEGATED, REPORTED = 1, 2, 4
N_FEATURES = 8

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

SEEDS: dict[int, str] = {
    INSULT: "idiot idiots moron morons stupid loser losers pathetic scum trash worthless clown disgusting dumb fool imbecile jerk vermin filth idiota estúpido imbécil idiote stupide crétin ordure dumm dummkopf abschaum trottel basura escoria",
    THREAT: "kill hurt destroy beat punch smash attack burn murder matar golpear tuer frapper töten schlagen umbringen",
    TARGET: "you your yours youre he she him her they them these those people du dich ihr euch sie tu te vous toi ils usted ustedes ellos",
    NEGATION: "not no never isn aren wasn don doesn didn nicht kein keine nie pas jamais aucun nunca jamás",
    REPORT: "said says say told wrote claimed quoted called according sagte sagt schrieb dit disait écrit dijo dice escribió",
}
#: Endings of a threat's other forms; a last e goes before those that begin with a vowel.
ENDINGS = ("", "s", "es", "d", "ed", "ing", "er", "t", "st", "en", "n")
CLAUSE_END = frozenset(b".!?;:\n")


class Transducer:
    """A deterministic weighted machine over symbols: ``arcs[state][symbol] = (state, symbol out, factor, marks)``."""

    def __init__(self, arcs: list[dict[int, tuple]]):
        self.arcs = [{s: (*a.get(s, (0 if s == END else i, s, 1.0)), 0)[:4] for s in range(7)} for i, a in enumerate(arcs)]

    def __matmul__(self, other: Transducer) -> Transducer:
        """Composition: this machine's output is the other's input, factors multiply, marks unite."""
        index, todo, made = {(0, 0): 0}, [(0, 0)], []
        while len(made) < len(todo):
            p, q = todo[len(made)]
            row = {}
            for s in range(7):
                p2, mid, f, m = self.arcs[p][s]
                q2, out, g, n = other.arcs[q][mid]
                if (p2, q2) not in index:
                    index[(p2, q2)] = len(todo)
                    todo.append((p2, q2))
                row[s] = (index[(p2, q2)], out, f * g, m | n)
            made.append(row)
        return Transducer(made)


def grammar() -> Transducer:
    threat = Transducer([{TARGET: (1, TARGET, 1.0), THREAT: (0, OTHER, 1.0)}, {THREAT: (1, INSULT, 1.0)}])
    target = Transducer([{TARGET: (1, OTHER, 1.0)}, {INSULT: (1, INSULT, 1.5, TARGETED)}])
    negation = Transducer([{NEGATION: (1, OTHER, 1.0)}, {INSULT: (1, INSULT, 0.5, NEGATED)}])
    report = Transducer([{REPORT: (1, OTHER, 1.0)}, {INSULT: (1, INSULT, 0.5, REPORTED)}])
    insult = Transducer([{INSULT: (1, INSULT, 1.0)}, {INSULT: (1, INSULT, 1.25)}])
    return threat @ target @ negation @ report @ insult


def forms(word: str) -> set[str]:
    """A word with the endings of its other forms."""
    return {(word[:-1] if word.endswith("e") and e[:1] in ("e", "i") else word) + e for e in ENDINGS}


@dataclass
class Grammar:
    words: dict[bytes, tuple[int, float]] = field(default_factory=dict)
    stems: dict[int, dict[bytes, float]] = field(default_factory=dict)
    calibrator: dict[str, list[float]] = field(default_factory=dict)
    machine: Transducer = field(default_factory=grammar)

    def clauses(self, text: bytes | None) -> tuple[int, list[tuple[float, int, int]], list[float]]:
        """Number of words, (score, first byte, byte after) of each clause that scores, and the weight under each mark and none."""
        if not text:
            return 0, [], [0.0] * 4
        words = text.translate(ALNUM_LOWER).split()
        known, stems = self.words, list(self.stems.items())
        if not any(w in known and known[w][0] in (INSULT, THREAT) for w in words) and not any(w[:n] in s for n, s in stems for w in words):
            return len(words), [], [0.0] * 4
        found, run, marked = [], [], [0.0] * 4
        low, at, first = text.translate(ALNUM_LOWER), 0, 0
        for w in words:
            start = low.index(w, at)
            if any(c in CLAUSE_END for c in text[at:start]):
                if score := self.weigh(run, marked):
                    found.append((score, first, at))
                run, first = [], start
            symbol, weight = known.get(w, (OTHER, 0.0))
            if symbol == OTHER:
                for n, s in stems:
                    if w[:n] in s:
                        symbol, weight = INSULT, s[w[:n]]
            if symbol != OTHER:
                run.append((symbol, weight))
            at = start + len(w)
        if score := self.weigh(run, marked):
            found.append((score, first, at))
        return len(words), found, marked

    def weigh(self, run: list[tuple[int, float]], marked: list[float] | None = None) -> float:
        """Score of one clause, given its symbols but OTHER, which no transducer acts on; adds to ``marked`` what is marked."""
        symbols = {s for s, _ in run}
        if INSULT not in symbols and THREAT not in symbols:
            return 0.0
        arcs, score = self.machine.arcs, 0.0
        state = 0
        for context in (TARGET, REPORT):
            if context in symbols:
                state = arcs[state][context][0]
        for symbol, weight in run:
            state, out, factor, marks = arcs[state][symbol]
            if out == INSULT:
                score += weight * factor
                if marked is not None:
                    for k in [i for i in range(3) if marks >> i & 1] or [3]:
                        marked[k] += weight
        return score

    def features(self, n: int, found: list[tuple[float, int, int]], marked: list[float]) -> list[float]:
        """What is calibrated, of a text of ``n`` words with the clauses ``found`` and weights by mark."""
        scores = [s for s, _, _ in found]
        total = sum(scores)
        return [math.log1p(total), math.log1p(max(scores, default=0.0)), math.log1p(100 * total / (n + 20)), float(bool(scores)), *map(math.log1p, marked)]


def _terms(text: bytes) -> set[tuple[int, bytes]]:
    words = set(text.translate(ALNUM_LOWER).split())
    return {(0, w) for w in words} | {(n, w[:n]) for n in STEMS for w in words if len(w) >= n}


def learn_terms(g: Grammar, shown: list[tuple[bytes, int]], totals: dict[int, int]) -> None:
    """Seeds, and the words and stems that the shown texts set apart."""
    g.words = {f.encode(): (THREAT, 3.0) for w in SEEDS[THREAT].split() for f in forms(w)}
    g.words |= {w.encode(): (symbol, 3.0) for symbol, words in SEEDS.items() for w in words.split()}
    g.stems = {}
    toxic, clean = Counter(), Counter()
    n1 = n0 = 0
    for text, y in shown:
        if y:
            toxic.update(_terms(text))
            n1 += 1
    # chance finds are rare in many documents: a term must show in a hundredth of the toxic ones
    least = max(3, math.ceil(MIN_SHARE * n1))
    toxic = Counter({t: c for t, c in toxic.items() if c >= least})
    for text, y in shown:
        if not y:
            clean.update(_terms(text) & toxic.keys())
            n0 += 1
    odds = {t: math.log((c + 0.1) / (n1 + 1)) - math.log((clean[t] + 0.1) / (n0 + 1)) for t, c in toxic.items()}
    # a term speaks for itself if its documents are toxic at least nine times in ten at the true rate of classes
    prior = math.log(max(totals.get(0, 1), 1) / max(totals.get(1, 1), 1))
    good = sorted((t for t, v in odds.items() if v >= prior + math.log(9)), key=lambda t: (-toxic[t] * odds[t], t))[:MAX_TERMS]
    for n, term in good:
        weight = min(odds[(n, term)], 6.0)
        if n:
            g.stems.setdefault(n, {})[term] = weight
        elif g.words.get(term, (INSULT, 0))[0] == INSULT:
            g.words[term] = (INSULT, weight)


def fit(sample: list[tuple[bytes, int]], totals: dict[int, int]) -> Grammar:
    """The calibrator is fitted on even rows under terms from odd ones; the terms kept are those of all rows."""
    g = Grammar()
    shown, fitted = sample[1::2], sample[::2]
    learn_terms(g, shown, totals)
    x = np.array([g.features(*g.clauses(t)) for t, _ in fitted]).reshape(-1, N_FEATURES)
    y = np.array([y for _, y in fitted], dtype=float)
    weight = np.array([totals.get(int(v), 1) / max(1, (y == v).sum()) for v in y])
    if len(y) and y.min() < y.max():
        g.calibrator = fitting.logistic(x, y, weight * len(y) / weight.sum(), 0.1)
    else:  # nothing to fit on: one full insult is even odds
        g.calibrator = {"mean": [0.0] * N_FEATURES, "scale": [1.0] * N_FEATURES, "beta": [-4.0, 3.0, *[0.0] * (N_FEATURES - 1)]}
    learn_terms(g, sample, totals)
    return g


def train(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> Grammar:
    return fit(*fitting.labelled_sample(docs, labels, "toxic", usable, per_class, MAX_CHARS))


def score(docs: DataFrame, model: Grammar, keep: list[str]) -> DataFrame:
    """Add ``score``, the number of scoring clauses and the heaviest one's span in bytes."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_TERMS terms and the seeds

    def make():
        g = sent.value

        def run(batch: pa.RecordBatch) -> dict[str, list]:
            texts = as_bytes(batch.column("text"))
            walked = [g.clauses(t) for t in texts]
            x = np.array([g.features(*w) for w in walked]).reshape(-1, N_FEATURES)
            spans = [found for _, found, _ in walked]
            top = [max(s, default=(0.0, None, None)) for s in spans]
            return {"score": fitting.probability(g.calibrator, x).tolist(), "n_clauses": [len(s) for s in spans], "clause_start": [t[1] for t in top], "clause_end": [t[2] for t in top]}

        return run

    return per_batch(docs.select(*dict.fromkeys([*keep, "text"])), make, "score double, n_clauses long, clause_start long, clause_end long", keep)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    scored = score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_clauses",
    )
