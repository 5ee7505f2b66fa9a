"""SimHash near-dedup by the generalised pigeonhole principle.

Method. A text's fingerprint has a bit set where over half of its 3-word shingles' hashes have it.
Equal fingerprints are one class. For links at up to ``RADIUS`` differing bits the 64 bits are dealt
into ``m`` parts, correlated bits together, and each part gets its own threshold; thresholds add up to
``RADIUS - m + 1`` (-1 leaves a part out). Two fingerprints within the radius then differ in some part
by no more than its threshold. Dynamic programming picks the thresholds, and m, of least estimated
cost; part distances are estimated on a bounded sample of fingerprints (the fit changes cost only,
never what is found). Each class is placed under its value of a part and probes the values around it;
candidates that meet under a value are verified on all 64 bits.

Classes under one value are linked by a spanning forest, not by all pairs: a breadth-first walk
compares only what no tree has reached yet, so that a group of n copies yields n - 1 links. A
value under which very many fingerprints meet (counted on every ``HOT_SAMPLE``-th one, which decides
where the work is done and nothing else) is split over tasks: two within the radius agree on one of
four quarters of their bits at least, and meet there. Large runs within a task are split likewise. Connected components of the forest give the class ids.

Cases. Null and empty texts have fingerprint zero and link like any other. Texts of one or two words
hash as one shingle. A null doc_id takes part and its component's id is the smallest id there is, or
null. Repeated rows share a class. Texts are read whole; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import ASCII_LOWER, as_bytes, named, per_batch, table
from shelfmark.llm.positions import FILE, ROW, placed, repeated
from shelfmark.operators.graph import components
from shelfmark.session import stash

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Bound of the sample that thresholds are fitted on.
SAMPLE = 2048
#: Relative costs of moving a probe and of comparing a pair.
PROBE_COST, PAIR_COST = 1.0, 0.004
SMALL_RUN, LARGE_RUN = 8, 20_000
HOT_SAMPLE = 16


def fingerprint(text: bytes | None) -> int:
    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(flat, SEED)]
    else:
        hashes = [digest(flat[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])]
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):  # bounded memory for texts of any length
        part = np.array(hashes[i : i + 4096], "<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * total > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    def make():
        return lambda batch: {"fp": [fingerprint(t) for t in as_bytes(batch.column("text"))]}

    return per_batch(docs.select(*dict.fromkeys([*keep, "text"])), make, "fp long", keep)


@dataclass(frozen=True)
class Partition:
    """Masks of the parts and their thresholds."""

    masks: tuple[int, ...]
    thresholds: tuple[int, ...]
    cost: float


def _grouped_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into parts of near equal width, each grown by the bit most correlated with it."""
    spread = bits - bits.mean(0)
    norm = np.sqrt((spread**2).sum(0)) + 1e-9
    corr = np.abs(spread.T @ spread) / norm[:, None] / norm[None, :]
    left, out = list(range(64)), []
    for p in range(parts):
        width = 64 // parts + (p < 64 % parts)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            nxt = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(nxt)
            left.remove(nxt)
        out.append(sorted(group))
    return out


def fit_partition(sample: np.ndarray, n: int, radius: int = RADIUS) -> Partition:
    """The cheapest parts and thresholds for ``n`` distinct fingerprints."""
    sample = sample.astype(np.uint64)
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float) if len(sample) else np.zeros((1, 64))
    pairs = max(1, len(sample) * (len(sample) - 1))
    best = None
    for parts in range(2, radius + 2):
        masks = [sum(1 << b for b in g) for g in _grouped_bits(bits, parts)]
        need = radius - parts + 1
        # table[s]: least cost and thresholds of the parts so far that add up to s
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for mask in masks:
            width, seen = mask.bit_count(), np.zeros(radius + 1)
            own = sample & np.uint64(mask)
            for i in range(0, len(own), 256):
                d = np.bitwise_count(own[i : i + 256, None] ^ own[None, :])
                seen += np.bincount(np.minimum(d.ravel(), radius + 1), minlength=radius + 2)[: radius + 1]
            seen[0] -= len(own)
            near = np.cumsum(seen) / pairs
            cost = {-1: 0.0} | {t: PROBE_COST * n * (1 + sum(comb(width, k) for k in range(1, t + 1)) / 2) + PAIR_COST * n * n / 2 * float(near[t]) for t in range(radius + 1)}
            grown: dict[int, tuple[float, tuple[int, ...]]] = {}
            for s, (c, chosen) in table.items():
                for t, extra in cost.items():
                    if s + t not in grown or c + extra < grown[s + t][0]:
                        grown[s + t] = (c + extra, (*chosen, t))
            table = grown
        if need in table and (best is None or table[need][0] < best.cost):
            best = Partition(tuple(masks), table[need][1], table[need][0])
    return best


def forest(fps: np.ndarray, radius: int = RADIUS, bit: int = 0) -> list[tuple[int, int]]:
    """Links that connect all of ``fps`` (distinct) that are connected within the radius."""
    if len(fps) > LARGE_RUN and bit < 64:
        out = []
        for k in range(radius + 1):  # each pair within the radius agrees on one of radius + 1 parts
            width = 64 // (radius + 1)
            key = (fps >> np.uint64(k * width)) & np.uint64((1 << width) - 1)
            order = np.argsort(key, kind="stable")
            for run in np.split(fps[order], np.flatnonzero(np.diff(key[order])) + 1):
                if len(run) > 1:
                    out += forest(run, radius, 64 if len(run) == len(fps) else bit + 16)
        return out
    out, left = [], np.sort(fps)
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            f = todo.pop()
            near = np.bitwise_count(left ^ f) <= radius
            if near.any():
                hit = left[near]
                out.extend((int(f), int(h)) for h in hit)
                todo.extend(hit)
                left = left[~near]
    return out


def _links(part: np.ndarray, key: np.ndarray, sub: np.ndarray, fp: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal (part, key, sub)."""
    cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0) | (np.diff(sub) != 0)) + 1
    start = np.concatenate([[0], cut])
    size = np.diff(np.append(start, len(key)))
    useful = (size > 1) & (np.add.reduceat(home.astype(np.int64), start) > 0)
    u, v = [], []
    small = np.repeat(useful & (size <= SMALL_RUN), size)
    run = np.repeat(np.arange(len(size)), size)
    for k in range(1, SMALL_RUN):
        same = small[:-k] & (run[:-k] == run[k:])
        i = np.flatnonzero(same)
        i = i[(home[i] | home[i + k]) & (np.bitwise_count(fp[i] ^ fp[i + k]) <= radius)]
        u.append(fp[i])
        v.append(fp[i + k])
    for r in np.flatnonzero(useful & (size > SMALL_RUN)):
        got = np.array(forest(np.unique(fp[start[r] : start[r] + size[r]]), radius), np.uint64).reshape(-1, 2)
        u.append(got[:, 0])
        v.append(got[:, 1])
    u, v = np.concatenate(u), np.concatenate(v)
    return np.maximum(u, v), np.minimum(u, v)


def links(classes: DataFrame, radius: int = RADIUS, hot: int = LARGE_RUN) -> DataFrame:
    """``(u, v)`` of fingerprints: a graph with the components of all links within the radius.

    Values under which more than about ``hot`` fingerprints meet are split over tasks.
    """
    n = classes.count()
    sample = [r["fp"] for r in classes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    fitted = fit_partition(np.array(sample, np.int64).view(np.uint64), n, radius)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    probes = []
    for i, (mask, t) in enumerate(zip(fitted.masks, fitted.thresholds)):
        if t < 0:
            continue
        own = [1 << b for b in range(64) if mask >> b & 1]
        flips = [sum(c) for k in range(1, t + 1) for c in combinations(own, k)]
        value = F.col("fp").bitwiseAND(F.lit(signed(mask)))
        probes.append(F.array(F.struct(F.lit(i).alias("part"), value.alias("key"), F.lit(True).alias("home"))))
        if flips:  # of two neighbours only the one of greater value calls on the other
            around = F.transform(F.array(*(F.lit(signed(x)) for x in flips)), lambda f: value.bitwiseXOR(f))  # noqa: B023
            probes.append(F.transform(F.filter(around, lambda k: k < value), lambda k: F.struct(F.lit(i).alias("part"), k.alias("key"), F.lit(False).alias("home"))))  # noqa: B023
    placed = classes.select("fp", F.explode(F.concat(*probes)).alias("p")).select("p.part", "p.key", "p.home", "fp")
    # few rows: one for each value that some ``hot`` placed fingerprints share
    often = placed.filter(F.pmod(F.xxhash64("fp"), F.lit(HOT_SAMPLE)) == 0).groupBy("part", "key").agg(F.count("*").alias("n")).filter(F.col("n") * HOT_SAMPLE > hot)
    often = stash(often.select("part", "key", F.lit(True).alias("often")), "hot-values")
    width = 64 // (radius + 1)
    quarters = F.array(*(F.lit(k << width) + F.shiftrightunsigned("fp", k * width).bitwiseAND(F.lit((1 << width) - 1)) + 1 for k in range(radius + 1)))
    spread = F.explode(F.when(F.col("often"), quarters).otherwise(F.array(F.lit(0).cast("long"))))
    placed = placed.join(often, ["part", "key"], "left").select("part", "key", "home", "fp", spread.alias("sub"))
    runs = placed.repartition("part", "key", "sub").sortWithinPartitions("part", "key", "sub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = []  # batches of the run that is open, joined once it ends
        out = lambda u, v: pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (u, v)], ["u", "v"])
        joined = lambda: [np.concatenate(x) for x in zip(*kept)]
        for batch in batches:
            now = [batch.column("part").to_numpy(), batch.column("key").to_numpy(), batch.column("sub").to_numpy(), batch.column("fp").to_numpy().view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False)]
            if not len(now[0]):
                continue
            goes_on = kept and all(kept[0][i][0] == now[i][-1] for i in range(3))
            kept.append(now)
            if goes_on:  # rows are sorted: this whole batch is of the open run
                continue
            whole = joined()
            # the last run may go on in the next batch
            change = np.flatnonzero((whole[2] != whole[2][-1]) | (whole[1] != whole[1][-1]) | (whole[0] != whole[0][-1]))
            cut = change[-1] + 1 if len(change) else 0
            kept = [[a[cut:] for a in whole]]
            if cut:
                yield out(*_links(*(a[:cut] for a in whole), radius))
        if kept:
            yield out(*_links(*joined(), radius))

    return runs.mapInArrow(run, "u long, v long")


def grouped(prints: DataFrame, hot: int = LARGE_RUN) -> DataFrame:
    """Add ``component_id``, the least id or null, and ``component``, the least print, to written rows of ``doc_id, fp``."""
    classes = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    joined = components(links(classes.select("fp"), hot=hot))
    ids = classes.join(joined, classes["fp"] == joined["node"])
    least = ids.groupBy("component").agg(F.min("rep").alias("component_id"))
    moved = joined.join(least, "component").select(F.col("node").alias("fp"), "component_id", "component")
    ids = stash(classes.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("component", "fp").alias("component")), "component-ids")
    return prints.join(ids, "fp")


def dedup(docs: DataFrame) -> DataFrame:
    """One document of each group, that of the smallest id (null ids last, ties by hash, then place), in its own columns.

    Only places of the rows that go travel back to the texts.
    """
    rows = placed(docs)
    tie = F.xxhash64(*(named(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()))
    narrow = rows.select(FILE, ROW, F.col("doc_id").cast("long").alias("doc_id"), tie.alias("tie"), "text")
    prints = stash(fingerprints(narrow, [FILE, ROW, "doc_id", "tie"]), "prints")
    # by the component itself, as its least id may be null or stand in another one too
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tie", FILE, ROW)
    chosen = stash(grouped(prints).groupBy("component").agg(F.min(order).alias("m")).select(f"m.{FILE}", f"m.{ROW}"), "chosen")
    gone = prints.select(FILE, ROW).join(chosen, [FILE, ROW], "left_anti").withColumn("n", F.lit(0))
    return repeated(rows, gone, 1)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stash(fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]), "prints")
    return grouped(prints).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
