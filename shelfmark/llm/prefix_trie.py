"""Prefix trie of conversations: which share their first turns, and what sharing these would save.

Method. A turn is a number (a hash of role and text); the fingerprint of the first d turns is the
polynomial ``F(d) = F(d-1) * BASE + turn`` modulo a prime, which numpy scans find for sorted runs of
turns. Fingerprints compose: a conversation that spans partitions has a fingerprint for each of its
runs, and one whose first turns come from another is corrected by one difference times a power of the
base, so no task walks a conversation that it does not hold. Conversations of equal depth and
fingerprint are a candidate node, whose representative is the smallest conv_id.

Verification. Each member's last turn and parent candidate are compared with the representative's, and
turns of one number are compared by role and text; as the parents are verified in the same way, that
is turn by turn. Where a comparison fails, the conversations concerned get a second fingerprint of
fresh hashes, by which the candidates split, and are verified again.

Rollup. With depth the members of a conversation's node get fewer, so once it is the representative it
stays so. From that depth, known for each conversation, sums over a node's subtree are sums over its
members: a leaf counts for its representative; the words that members repeat are those between the
node and the depth where the member's own representation begins. No step goes depth by depth.

Cases. Turns of a conversation go by number (null first), role, text; null roles and texts are empty.
Rows without a conv_id belong to no conversation and are left out. Repeated rows are turns. A table
without conversations has no nodes. Columns other than the four are not read. A conversation of any
length and a first turn that all share are no hot task: runs are cut by ranges of turns, nodes are
pre-aggregated, and ids that end at one node are joined to text piece by piece in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import BLANK_WORD, table
from shelfmark.llm.positions import FILE, ROW, placed
from shelfmark.session import small_batches, stash

PRIME = (1 << 61) - 1
ROUNDS = 6
#: Ids in a piece of the text that is hashed for a node's ends.
PIECE = 20_000
NODE = ["depth", "f", "x"]


@dataclass(frozen=True)
class Field:
    """Arithmetic modulo a prime: 2**61 - 1, or one below 2**31."""

    prime: int
    base: int
    seed: int

    def mul(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
        if self.prime < 1 << 31:
            return a * b % np.uint64(self.prime)
        s31, s30, s61, p = np.uint64(31), np.uint64(30), np.uint64(61), np.uint64(PRIME)
        low31, low30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
        ah, al, bh, bl = a >> s31, a & low31, b >> s31, b & low31
        mid = ah * bl + al * bh
        total = np.uint64(2) * ah * bh + (mid >> s30) + ((mid & low30) << s31) + al * bl
        total = (total & p) + (total >> s61)
        return np.where(total >= p, total - p, total)

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        p = np.uint64(self.prime)
        total = np.asarray(a, np.uint64) + np.asarray(b, np.uint64)
        return np.where(total >= p, total - p, total)

    def sub(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.add(a, np.uint64(self.prime) - np.asarray(b, np.uint64) % np.uint64(self.prime))

    def power(self, n: np.ndarray) -> np.ndarray:
        """The base to each of these powers."""
        n, out, square = np.asarray(n, np.int64), np.ones(len(n), np.uint64), np.array([self.base], np.uint64)
        for bit in range(int(n.max(initial=0)).bit_length()):
            out = np.where(n >> bit & 1, self.mul(out, square), out)
            square = self.mul(square, square)
        return out

    def scan(self, turns: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Fingerprints of the prefixes of runs; ``place`` counts 0, 1, .. in each, from the batch's start in the first."""
        out, k, step = np.asarray(turns, np.uint64).copy(), 1, np.array([self.base], np.uint64)
        longest = int(place.max(initial=0)) + 1
        while k < longest:
            out[k:] = np.where(place[k:] >= k, self.add(out[k:], self.mul(out[:-k], step)), out[k:])
            k, step = 2 * k, self.mul(step, step)
        return out

    def turn(self) -> Column:
        """A turn's number."""
        return F.pmod(F.xxhash64(F.lit(self.seed), F.length("role"), "role", "text"), F.lit(self.prime))


def field_of(turn: int, prime: int) -> Field:
    """The field of a round, each with hashes and a base of its own; ``prime`` is the first one's."""
    prime = prime if turn == 0 else PRIME
    base = int(np.random.default_rng(turn + 11).integers(2, prime - 1)) if prime > 4 else 2
    return Field(prime, base, 1000 + turn)


def turns_of(conversations: DataFrame) -> DataFrame:
    rows = placed(conversations).filter("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")), FILE, ROW)


_RUN = f"conv long, part long, i long, f long, t long, words long, upto long, {FILE} long, {ROW} long"


def _runs(turns: DataFrame, field: Field) -> DataFrame:
    """Turns in order with their place ``i`` in the run of a conversation in a partition, fingerprints and words up to them."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranges = [*order[:3], F.substring("text", 1, 64)]
    rows = turns.repartitionByRange(*ranges).sortWithinPartitions(*order)
    rows = rows.select("conv", field.turn().alias("t"), F.regexp_count("text", F.lit(BLANK_WORD)).cast("long").alias("words"), FILE, ROW)
    names = [c.split()[0] for c in _RUN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv_before, n_before, f_before, w_before = None, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, t, words = (batch.column(c).to_numpy() for c in ("conv", "t", "words"))
            first = np.append(True, conv[1:] != conv[:-1])
            start = np.maximum.accumulate(np.where(first, np.arange(len(conv)), 0))
            place = np.arange(len(conv)) - start
            f = field.scan(t, place)
            total = np.cumsum(words)
            upto = total - (total - words)[start]
            i = place + 1
            if conv[0] == conv_before:  # the run goes on from the batch before
                open_ = start == 0
                f[open_] = field.add(f[open_], field.mul(np.uint64(f_before), field.power(i[open_])))
                i[open_] += n_before
                upto[open_] += w_before
            conv_before, n_before, f_before, w_before = conv[-1], int(i[-1]), int(f[-1]), int(upto[-1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (conv, np.full(len(conv), part, np.int64), i, f.astype(np.int64), t, words, upto)] + [batch.column(FILE), batch.column(ROW)], names)

    return stash(rows.mapInArrow(run, _RUN), "runs")


_HEAD = f"array<struct<f: bigint, t: bigint, words: bigint, upto: bigint, {FILE}: bigint, {ROW}: bigint>>"


def _conversations(runs: DataFrame, field: Field, most: int) -> DataFrame:
    """One row a conversation: turns, words, first ``most`` turns, and what lies before each of its runs."""
    turn = F.struct("i", "f", "t", "words", "upto", FILE, ROW)
    by_run = runs.groupBy("conv", "part").agg(F.max("i").alias("n"), F.max_by("f", "i").alias("f"), F.max("upto").alias("w"), F.array_sort(F.collect_list(F.when(F.col("i") <= most, turn))).alias("heads"))
    lists = by_run.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "n", "f", "w", "heads"))).alias("list"))
    parts = "array<struct<part: bigint, before: bigint, f: bigint, w: bigint>>"
    schema = f"conv long, n long, w long, heads {_HEAD}, parts {parts}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.struct([(k, pa.int64()) for k in ("f", "t", "words", "upto", FILE, ROW)]), pa.struct([(k, pa.int64()) for k in ("part", "before", "f", "w")])]
        for batch in batches:
            n_of, w_of, heads_of, parts_of = [], [], [], []
            for row in batch.column("list").to_pylist():
                n, f, w, heads, parts = 0, 0, 0, [], []
                for r in row:
                    parts.append({"part": r["part"], "before": n, "f": f, "w": w})
                    shift = [pow(field.base, h["i"], field.prime) for h in r["heads"]]
                    heads += [h | {"f": (f * s + h["f"]) % field.prime, "upto": w + h["upto"]} for h, s in zip(r["heads"], shift) if n + h["i"] <= most]
                    f, n, w = (f * pow(field.base, r["n"], field.prime) + r["f"]) % field.prime, n + r["n"], w + r["w"]
                n_of.append(n)
                w_of.append(w)
                heads_of.append([{k: h[k] for k in ("f", "t", "words", "upto", FILE, ROW)} for h in heads])
                parts_of.append(parts)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(n_of, pa.int64()), pa.array(w_of, pa.int64()), pa.array(heads_of, pa.list_(kinds[0])), pa.array(parts_of, pa.list_(kinds[1]))], ["conv", "n", "w", "heads", "parts"])

    return stash(lists.mapInArrow(run, schema), "conversations")


@dataclass(frozen=True)
class Graft:
    """Conversation ``conv`` begins with the first ``turns(conv)`` turns of ``base(conv)`` in place of its own, ``most`` at most."""

    base: Callable[[Column], Column]
    turns: Callable[[Column], Column]
    most: int


#: Conversations as they are.
NO_GRAFT = Graft(lambda conv: conv, lambda conv: F.lit(0), 0)
_MEMBER = f"conv long, part long, depth long, f long, t long, pf long, words long, before long, ends boolean, {FILE} long, {ROW} long"


def _members(turns: DataFrame, field: Field, graft: Graft) -> tuple[DataFrame, DataFrame]:
    """One row for each conversation and depth from 0 on; and one row a conversation: ``conv, n, w, parts``."""
    small_batches(turns.sparkSession, 10_000)
    runs = _runs(turns, field)
    own = _conversations(runs, field, graft.most)
    base = own.select(F.col("conv").alias("base"), F.col("heads").alias("given"))
    plan = own.withColumns({"base": graft.base(F.col("conv")).cast("long"), "h": graft.turns(F.col("conv")).cast("long")}).join(base, "base", "left")
    plan = plan.withColumn("given", F.slice(F.coalesce("given", F.array().cast(_HEAD)), F.lit(1), F.col("h").cast("int")))
    plan = plan.withColumn("hb", F.size("given").cast("long"))
    at = lambda c, k, name: F.coalesce(F.get(c, (F.col(k) - 1).cast("int"))[name], F.lit(0))
    plan = plan.select(
        "conv",
        "parts",
        "h",
        "hb",
        "given",
        (F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"),
        F.pmod(at("given", "hb", "f") - at("heads", "h", "f"), F.lit(field.prime)).alias("delta"),
        (at("given", "hb", "upto") - at("heads", "h", "upto")).alias("dw"),
        F.when(F.col("n") > F.col("h"), F.col("w") + at("given", "hb", "upto") - at("heads", "h", "upto")).otherwise(at("given", "hb", "upto")).alias("w"),
    )
    plan = stash(plan, "plan")
    names = [c.split()[0] for c in _MEMBER.split(", ")]
    roots = plan.select("conv", F.lit(-1).cast("long").alias("part"), *(F.lit(0).cast("long").alias(c) for c in ("depth", "f", "t", "pf", "words", "before")), (F.col("n") == 0).alias("ends"), *(F.lit(None).cast("long").alias(c) for c in (FILE, ROW)))
    heads = plan.select("conv", "n", "given", F.posexplode("given").alias("j", "g")).select(
        "conv",
        F.lit(-1).cast("long").alias("part"),
        (F.col("j") + 1).cast("long").alias("depth"),
        F.col("g.f").alias("f"),
        F.col("g.t").alias("t"),
        F.coalesce(F.get("given", F.col("j") - 1)["f"], F.lit(0)).alias("pf"),
        F.col("g.words").alias("words"),
        (F.col("g.upto") - F.col("g.words")).alias("before"),
        (F.col("j") + 1 == F.col("n")).alias("ends"),
        F.col(f"g.{FILE}").alias(FILE),
        F.col(f"g.{ROW}").alias(ROW),
    )
    by_part = plan.select("conv", "h", "hb", "n", "delta", "dw", F.explode("parts").alias("p")).select("conv", "h", "hb", "n", "delta", "dw", F.col("p.part").alias("part"), F.col("p.before").alias("p_n"), F.col("p.f").alias("p_f"), F.col("p.w").alias("p_w"))
    met = runs.join(by_part, ["conv", "part"]).filter("p_n + i > h")
    inverse = pow(field.base, -1, field.prime)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {k: batch.column(k).to_numpy() for k in ("i", "f", "t", "words", "upto", "h", "hb", "n", "delta", "dw", "p_n", "p_f", "p_w")}
            after = c["p_n"] + c["i"] - c["h"]
            f = field.add(c["f"], field.mul(c["p_f"], field.power(c["i"])))
            f = field.add(f, field.mul(c["delta"], field.power(after)))
            parent = field.mul(field.sub(f, c["t"]), np.uint64(inverse))
            depth = after + c["hb"]
            made = [depth, f.astype(np.int64), c["t"], parent.astype(np.int64), c["words"], c["p_w"] + c["upto"] + c["dw"] - c["words"], depth == c["n"]]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("part"), *map(pa.array, made), batch.column(FILE), batch.column(ROW)], names)

    return stash(roots.unionByName(heads).unionByName(met.mapInArrow(run, _MEMBER)), "members"), plan.select("conv", "n", "w", "parts")


def _collided(turns: DataFrame, field: Field) -> DataFrame:
    """Numbers that stand for turns of different role or text."""
    turn = F.struct("role", "text")
    return turns.select(field.turn().alias("t"), turn.alias("turn")).groupBy("t").agg(F.min("turn").alias("a"), F.max("turn").alias("b")).filter("a != b").select("t")


def _nodes(members: DataFrame) -> DataFrame:
    """Candidate nodes; ``differs``: some member's last turn or parent is not the representative's."""
    by_rep = {c: F.min_by(c, "conv").alias(c) for c in ("pf", "px", "before", "words", FILE, ROW)}
    differs = [F.min(c) != F.max(c) for c in ("t", "tx", "pf", "px")]
    return members.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"), *by_rep.values(), (differs[0] | differs[1] | differs[2] | differs[3]).alias("differs")
    )


def _verified(turns: DataFrame, graft: Graft, prime: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members with verified node keys ``depth, f, x``; nodes; conversations."""
    field = field_of(0, prime)
    members, convs = _members(turns, field, graft)
    members = members.withColumns({c: F.lit(0).cast("long") for c in ("x", "px", "tx")})
    bad_turns = stash(_collided(turns, field), "collided")
    bad = None
    for turn in range(1, ROUNDS):
        nodes = stash(_nodes(members), "nodes")
        wrong = members.join(nodes.filter("differs").select(*NODE), NODE, "left_semi").select("conv", "depth")
        if not bad_turns.isEmpty():
            wrong = wrong.union(members.filter("depth > 0").join(bad_turns, (F.col("tx") if turn > 1 else members["t"]) == bad_turns["t"], "left_semi").select("conv", "depth"))
        if wrong.isEmpty():
            return members, nodes, convs
        # from the first such depth on, these conversations get a second fingerprint of fresh hashes
        wrong = wrong if bad is None else wrong.union(bad)
        bad = stash(wrong.groupBy("conv").agg(F.min("depth").alias("since")), "split")
        field = field_of(turn, prime)
        needed = bad.select("conv").union(bad.select(graft.base(F.col("conv")).cast("long"))).distinct()
        part = turns.join(needed, "conv", "left_semi")
        again, _ = _members(part, field, graft)
        above = F.when(F.col("depth") > F.col("since"), F.col("pf")).alias("px2")
        again = again.join(bad, "conv").filter("depth >= since").select("conv", "depth", F.col("f").alias("x2"), above, F.col("t").alias("tx2"))
        fresh = {c: F.coalesce(c + "2", F.lit(0).cast("long")) for c in ("x", "px", "tx")}
        members = stash(members.join(again, ["conv", "depth"], "left").withColumns(fresh).drop("x2", "px2", "tx2"), "members")
        bad_turns = stash(_collided(part, field), "collided")
    raise ValueError(f"turns still collide after {ROUNDS} rounds of fresh hashes")


def _ends(members: DataFrame) -> DataFrame:
    """The SHA-256 of each node's ending conversations, ascending and joined by commas, from ordered pieces of that text."""
    order = [*NODE, "conv"]
    rows = members.filter("ends").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    names = [*NODE, "conv", "piece"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [batch.column(c).to_numpy() for c in NODE]
            conv = batch.column("conv").to_numpy()
            new = np.zeros(len(conv), bool)
            for k in key:
                new[1:] |= k[1:] != k[:-1]
            new[:1] = True
            starts = np.flatnonzero(new)
            cuts = np.unique(np.concatenate([starts, *(np.arange(a, b, PIECE) for a, b in zip(starts, [*starts[1:], len(conv)]))])).astype(np.int64)
            made = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts, [*cuts[1:], len(conv)])]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[cuts]) for k in key), pa.array(conv[cuts]), pa.array(made)], names)

    joined = rows.mapInArrow(pieces, "depth long, f long, x long, conv long, piece string")
    joined = joined.repartition(*NODE).sortWithinPartitions(*order)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, sha = None, None
        for batch in batches:
            done: list[tuple] = []
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in [*NODE, "piece"])):
                if key != open_:
                    if sha:
                        done.append((*open_, sha.hexdigest()))
                    open_, sha = key, hashlib.sha256(piece.encode())
                else:
                    sha.update(b"," + piece.encode())
            yield made(done)
        if sha:
            yield made([(*open_, sha.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 4, kinds)], [*NODE, "ends_sha256"])

    return joined.mapInArrow(digests, "depth long, f long, x long, ends_sha256 string")


def trie(conversations: DataFrame, graft: Graft = NO_GRAFT, prime: int = PRIME) -> DataFrame:
    """One row a node: the contract's columns, its representative's last turn by place (``_ps_file, _ps_row``) and ``words``."""
    turns = turns_of(conversations)
    members, nodes, convs = _verified(turns, graft, prime)
    # the depth from which a conversation is its nodes' representative, and the words before it
    reps = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("r"), F.min_by("before", "depth").alias("wr"), F.bool_or(F.col("n_convs") == F.col("n_ends")).alias("leaf"))
    facts = convs.join(reps, "conv", "left").select(
        "conv",
        F.explode(F.concat(F.transform("parts", lambda p: p["part"]), F.array(F.lit(-1).cast("long")))).alias("part"),
        F.coalesce("r", F.col("n") + 1).alias("r"),
        F.coalesce("wr", "w").alias("wr"),
        F.coalesce("leaf", F.lit(False)).cast("long").alias("leaf"),
    )
    sums = members.select(*NODE, "conv", "part", "before").join(facts, ["conv", "part"]).groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum(F.when(F.col("r") > F.col("depth"), F.col("wr") - F.col("before")).otherwise(0)).alias("saved_tokens"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pf").alias("f"), F.col("px").alias("x")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f").alias("pf"), F.col("x").alias("px"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, NODE).join(children, NODE, "left").join(_ends(members), NODE, "left").join(parents, ["depth", "pf", "px"], "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "words",
        FILE,
        ROW,
    )


#: How the query's conversations are rebuilt.
REBUILT = Graft(lambda conv: conv - conv % 20, lambda conv: F.crc32(conv.cast("string").cast("binary")) % 4, 3)


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"), REBUILT).drop("words", FILE, ROW)


#: The 32-bit CRC is folded over the bits of the id's digits; -1 stands for one shift.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda b: [ascii(b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, e: CASE WHEN e >= 0 THEN xor(s, e) ELSE xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT c.conv_id, t.p AS d, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.p <= c.h),
hb AS (SELECT conv_id, count(*) AS hb FROM g GROUP BY conv_id),
r AS (
  SELECT * FROM g
  UNION ALL SELECT t.conv_id, t.p - c.h + coalesce(hb, 0), t.role, t.text FROM t JOIN c USING (conv_id) LEFT JOIN hb USING (conv_id) WHERE t.p > c.h),
s AS (SELECT conv_id, d, text, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY d) AS k FROM r),
ln AS (SELECT c.conv_id, coalesce(max(d), 0) AS n FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
m AS (
  SELECT s.conv_id, d, md5(k::VARCHAR) AS k, text, d = n AS ends, k[1:d - 1]::VARCHAR AS up FROM s JOIN ln USING (conv_id)
  UNION ALL SELECT conv_id, 0, md5('[]'), '', n = 0, NULL FROM ln),
nodes AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, md5(any_value(up)) AS up, any_value(text) AS text,
    string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM m GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
v AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS saved FROM nodes LEFT JOIN kids USING (d, k)),
lines AS (SELECT DISTINCT a.d AS ad, a.k AS ak, b.d, b.k FROM m a JOIN m b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (SELECT ad AS d, ak AS k, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens FROM lines JOIN v USING (d, k) GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN sums USING (d, k) LEFT JOIN nodes p ON p.d = v.d - 1 AND p.k = v.up
"""
