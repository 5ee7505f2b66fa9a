"""Benchmark decontamination on a positional inverted index.

Method. Documents are indexed in shards of a bounded number of words, one row a shard, whatever the
benchmark: the sorted terms of the shard, and for each its ascending positions, delta-coded in seven
bits a byte. The index is a table in the shared folder; it is built in one pass over the corpus and
answers any number of benchmarks (``build_index``, ``search``). Its own counts say which terms are
rare. A test window is answered by taking its terms from the rarest on, shifting each posting list by
the term's offset, and intersecting; what is left are the exact places of the window. Windows whose
rarest term the shard lacks cost nothing, and postings that no window asks for are not decoded. A
document word within a place is hit.

Proximity: an item whose ``NEAR_TERMS`` rarest terms (all, if it has fewer, but at least two) stand within
``NEAR_SPAN`` words of the rarest one, in any order, is a near match. Terms that no document has are passed
over. Near matches do not contaminate; ``op6_near`` returns them.

Shards split documents between rows, never windows, so no key gathers anything: a passage shared by a
third of the corpus costs each shard its own part. A document longer than a shard is a shard of its
own. The benchmark is the query set; it is broadcast in blocks of at most ``BLOCK_WORDS`` words, each
answered from the same stored index, and the blocks' answers meet under the row's number in it.

Cases. Null and empty texts have no words and no hits; an item without words has no window; one of
fewer than ten words is one window. Items of equal text all match; repeated items count once by id;
an item without id could not be named and is none.
Repeated documents are rows of their own. Empty tables give no hits. Extra columns are not read. A
``doc_id`` may be a whole number or a string.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import alnum_lists, alnum_words, give_back, slices, table
from shelfmark.llm.positions import FILE, ROW, placed, repeated
from shelfmark.session import small_batches, stash

WINDOW = 10
SHARD_WORDS = 500_000
SHARD_DOCS = 2000
BLOCK_WORDS = 2_000_000
NEAR_TERMS, NEAR_SPAN = 4, 20

@dataclass
class Queries:
    """A block of the benchmark: its vocabulary, distinct windows and the items they belong to."""

    terms: dict[bytes, int] = field(default_factory=dict)
    windows: dict[tuple[int, ...], list[str]] = field(default_factory=dict)
    items: list[tuple[str, tuple[int, ...]]] = field(default_factory=list)

    def add(self, item_id: object, words: list[bytes]) -> None:
        ids = tuple(self.terms.setdefault(w, len(self.terms)) for w in words)
        name = str(item_id)
        for i in range(max(1, len(ids) - WINDOW + 1)) if ids else ():
            owners = self.windows.setdefault(ids[i : i + WINDOW], [])
            if name not in owners:
                owners.append(name)
        if ids:
            self.items.append((name, tuple(dict.fromkeys(ids))))


def blocks_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Queries]:
    """The benchmark in blocks of bounded size, streamed partition by partition."""
    block, n = Queries(), 0
    for row in benchmark.filter(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", F.col("text").cast("binary").alias("t")).toLocalIterator():
        words = alnum_words(bytes(row["t"]))
        if n and n + len(words) > block_words:
            yield block
            block, n = Queries(), 0
        block.add(row["item_id"], words)
        n += len(words)
    if n:
        yield block


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as bytes of seven bits, the last byte of each under 128; and the bytes of each."""
    size = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > k)
        out[start[on] + k] = ((values[on] >> 7 * k) & 127) | np.where(size[on] > k + 1, 128, 0)
    return out, size


def decoded(blob: np.ndarray) -> np.ndarray:
    """Ascending positions from their delta-coded bytes."""
    ends = np.flatnonzero(blob < 128)
    start = np.append(0, ends[:-1] + 1)
    size, out = ends - start + 1, (blob[start] & 127).astype(np.int64)
    for k in range(1, int(size.max(initial=0))):
        on = np.flatnonzero(size > k)
        out[on] |= (blob[start[on] + k] & 127).astype(np.int64) << 7 * k
    return np.cumsum(out)


def _key_type(docs: DataFrame) -> tuple[T.DataType, pa.DataType]:
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    return (T.LongType(), pa.int64()) if whole else (T.StringType(), pa.string())


def _order(codes: np.ndarray) -> np.ndarray:
    """A stable sort of codes by their two halves, each by counting."""
    first = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    return first[np.argsort((codes >> 16).astype(np.uint16)[first], kind="stable")]


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index of ``docs(doc_id, text)``: rows are numbered in it, and know their ``doc_id``."""
    kind, arrow = _key_type(docs)
    rows = docs.select(F.monotonically_increasing_id().alias("_dc_row"), F.col("doc_id").cast(kind).alias("doc_id"), "text")
    schema = f"rows array<bigint>, doc_ids array<{kind.simpleString()}>, bounds binary, terms binary, term_sizes binary, counts binary, sizes binary, postings binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def shard(numbers: list[pa.Array], keys: list[pa.Array], words: list[pa.Array], counts: list[np.ndarray]) -> pa.RecordBatch:
        flat = pa.concat_arrays(words).dictionary_encode()
        by_name = pc.sort_indices(flat.dictionary).to_numpy()
        terms = flat.dictionary.take(pa.array(by_name))
        rank = np.empty(len(by_name), np.int32)
        rank[by_name] = np.arange(len(by_name), dtype=np.int32)
        codes = rank[flat.indices.to_numpy()]
        at = _order(codes).astype(np.int64)
        n = np.bincount(codes, minlength=len(terms))
        first = np.cumsum(n) - n
        gap = np.diff(at, prepend=0)
        gap[first] = at[first]
        postings, size = coded(gap)
        bounds = np.append(0, np.cumsum(np.concatenate(counts)))
        blobs = [
            bounds.astype("<i8"), "".join(terms.to_pylist()).encode(), pc.binary_length(terms).to_numpy().astype("<i4"), n.astype("<i4"),
            (np.add.reduceat(size, first) if len(size) else size).astype("<i4"), postings,
        ]
        lists = [pa.array([pa.concat_arrays(numbers).to_pylist()], pa.list_(pa.int64())), pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(arrow))]
        return pa.RecordBatch.from_arrays([*lists, *(pa.array([b if isinstance(b, bytes) else b.tobytes()], pa.binary()) for b in blobs)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, n_docs = [], 0, 0
        for batch in chain.from_iterable(map(slices, batches)):
            lists, counts = alnum_lists(batch.column("text"))
            ends, at = np.cumsum(counts), 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                stop = min(int(np.searchsorted(ends, before + shard_words - n)) + 1, at + SHARD_DOCS - n_docs, batch.num_rows)
                upto = int(ends[stop - 1])
                held.append((batch.column("_dc_row").slice(at, stop - at), batch.column("doc_id").slice(at, stop - at), lists.slice(before, upto - before), counts[at:stop]))
                n, n_docs, at = n + upto - before, n_docs + stop - at, stop
                if n >= shard_words or n_docs >= SHARD_DOCS:
                    yield shard(*map(list, zip(*held)))
                    held, n, n_docs = [], 0, 0
        if held:
            yield shard(*map(list, zip(*held)))
        held = []
        give_back()

    small_batches(docs.sparkSession)
    return stash(rows.mapInArrow(run, schema), "postings")


def _terms(blob: bytes, sizes: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(sizes, "<i4")).tolist()
    return [blob[a:b] for a, b in zip([0, *ends], ends)]


def document_counts(index: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Postings of each term of a block in the whole index; one row a term comes back."""
    sent = index.sparkSession.sparkContext.broadcast(vocabulary)  # at most BLOCK_WORDS terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, total = sent.value.get, np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.fromiter((get(t, -1) for t in _terms(row["terms"], row["term_sizes"])), np.int64)
                total[ids[ids >= 0]] += np.frombuffer(row["counts"], "<i4")[ids >= 0]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["term", "n"])

    rows = index.select("terms", "term_sizes", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(vocabulary), np.int64)
    for r in rows:
        out[r["term"]] = r["n"]
    return out


class Plan:
    """The block's windows grouped by their rarest term, each with its other terms from rare to common."""

    def __init__(self, queries: Queries, counts: np.ndarray):
        self.by_rarest: dict[int, list[tuple[int, list[tuple[int, int]], int, list[str]]]] = defaultdict(list)
        for window, owners in queries.windows.items():
            order = sorted(range(len(window)), key=lambda i: (counts[window[i]], window[i], i))
            if counts[window[order[0]]]:
                self.by_rarest[window[order[0]]].append((order[0], [(window[i], i) for i in order[1:]], len(window), owners))
        self.near: dict[int, list[tuple[list[int], str]]] = defaultdict(list)
        for name, terms in queries.items:
            asked = min(NEAR_TERMS, len(terms))
            rare = sorted((t for t in terms if counts[t]), key=lambda t: (counts[t], t))[:asked]
            if len(rare) == asked > 1:
                self.near[rare[0]].append((rare[1:], name))

    def answer(self, bounds: np.ndarray, blobs: dict[int, np.ndarray]):
        """For a shard's delta-coded postings by term: places ``(document, first word, words, owners)`` and near matches ``(document, item)``."""
        read: dict[int, np.ndarray] = {}
        where = blobs

        def postings(t: int) -> np.ndarray:
            if t not in read:
                read[t] = decoded(blobs[t])
            return read[t]

        places, near = [], set()
        for t in blobs:
            for offset, others, size, owners in self.by_rarest.get(t, ()):
                left = postings(t) - offset
                for other, o in others:
                    if other not in where:
                        left = left[:0]
                        break
                    at = postings(other)
                    want = left + o
                    i = np.searchsorted(at, want)
                    left = left[at[np.minimum(i, len(at) - 1)] == want]
                    if not len(left):
                        break
                left = left[left >= 0]
                if len(left):
                    doc = np.searchsorted(bounds, left, side="right") - 1
                    inside = left + size <= bounds[doc + 1]
                    places.extend((int(d), int(p), size, owners) for d, p in zip(doc[inside], left[inside]))
            for others, name in self.near.get(t, ()):
                if any(o not in where for o in others):
                    continue
                left = postings(t)
                doc = np.searchsorted(bounds, left, side="right") - 1
                ok = np.ones(len(left), bool)
                for o in others:
                    at = postings(o)
                    low = np.searchsorted(at, np.maximum(left - NEAR_SPAN, bounds[doc]))
                    ok &= at[np.minimum(low, len(at) - 1)] < np.minimum(left + NEAR_SPAN + 1, bounds[doc + 1])
                    ok &= low < len(at)
                near.update((int(d), name) for d in doc[ok])
        return places, near


def search(index: DataFrame, queries: Queries) -> DataFrame:
    """One row a document: merged hit spans (words from 0), ids of the items found and nearly found."""
    plan = Plan(queries, document_counts(index, queries.terms))
    sent = index.sparkSession.sparkContext.broadcast((queries.terms, plan))  # bounded like the block it is made from
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.string()
    schema = f"_dc_row long, doc_id {kind}, n_words long, hit_from array<bigint>, hit_to array<bigint>, items array<string>, near array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, plan = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                bounds, postings = np.frombuffer(row["bounds"], "<i8"), np.frombuffer(row["postings"], np.uint8)
                ends = np.cumsum(np.frombuffer(row["sizes"], "<i4"), dtype=np.int64).tolist()
                known = ((vocabulary.get(t), a, b) for t, a, b in zip(_terms(row["terms"], row["term_sizes"]), [0, *ends], ends))
                places, near = plan.answer(bounds, {t: postings[a:b] for t, a, b in known if t is not None})
                n = len(row["doc_ids"])
                spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
                items: list[set[str]] = [set() for _ in range(n)]
                close: list[set[str]] = [set() for _ in range(n)]
                for d, p, size, owners in places:
                    spans[d].append((p - int(bounds[d]), p - int(bounds[d]) + size))
                    items[d].update(owners)
                for d, name in near:
                    close[d].add(name)
                merged: list[list[list[int]]] = []
                for found in spans:
                    out: list[list[int]] = []
                    for a, b in sorted(found):
                        if out and a <= out[-1][1]:
                            out[-1][1] = max(out[-1][1], b)
                        else:
                            out.append([a, b])
                    merged.append(out)
                longs, names = pa.list_(pa.int64()), pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["rows"], pa.int64()), pa.array(row["doc_ids"], arrow), pa.array(np.diff(bounds)), pa.array([[a for a, _ in m] for m in merged], longs), pa.array([[b for _, b in m] for m in merged], longs)]
                    + [pa.array([sorted(s) for s in x], names) for x in (items, [c - i for c, i in zip(close, items)])],
                    [f.split()[0] for f in schema.split(", ")],
                )
        give_back()

    return index.mapInArrow(run, schema)


def hits(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, items, near`` for every row of ``docs``."""
    index = build_index(docs)
    found = [search(index, q) for q in blocks_of(benchmark, block_words)] or [search(index, Queries())]
    if len(found) == 1:
        return found[0].select("doc_id", "n_words", F.aggregate(F.zip_with("hit_to", "hit_from", lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y).alias("n_hit"), "items", "near")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    pairs = F.arrays_zip("hit_from", "hit_to")
    one = every.groupBy("_dc_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list(pairs))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    step = lambda s, x: F.struct((s["n"] + F.greatest(x["hit_to"] - F.greatest(s["end"], x["hit_from"]), F.lit(0))).alias("n"), F.greatest(s["end"], x["hit_to"]).alias("end"))
    return one.select("doc_id", "n_words", F.aggregate("spans", start, step, lambda s: s["n"]).alias("n_hit"), "items", F.array_except("near", "items").alias("near"))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items found in other words: near matches of each document without its exact ones."""
    found = hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.size("near").cast("long").alias("n_near"), F.array_join("near", ",").alias("near"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, in their own columns; only places of the rows that go travel back to the texts."""
    rows = placed(docs)
    found = hits(rows.select(F.concat_ws(":", FILE, ROW).alias("doc_id"), "text"), benchmark).filter("n_hit > 0")
    at = F.split("doc_id", ":")
    return repeated(rows, found.select(at[0].cast("long").alias(FILE), at[1].cast("long").alias(ROW), F.lit(0).alias("n")), 1)
