"""Token ids in shard files, found by document through a minimal perfect hash.

Format. A shard is two files. ``<name>.ids`` is the raw payload: ids one after the other, little-endian,
16 bits each if the vocabulary has at most 65,536 ids, else 32. ``<name>.idx`` is a header of six
64-bit numbers (magic, bytes an id, rows, keys, buckets, 0) and the arrays: row keys with a null flag,
row offsets in ids (rows + 1), a displacement for each bucket, and for each slot the fingerprint, first
row and number of rows of its key. ``manifest.idx`` has, for each shard in order, its partition and
number in it, ids before it, ids, rows, rows with a key, and its first and last key.

Method. Keys fall into buckets by one hash; a bucket of several keys has the smallest displacement
under which all its keys' second hashes meet free slots, and a bucket of one names its slot outright.
As many slots as keys: the hash is minimal and perfect. A lookup finds the shard (or shards, for an id
of many rows) by the manifest's key ranges; there it is two hashes, one compare of the stored
fingerprint and of the key itself, and a read of that slice of the payload.

Texts are encoded where they are read, and only ids travel on. Rows are then range-partitioned by id,
so shards are in ascending order and none depends on another; a shard is written under a temporary
name and renamed, so a task that runs twice leaves one file. Repeated ids are rows of one key. Null
ids come last. Ids must be whole numbers. The manifest has 64 bytes for some ``SHARD_IDS`` ids.

Cases. Null and empty texts are the end id alone. Texts of any length are encoded whole; a shard
closes after ``SHARD_IDS`` ids. An empty table writes no shard. Extra columns are not read. A key
that no shard has gives no row; a key asked for twice is looked up once.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import give_back, slices, table
from shelfmark.session import drop_stash, fresh_path, small_batches, stash

END_ID = 0
SHARD_IDS = 16_000_000
#: Words kept by a worker; at that number the half that was met least often goes.
CACHE = 500_000
#: Least bytes of input that a range partition should have; from 25 GB on they grow with the square root of it, to 500 MB at 100 TB.
PART_BYTES = 8_000_000
MAGIC = 0x31534449_4B4D4853
FINGER_SEED, BUCKET_SEED = 0x5EED, 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Words:
    """Known words in the order in which they came, and the ids of each."""

    def __init__(self, dtype: np.dtype):
        self.words = pa.array([], pa.large_string())
        self.ids, self.size, self.met = np.zeros(0, dtype), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, words: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ids, self.size, self.met = np.concatenate([self.ids, ids]), np.concatenate([self.size, size]), np.concatenate([self.met, np.zeros(len(size), np.int64)])

    def start(self) -> np.ndarray:
        return np.cumsum(self.size, dtype=np.int32) - self.size

    def shed(self, keep: int) -> None:
        """Beyond ``keep`` words, the half of them that was met least often goes."""
        n = len(self.size)
        if n > keep:
            at = np.sort(np.argpartition(self.met, n // 2)[n // 2 :])
            self.ids = self.ids[_spread(self.start()[at], self.size[at])]
            self.words, self.size, self.met = self.words.take(pa.array(at)), self.size[at], self.met[at] // 2


class Encoder:
    """The library's ids, each distinct word asked for once while a bounded table keeps it.

    The pre-tokenizer never joins what stands before and after a blank that follows or precedes a
    non-blank, so a text may be encoded word by word, a word with the blank before it. Texts where a
    blank stands between white space are encoded in one piece. Words that start and end in other than
    white space are sent to the library as one text: only a word's first token begins with a blank.
    """

    SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    JOINED = rf"{SPACE} (?:{SPACE}|\z)"

    def __init__(self, path: str, keep: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        size = self.tk.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.keep = keep
        self.added = tuple(t.content for t in self.tk.get_added_tokens_decoder().values())
        self.opens = np.zeros(size, bool)
        for token, i in self.tk.get_vocab(with_added_tokens=False).items():
            self.opens[i] = token.startswith("\u0120")  # how a token shows a blank
        #: Words after a blank, and first words of texts, which have none before them.
        self.later, self.first = _Words(self.dtype), _Words(self.dtype)

    def _direct(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tk.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for g in got for i in g], self.dtype), np.array([len(g) for g in got], np.int32)

    def _after_blanks(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are sent as one text, and how many each has."""
        text = " " + " ".join(words)
        if not any(a in text for a in self.added):
            ids = np.array(self.tk.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            first = np.flatnonzero(self.opens[ids])
            if len(first) == len(words):
                return ids.astype(self.dtype), np.diff(np.append(first, len(ids))).astype(np.int32)
        return self._direct([" " + w for w in words])

    def _entries(self, known: _Words, names: pa.Array, count: np.ndarray) -> np.ndarray:
        """The entry of each name that is counted, after asking the library for new ones."""
        asked = np.flatnonzero(count)
        words = names if len(asked) == len(names) else names.take(pa.array(asked))
        found = pc.index_in(words, value_set=known.words)
        at = pc.fill_null(found, -1).to_numpy().copy()
        if found.null_count:
            new, place = words.filter(found.is_null()), np.flatnonzero(at < 0)
            plain = np.zeros(len(new), bool)
            if known is self.later:
                plain = pc.and_(pc.equal(pc.utf8_trim_whitespace(new), new), pc.not_equal(new, "")).to_numpy(zero_copy_only=False)
            before = " " if known is self.later else ""
            for mask, ask in ((plain, self._after_blanks), (~plain, lambda ws: self._direct([before + w for w in ws]))):
                if mask.any():
                    part = new.filter(pa.array(mask))
                    at[place[mask]] = len(known.size) + np.arange(len(part))
                    known.add(part, *ask(part.to_pylist()))
        entry = np.zeros(len(names), np.int32)
        entry[asked] = at
        known.met[entry[asked]] += count[asked]
        return entry

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with the end id after each text, and the number of them for each text."""
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        joined = pc.match_substring_regex(texts, self.JOINED)
        whole = np.flatnonzero(joined.to_numpy(zero_copy_only=False))
        pieces = self._direct(texts.filter(joined).to_pylist())
        lists = pc.split_pattern(pc.if_else(joined, "", texts) if len(whole) else texts, " ")
        coded = lists.flatten().dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary
        edges = lists.offsets.to_numpy()
        at_first = (edges - edges[0])[:-1]
        heads = codes[at_first]
        count = np.bincount(heads, minlength=len(names))
        for known in (self.later, self.first):
            known.shed(self.keep)
        entry = self._entries(self.first, names, count)[heads]
        at = self._entries(self.later, names, np.bincount(codes, minlength=len(names)) - count)[codes]
        # one table of later words, first words, and texts that are encoded in one piece
        sizes = [self.later.size, self.first.size, pieces[1]]
        entry += len(sizes[0])
        entry[whole] = len(sizes[0]) + len(sizes[1]) + np.arange(len(whole))
        at[at_first] = entry
        size = np.concatenate(sizes)
        start, flat = np.cumsum(size, dtype=np.int32) - size, np.concatenate([self.later.ids, self.first.ids, pieces[0]])
        per_word = size[at]
        ids = flat[_spread(start[at], per_word)]
        n = np.add.reduceat(per_word, at_first, dtype=np.int64)
        out, into, of = np.empty(len(ids) + len(n), self.dtype), 0, 0
        for k in n.tolist():
            out[into : into + k] = ids[of : of + k]
            out[into + k] = END_ID
            into, of = into + k + 1, of + k
        return out, n + 1


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of runs one after the other."""
    out = np.repeat(start - (np.cumsum(size, dtype=np.int32) - size), size)
    return np.add(out, np.arange(len(out), dtype=np.int32), out=out)


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder a worker process, so that tasks after the first find words in its table."""
    return Encoder(path)


def _key(doc_id: int | None) -> bytes:
    return b"null" if doc_id is None else int(doc_id).to_bytes(8, "little", signed=True)


def perfect_hash(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Displacements by bucket, and the slot of each key."""
    n = len(keys)
    n_buckets = max(1, n // 3)
    buckets: dict[int, list[int]] = {}
    for i, k in enumerate(keys):
        buckets.setdefault(xxhash.xxh64_intdigest(k, BUCKET_SEED) % n_buckets, []).append(i)
    moves, slots, used = np.zeros(n_buckets, np.int64), np.zeros(n, np.int64), bytearray(n)
    singles = []
    for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
        if len(members) == 1:
            singles.append((b, members[0]))
            continue
        d = 2
        while True:
            at = [xxhash.xxh64_intdigest(keys[i], d) % n for i in members]
            if len(set(at)) == len(at) and not any(used[s] for s in at):
                break
            d += 1
        moves[b] = d
        for i, s in zip(members, at):
            used[s], slots[i] = 1, s
    free = (s for s in range(n) if not used[s])
    for b, i in singles:
        slots[i] = next(free)
        moves[b] = -slots[i] - 1
    return moves, slots


class Shard:
    """An open shard: its index in memory, its payload in the file until it is asked for."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str):
        with fs.open_input_file(path + ".idx") as f:
            raw = f.read()
        head = np.frombuffer(raw, "<i8", 6)
        if head[0] != MAGIC:
            raise ValueError(f"not a shard index: {path}")
        width, rows, keys, buckets = (int(x) for x in head[1:5])
        arrays, at = [], 48
        for kind, n in (("<i8", rows), ("u1", rows), ("<i8", rows + 1), ("<i8", buckets), ("<u4", keys), ("<u4", keys), ("<u4", keys)):
            arrays.append(np.frombuffer(raw, kind, n, at))
            at += arrays[-1].nbytes
        self.ids, self.nulls, self.offsets, self.moves, self.prints, self.first, self.count = arrays
        self.fs, self.path, self.kind, self.payload = fs, path, np.dtype(f"<u{width}"), None

    def load(self) -> Shard:
        """Read the whole payload, for a walk over all rows."""
        with self.fs.open_input_file(self.path + ".ids") as f:
            self.payload = np.frombuffer(f.read(), self.kind)
        return self

    def rows_of(self, doc_id: int | None) -> range:
        key = _key(doc_id)
        n = len(self.prints)
        if not n:
            return range(0)
        d = int(self.moves[xxhash.xxh64_intdigest(key, BUCKET_SEED) % len(self.moves)])
        slot = -d - 1 if d < 0 else xxhash.xxh64_intdigest(key, d) % n
        if self.prints[slot] != xxhash.xxh64_intdigest(key, FINGER_SEED) & 0xFFFFFFFF:
            return range(0)
        at = int(self.first[slot])
        if (None if self.nulls[at] else int(self.ids[at])) != doc_id:  # an unknown key of the same fingerprint
            return range(0)
        return range(at, at + int(self.count[slot]))

    def tokens(self, row: int) -> np.ndarray:
        a, b = int(self.offsets[row]), int(self.offsets[row + 1])
        if self.payload is not None:
            return self.payload[a:b]
        with self.fs.open_input_file(self.path + ".ids") as f:
            return np.frombuffer(f.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize), self.kind)


def _commit(fs: pyarrow.fs.FileSystem, path: str, chunks: list[bytes]) -> None:
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as f:
        for c in chunks:
            f.write(c)
    if fs.get_file_info(path).type != pyarrow.fs.FileType.NotFound:
        fs.delete_file(path)
    fs.move(temp, path)


def write_shard(fs: pyarrow.fs.FileSystem, path: str, width: int, ids: list[int | None], lengths: np.ndarray, payload: list[bytes]) -> None:
    rows = np.arange(len(ids))
    new = np.array([i == 0 or ids[i] != ids[i - 1] for i in rows], bool)
    first = np.flatnonzero(new)
    keys = [_key(ids[i]) for i in first]
    moves, slots = perfect_hash(keys)
    prints, start, count = (np.zeros(len(keys), "<u4") for _ in range(3))
    prints[slots] = [xxhash.xxh64_intdigest(k, FINGER_SEED) & 0xFFFFFFFF for k in keys]
    start[slots], count[slots] = first, np.diff(np.append(first, len(ids)))
    head = np.array([MAGIC, width, len(ids), len(keys), len(moves), 0], "<i8")
    index = [head, np.array([i or 0 for i in ids], "<i8"), np.array([i is None for i in ids], "u1"), np.append(0, np.cumsum(lengths)).astype("<i8"), moves.astype("<i8"), prints, start, count]
    _commit(fs, path + ".ids", payload)
    _commit(fs, path + ".idx", [a.tobytes() for a in index])


MANIFEST = ("part", "sub", "before", "n_ids", "n_docs", "n_keyed", "first", "last")


def _name(part: int, sub: int) -> str:
    return f"shard-{part:06d}-{sub:04d}"


@cache
def _manifest(folder: str) -> dict[str, np.ndarray]:
    """The manifest's columns, in the order of shards."""
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/manifest.idx") as f:
        rows = np.frombuffer(f.read(), "<i8").reshape(-1, len(MANIFEST))
    return dict(zip(MANIFEST, rows.T))


@dataclass(frozen=True)
class Shards:
    """Written shards; ``files`` has a row for each: ``name, before, n_ids, n_docs``."""

    folder: str
    files: DataFrame

    def lookup(self, keys: DataFrame) -> DataFrame:
        """``doc_id, start, ids`` of every row of the ids in ``keys(doc_id)``; ids are 16 or 32 bits each."""
        folder = self.folder

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = _manifest(folder)
            keyed, nulls = np.flatnonzero(m["n_keyed"]), np.flatnonzero(m["n_keyed"] < m["n_docs"])
            for batch in batches:
                at, key = [], []
                for k in batch.column("doc_id").to_pylist():
                    if k is None:
                        met = nulls
                    else:
                        met = keyed[np.searchsorted(m["last"][keyed], k) : np.searchsorted(m["first"][keyed], k, side="right")]
                    at += met.tolist()
                    key += [k] * len(met)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(key, pa.int64())], ["shard", "doc_id"])

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = _manifest(folder)
            fs, base = pyarrow.fs.FileSystem.from_uri(folder)
            number, shard = -1, None
            for batch in batches:
                for n, k in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist()):
                    if n != number:
                        number, shard = n, Shard(fs, f"{base}/{_name(m['part'][n], m['sub'][n])}")
                    for r in shard.rows_of(k):
                        start = int(m["before"][n]) + int(shard.offsets[r])
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([start], pa.int64()), pa.array([shard.tokens(r).tobytes()], pa.binary())], ["doc_id", "start", "ids"])

        asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().mapInArrow(route, "shard long, doc_id long")
        return asked.repartition("shard").sortWithinPartitions("shard").mapInArrow(probe, "doc_id long, start long, ids binary")


def _ranges(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Ascending bounds of id ranges with about as many rows each, and the number of ranges for null ids.

    An id of very many rows is several bounds in a row, and its rows are dealt to the ranges between
    them. Only ids are read. The number of ranges follows the size that the plan states.
    """
    spark = docs.sparkSession
    stated = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows, keyed = docs.agg(F.count("*"), F.count("doc_id")).first()
    n = max(1, min(rows, max(spark.sparkContext.defaultParallelism, stated // max(PART_BYTES, 50 * isqrt(stated)))))
    null_ranges = -(-n * (rows - keyed) // max(rows, 1))
    steps = max(1, n - null_ranges)
    if steps == 1 or not keyed:
        return np.zeros(0, np.int64), null_ranges
    bounds = docs.agg(F.percentile_approx("doc_id", [i / steps for i in range(1, steps)], min(20 * steps, 1_000_000))).first()[0]
    return np.array(bounds, np.int64), null_ranges


def encoded(docs: DataFrame, tokenizer: str, bounds: np.ndarray, null_ranges: int) -> DataFrame:
    """``range, doc_id, tie, ids`` for every row of ``doc_id, tie, text``: the raw ids with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in chain.from_iterable(map(slices, batches)):
            keys, tie = batch.column("doc_id"), batch.column("tie")
            key, row = pc.fill_null(keys, 0).to_numpy(), tie.to_numpy()
            low, high = np.searchsorted(bounds, key), np.searchsorted(bounds, key, side="right")
            place = low + row % (high - low + 1)
            none = keys.is_null().to_numpy(zero_copy_only=False)
            place[none] = len(bounds) + 1 + row[none] % max(null_ranges, 1)
            ids, sizes = encoder.encode(batch.column("text"))
            edges = np.append(0, np.cumsum(sizes)) * encoder.dtype.itemsize
            made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), keys, tie, made], ["range", "doc_id", "tie", "ids"])
        give_back()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, "range int, doc_id long, tie long, ids binary")


def write(docs: DataFrame, folder: str, tokenizer: str, shard_ids: int = SHARD_IDS) -> Shards:
    """Encode and write all rows of ``doc_id, text``, and the manifest, to a folder that holds nothing yet.

    Rows of one id are dealt by their place in ``docs``, which should be a stored table.
    """
    p = docs.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    store = p.getFileSystem(docs.sparkSession._jsc.hadoopConfiguration())
    if store.exists(p) and len(store.listStatus(p)):
        raise ValueError(f"the folder holds files already: {folder}")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds, null_ranges = _ranges(rows)
    rows = encoded(rows.withColumn("tie", F.monotonically_increasing_id()), tokenizer, bounds, null_ranges)
    rows = rows.repartitionById(len(bounds) + 1 + max(null_ranges, 1), "range").sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "tie").select("doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = encoder_of(tokenizer).dtype.itemsize
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        part, sub, total = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        payload: list[bytes] = []

        def flush() -> pa.RecordBatch:
            write_shard(fs, f"{base}/{_name(part, sub)}", size, ids, np.concatenate(lengths), payload)
            keyed = [i for i in (ids[0], next((i for i in reversed(ids) if i is not None), None)) if i is not None]
            row = [part, sub, 0, total, len(ids), sum(i is not None for i in ids), keyed[0] if keyed else 0, keyed[-1] if keyed else 0]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], list(MANIFEST))

        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            keys, data, at = batch.column("doc_id").to_pylist(), column.buffers()[2], 0
            while at < len(keys):
                # rows up to the one with which the shard is full
                room = edges[at] + (shard_ids - total) * size
                stop = min(int(np.searchsorted(edges, room, side="left")), len(keys))
                stop = max(stop, at + 1)
                ids += keys[at:stop]
                lengths.append(np.diff(edges[at : stop + 1]) // size)
                payload.append(bytes(data[int(edges[at]) : int(edges[stop])]))
                total += int(edges[stop] - edges[at]) // size
                at = stop
                if total >= shard_ids:
                    yield flush()
                    sub, total, ids, lengths, payload = sub + 1, 0, [], [], []
        if ids:
            yield flush()
        ids, lengths, payload = [], [], []
        give_back()

    schema = ", ".join(f"{n} long" for n in MANIFEST)
    written = stash(rows.mapInArrow(run, schema), "written")

    def list_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, kept = 0, []
        for batch in batches:
            m = np.stack([batch.column(n).to_numpy() for n in MANIFEST], 1).copy()
            m[:, 2] = before + np.cumsum(m[:, 3]) - m[:, 3]
            before += int(m[:, 3].sum())
            kept.append(m)
            names = [_name(p, s) for p, s in m[:, :2].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(names), *(pa.array(m[:, i]) for i in (2, 3, 4))], ["name", "before", "n_ids", "n_docs"])
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        _commit(fs, f"{base}/manifest.idx", [m.astype("<i8").tobytes() for m in kept])

    # one task, with 64 bytes for each shard of some 16 million ids
    listed = written.coalesce(1).sortWithinPartitions("part", "sub").mapInArrow(list_shards, "name string, before long, n_ids long, n_docs long")
    files = stash(listed, "manifest")
    drop_stash(written)
    return Shards(folder, files)


def read(spark: SparkSession, shards: Shards) -> DataFrame:
    """One row a document, from the files: every key is looked up through the index; ``shard`` is the files' path."""
    n = shards.files.count()
    files = shards.files.select("name", "before").repartition(max(1, min(n, 100_000)))
    folder = shards.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, before in zip(batch.column("name").to_pylist(), batch.column("before").to_pylist()):
                shard = Shard(fs, f"{base}/{name}").load()
                out: list[tuple] = []
                row = 0
                while row < len(shard.ids):
                    doc_id = None if shard.nulls[row] else int(shard.ids[row])
                    found = shard.rows_of(doc_id)
                    if found.start != row:
                        raise ValueError(f"{name}: the index misses key {doc_id}")
                    for r in found:
                        ids = shard.tokens(r)
                        out.append((doc_id, before + int(shard.offsets[r]), len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    row = found.stop
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array([f"{folder}/{name}"] * len(out))], ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard string")


def encode(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    return read(spark, write(docs, folder or fresh_path(spark, "ids"), tokenizer or tokenizer_path()))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("shard")
