"""One JSON array read by many tasks, and one JSON text written by many.

Reading. Bytes are cut into ranges. A first pass over them finds, for each state that a range may begin in
(outside a string, inside, inside behind a backslash), the state it ends in, how the nesting changes, and
how many commas stand at each depth. These few numbers a range, one after the other, tell where in the
array each range begins: its state, its depth, and the number of records before it. The data source then
reads ranges on their own: a task takes the records that begin in its range, and the last of them to its
end. A file, or a folder whose files in order of name are one text, is read alike.

Writing. Tasks write the records of their partition to files of a new folder beside the target; the commit
puts in what stands before, between and after them, and gives the folder its name. A task that fails or
runs twice leaves nothing: only files that the commit was told of stay.

Cases. An empty array has no records. Text that is no one array fails in the first pass, a bad record when
it is parsed. Records of any length are read whole. White space around records is left out.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

RANGE_BYTES = 32_000_000
CHUNK = 1_000_000
SPACE = b" \t\r\n"
#: States in which a range may begin: inside a string, behind a backslash in it.
STATES = ((False, False), (True, False), (True, True))


def _is(data: np.ndarray, chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table[data]


def scan(data: np.ndarray, inside: bool, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool, bool]:
    """Structural bytes outside strings: their places, and the change of depth with each; and the state at the end."""
    n = len(data)
    slash = data == 92
    at = np.arange(n)
    last = np.maximum.accumulate(np.where(slash, -1, at))  # the last byte that is no backslash, -1: none
    run = at - last  # backslashes up to here
    if escaped and n:  # the backslash before the range counts for the first run
        run = np.where(last < 0, run + 1, run)
    odd = run & 1
    before = np.append(1 if escaped else 0, odd[:-1]) if n else odd
    quote = (data == 34) & (before == 0)
    within = (np.cumsum(quote) + inside) & 1  # after this byte
    free = (within == 0) & ~quote
    places = np.flatnonzero(free & _is(data, b"[]{},"))
    kind = data[places]
    step = _is(kind, b"[{").astype(np.int64) - _is(kind, b"]}").astype(np.int64)
    still = bool(within[-1]) if n else inside
    return places, step, still, bool(still and odd[-1]) if n else escaped


def files_of(path: str) -> tuple[pyarrow.fs.FileSystem, list[tuple[str, int]]]:
    """A file, or a folder's files in order of name, with their sizes."""
    fs, base = pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path)
    info = fs.get_file_info(base)
    if info.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else [f for f in fs.get_file_info(pyarrow.fs.FileSelector(base)) if f.is_file and not f.base_name.startswith(("_", "."))]
    return fs, [(f.path, f.size) for f in sorted(found, key=lambda f: f.path)]


def _bytes(fs: pyarrow.fs.FileSystem, files: list[tuple[str, int]], start: int, stop: int) -> Iterator[bytes]:
    """The text between two places, piece by piece, over the ends of files."""
    at = 0
    for path, size in files:
        a, b = max(start - at, 0), min(stop - at, size)
        if a < b:
            with fs.open_input_file(path) as f:
                f.seek(a)
                while a < b:
                    data = f.read(min(CHUNK, b - a))
                    a += len(data)
                    yield data
        at += size


@dataclass(frozen=True)
class Range(InputPartition):
    """A range and the place in the array where it begins; ``records`` counts the commas between records before it."""

    start: int
    stop: int
    inside: bool
    escaped: bool
    depth: int
    records: int


_SUMMARY = "start long, stop long, state int, inside boolean, escaped boolean, step long, least long, commas map<bigint,bigint>, ends map<bigint,bigint>, first string, last string"


def plan(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> list[Range]:
    """Where each range begins; fails where the text is not one array. The driver gets a few numbers a range."""
    size = sum(n for _, n in files_of(path)[1])
    starts = spark.range(0, size, range_bytes, numPartitions=max(1, -(-size // range_bytes))).withColumnRenamed("id", "start")
    names = [c.split()[0] for c in _SUMMARY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, files = files_of(path)
        for batch in batches:
            rows = []
            for start in batch.column("start").to_pylist():
                stop = min(start + range_bytes, size)
                for k, (inside, escaped) in enumerate(STATES):
                    depth, least, commas, ends = 0, 0, Counter(), Counter()
                    first = last = None
                    for data in _bytes(fs, files, start, stop):
                        raw = np.frombuffer(data, np.uint8)
                        places, step, inside, escaped = scan(raw, inside, escaped)
                        deep = depth + np.cumsum(step)
                        for found, at in ((commas, deep[raw[places] == 44]), (ends, deep[step < 0])):
                            found.update(dict(zip(*(x.tolist() for x in np.unique(at, return_counts=True)))))
                        if len(deep):
                            least, depth = min(least, int(deep.min())), int(deep[-1])
                        if bare := data.strip(SPACE):
                            first = first or bare[:1].decode("latin1")
                            last = bare[-1:].decode("latin1")
                    rows.append((start, stop, k, inside, escaped, depth, least, list(commas.items()), list(ends.items()), first, last))
            tally = pa.map_(pa.int64(), pa.int64())
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), tally, tally, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    found = {(r["start"], r["state"]): r for r in starts.mapInArrow(run, _SUMMARY).collect()}
    out, state, depth, records, ends, first, last = [], (False, False), 0, 0, 0, None, None
    for start in range(0, size, range_bytes):
        r = found[(start, STATES.index(state))]
        out.append(Range(start, r["stop"], *state, depth, records))
        records += r["commas"].get(1 - depth, 0)
        ends += r["ends"].get(-depth, 0)
        if depth + r["least"] < 0:
            raise ValueError(f"not one JSON array: {path}")
        depth, state = depth + r["step"], (r["inside"], r["escaped"])
        first, last = first or r["first"], r["last"] or last
    if depth or state[0] or ends != 1 or (first, last) != ("[", "]"):
        raise ValueError(f"not one JSON array: {path}")
    return out


def records_of(fs: pyarrow.fs.FileSystem, files: list[tuple[str, int]], r: Range) -> Iterator[tuple[int, bytes, bool]]:
    """Number and text of the records that begin in a range, and whether the array ends behind it."""
    size = sum(n for _, n in files)
    inside, escaped, depth, number, at = r.inside, r.escaped, r.depth, r.records, r.start
    held: list[bytes] | None = None  # the record that is being read
    for data in _bytes(fs, files, r.start, size):
        raw = np.frombuffer(data, np.uint8)
        places, step, inside, escaped = scan(raw, inside, escaped)
        deep = depth + np.cumsum(step)
        kind = raw[places]
        edge = np.flatnonzero(((kind == 44) & (deep == 1)) | ((step == 1) & (deep == 1)) | ((step == -1) & (deep == 0)))
        depth = int(deep[-1]) if len(deep) else depth
        done = 0
        for i in edge.tolist():
            place = int(places[i])
            if held is not None:
                yield number, b"".join([*held, data[done:place]]).strip(SPACE), bool(kind[i] != 44)
                held = None
            if at + place >= r.stop or kind[i] in b"]}":
                return
            if kind[i] == 44:
                number += 1
            held, done = [], place + 1
        if held is not None:
            held.append(data[done:])
        at += len(data)
        if held is None and at >= r.stop:
            return


class JsonArraySource(DataSource):
    """``spark.read.format("json_array")``: ``_ord long, value string``, by ranges that ``plan`` found."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return "_ord long, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return JsonArrayReader(self.options["path"], [Range(*r) for r in json.loads(self.options["ranges"])])

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return JsonTextWriter(self.options["path"], *(self.options.get(k, d) for k, d in (("head", "["), ("between", ","), ("tail", "]"))))


class JsonArrayReader(DataSourceReader):
    def __init__(self, path: str, ranges: list[Range]):
        self.path, self.ranges = path, ranges

    def partitions(self) -> list[Range]:
        return self.ranges or [Range(0, 0, False, False, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, files = files_of(self.path)
        rows, size = [], 0
        for number, value, final in records_of(fs, files, partition):
            if value:
                rows.append((number, value))
                size += len(value)
            elif number or not final:  # nothing at all between the brackets is no record
                raise ValueError(f"an empty record, number {number}: {self.path}")
            if size > CHUNK or len(rows) >= 10_000:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.int64()), pa.array([v.decode() for _, v in rows], pa.string())], ["_ord", "value"])


@dataclass
class Written(WriterCommitMessage):
    part: int
    file: str


class JsonTextWriter(DataSourceArrowWriter):
    """Values of each partition to a file of their own; the commit makes one text of them."""

    def __init__(self, path: str, head: str, between: str, tail: str):
        self.path, self.head, self.between, self.tail = path.rstrip("/"), head, between, tail
        self.made = f"{self.path}.{uuid.uuid4().hex}.tmp"

    def _fs(self, path: str) -> tuple[pyarrow.fs.FileSystem, str]:
        return pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, base = self._fs(self.made)
        fs.create_dir(base)
        file, some = f"{part:09d}-{uuid.uuid4().hex}", False
        with fs.open_output_stream(f"{base}/{file}") as f:
            for batch in iterator:
                for value in batch.column("value").to_pylist():
                    f.write(((self.between if some else "") + value).encode())
                    some = True
        return Written(part, file if some else "")

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = self._fs(self.made)
        fs.create_dir(base)
        done = sorted((m for m in messages if m and m.file), key=lambda m: m.part)
        kept = {m.file for m in done}
        for f in fs.get_file_info(pyarrow.fs.FileSelector(base)):
            if f.base_name not in kept:  # of tries that the commit was not told of
                fs.delete_file(f.path)
        for i, m in enumerate(done):
            fs.move(f"{base}/{m.file}", f"{base}/part-{2 * i + 1:09d}")
        for i, text in [(0, self.head), *((2 * i, self.between) for i in range(1, len(done))), (2 * max(1, len(done)), self.tail)]:
            with fs.open_output_stream(f"{base}/part-{i:09d}") as f:
                f.write(text.encode())
        target = self._fs(self.path)[1]
        if fs.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
            raise FileExistsError(self.path)
        fs.move(base, target)

    def abort(self, messages: list[Written | None]) -> None:
        fs, base = self._fs(self.made)
        if fs.get_file_info(base).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(base)


def read_array(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of one array with ``_ord``, their place in it; a text that is no array, or a bad record, fails."""
    spark.dataSource.register(JsonArraySource)
    ranges = [[r.start, r.stop, r.inside, r.escaped, r.depth, r.records] for r in plan(spark, path, range_bytes)]
    rows = spark.read.format("json_array").option("ranges", json.dumps(ranges)).load(path)
    return rows.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"), "_ord").select("r.*", "_ord")


def write_text(lines: DataFrame, path: str, head: str = "[", between: str = ",", tail: str = "]") -> None:
    """``lines(_ord, value)`` in order as one text at a new path: a folder whose files in order of name are it."""
    spark = lines.sparkSession
    spark.dataSource.register(JsonArraySource)
    ordered = lines.repartitionByRange("_ord").sortWithinPartitions("_ord").select("_ord", "value")
    ordered.write.format("json_array").mode("append").options(head=head, between=between, tail=tail).save(path)
