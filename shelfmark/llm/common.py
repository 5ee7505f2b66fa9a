"""Word rules and small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import small_batches

#: Words between blanks: maximal runs of anything but U+0020 and U+0009..U+000D. ``bytes.split()`` uses the same six characters.
BLANK_WORD = r"[^\x20\x09-\x0D]+"

#: ASCII to lower case, with all ASCII characters but letters and digits turned to blanks; other bytes stay.
ALNUM_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Bytes of text that are worked on at a time, where that is done by whole columns.
SLICE_BYTES = 4_000_000
#: A-Z to lower case and nothing else.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def blank_words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def alnum_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ALNUM_LOWER).split()


def alnum_lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``alnum_words`` of all rows in one array, and how many each row has."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    low = bytes(column.buffers()[2] or b"")[edges[0] : edges[-1]].translate(ALNUM_LOWER) if len(column) else b""
    texts = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer((edges - edges[0]).astype(np.int64)), pa.py_buffer(low))
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    words = lists.flatten()
    if len(empty := np.flatnonzero(pc.binary_length(pc.ascii_trim_whitespace(texts)).to_numpy() == 0)):
        words = words.filter(pc.not_equal(words, ""))  # a text without words is split to one empty word
        counts[empty] = 0
    return words, counts


@cache
def _libc() -> ctypes.CDLL | None:
    """The C library of a worker, told to hand large blocks back at once; Arrow draws on it too.

    Workers live on and share their executor's memory, so what allocators keep for later adds up.
    """
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD, and no longer growing with what is freed
        libc.mallopt(-1, 16 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library, which has its own ways
        return None
    pa.set_memory_pool(pa.system_memory_pool())
    return libc


def give_back() -> None:
    """At the end of a task: return what the allocators keep."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices whose texts have about ``size`` bytes, or one longer text."""
    _libc()
    length = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff((np.cumsum(length) - length) // size)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def named(name: str) -> Column:
    """A column by its whole name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with plain names for columns whose names ``mapInArrow`` takes for paths, and their own by these."""
    own = {f"_col{i}": n for i, n in enumerate(df.columns) if "." in n or "`" in n}
    by = {n: k for k, n in own.items()}
    return df.toDF(*(by.get(n, n) for n in df.columns)), own


def restored(df: DataFrame, own: dict[str, str]) -> DataFrame:
    return df.toDF(*(own.get(n, n) for n in df.columns))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without building Python strings."""
    return column.cast(pa.binary()).to_pylist()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: Column, k: int) -> Column:
    return F.crc32(column.cast("string").cast("binary")) % k


def per_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]], schema: str, keep: list[str]) -> DataFrame:
    """Run a function on each Arrow batch: columns ``keep`` pass through, those it returns follow.

    ``make`` runs once a task, so that models are built there and not for each batch.
    """
    small_batches(df.sparkSession)
    df, own = renamed(df)
    by = {n: k for k, n in own.items()}
    keep = [by.get(k, k) for k in keep]
    names = [f.split()[0] for f in schema.split(",")]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    full = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), *([schema] if schema else [])])
    arrow = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    types = [arrow[f.split()[1]] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            fn = fn or make()
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                got = fn(part)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *(pa.array(got[n], t) for n, t in zip(names, types))], [*keep, *names])
        give_back()

    return restored(df.mapInArrow(run, full), own)
