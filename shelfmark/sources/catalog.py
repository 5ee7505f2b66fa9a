"""Catalog files: JSON arrays in, JSON and Parquet out, never over what is being read."""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import fixed_values as V
from shelfmark.session import stash
from shelfmark.sources import json_array

c = F.col

CATALOG = T.StructType(
    [T.StructField(f, T.StringType()) for f in V.STRING_FIELDS] + [T.StructField(f, T.BooleanType()) for f in V.BOOLEAN_FIELDS] + [T.StructField(f, T.ArrayType(T.StringType())) for f in V.ARRAY_FIELDS]
)


def read_catalog(spark: SparkSession, path: str, schema: T.StructType = CATALOG, range_bytes: int = json_array.RANGE_BYTES) -> DataFrame:
    """A JSON array with ``_ord``, the place in the array, read in ranges; anything but JSON fails the read."""
    return json_array.read_array(spark, path, schema, range_bytes)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A landed dataset, or no rows where it is missing or corrupt: the pass that wants it then does nothing.

    A record that is no JSON makes the whole dataset corrupt, so it is parsed here, and what was parsed is stored.
    """
    none = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_ord", T.LongType())]))
    try:
        return stash(read_catalog(spark, path, schema), "optional")
    except (FileNotFoundError, ValueError):
        return none
    except (PySparkException, Py4JJavaError) as e:
        if "MALFORMED_RECORD" in str(e) or "an empty record" in str(e) or "UnicodeDecodeError" in str(e):
            return none
        raise


def worked_on(c=F.col) -> Column:
    """Marks of a row that an earlier run has worked on."""
    some = lambda f: F.coalesce(c(f) != "", F.lit(False))
    return F.coalesce(c("hdbChecked"), F.lit(False)) | some("marketValueComplete") | some("marketValueLoose") | some("pricechartingId") | some("upc")


def choose_source(spark: SparkSession, base: str, output: str, explicit: bool = False) -> str:
    """The earlier output if it holds a row that was worked on, unless the input was named."""
    p = spark._jvm.org.apache.hadoop.fs.Path(output)
    if explicit or not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return base
    return base if read_catalog(spark, output).filter(worked_on()).limit(1).isEmpty() else output


def write_catalog(catalog: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """JSON Lines in the order of ``_ord``, range-partitioned, so that part files follow each other."""
    ordered = catalog.repartitionByRange(F.col("_ord")).sortWithinPartitions("_ord")
    if not dry_run:
        ordered.write.json(path)
    return ordered


def write_json_array(catalog: DataFrame, path: str) -> None:
    """One JSON array in the order of ``_ord`` at a new path, written by all tasks: the folder's files in order are it."""
    json_array.write_text(catalog.select("_ord", F.to_json(F.struct(*(c for c in catalog.columns if c != "_ord"))).alias("value")), path)


def write_vocabulary(vocabulary: DataFrame, path: str, total: int, harvested: str, source: str = V.SHOP_BASE, dims: tuple[str, ...] = V.FACET_DIMS) -> None:
    """A facet vocabulary ``(dim, name, count)`` as one JSON object: source, time, whole total, names of each dimension.

    Names are in order; each is a line of its own until the commit, so no task holds a dimension.
    """
    counts = {r["dim"]: r["n"] for r in vocabulary.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row a dimension
    about = {"source": source, "harvestedAt": harvested, "unfilteredTotal": total, "counts": {d: counts.get(d, 0) for d in dims}}
    first = vocabulary.groupBy("dim").agg(F.min("name").alias("first"))
    key = F.regexp_extract(F.to_json(F.struct("name")), r'(?s)^\{"name":(.*)\}$', 1)
    rows = vocabulary.join(F.broadcast(first), "dim").withColumn("at", F.array_position(F.array(*map(F.lit, dims)), c("dim"))).filter("at > 0")
    known = [d for d in dims if counts.get(d)]
    opening = F.concat(F.when(c("dim") == (known[0] if known else ""), "").otherwise("},"), F.lit('"'), c("dim"), F.lit('":{'))
    value = F.concat(F.when(c("name") == c("first"), opening).otherwise(","), key, F.lit(":"), c("count").cast("string"))
    lines = rows.select(F.struct("at", "name").alias("_ord"), value.alias("value"))
    rest = "".join(f',"{d}":{{}}' for d in dims if not counts.get(d))
    tail = ("}" + rest if known else rest[1:]) + "}}"
    json_array.write_text(lines, path, head=json.dumps(about, separators=(",", ":"))[:-1] + ',"vocabulary":{', between="", tail=tail)


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def commit_text(spark: SparkSession, folder: str, text: str) -> int:
    """Make ``text`` the current one of a folder of numbered pointers; returns its number.

    A pointer is created only where none has its number, so of two writers one takes the next number. A pointer
    without its whole text, of a writer that stopped in between, is passed over. Old pointers stay.
    """
    p, fs = _store(spark, folder)
    fs.mkdirs(p)
    number = max(_numbers(fs, p), default=0) + 1
    while True:
        made = spark._jvm.org.apache.hadoop.fs.Path(p, f"{number:012d}")
        try:
            if fs.getScheme() == "file":  # there only the system's own call is one step
                if not spark._jvm.java.io.File(made.toUri().getPath()).createNewFile():
                    number += 1
                    continue
                out = fs.create(made, True)
            else:
                out = fs.create(made, False)
        except Py4JJavaError as e:
            if "AlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise
            number += 1
            continue
        out.write(bytearray((json.dumps(text) + "\n").encode()))
        out.close()
        return number


def _numbers(fs, p) -> list[int]:
    return [int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()] if fs.exists(p) else []


def latest_text(spark: SparkSession, folder: str) -> str | None:
    """The text of the last whole pointer, or None."""
    p, fs = _store(spark, folder)
    for number in sorted(_numbers(fs, p), reverse=True):
        stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(p, f"{number:012d}"))
        raw = bytes(stream.readAllBytes())
        stream.close()
        if raw.endswith(b"\n"):
            return json.loads(raw)
    return None


def write_versioned(catalog: DataFrame, folder: str) -> str:
    """A new version beside the old ones, which stay as backups, made the current one; returns its path."""
    path = f"{folder.rstrip('/')}/v-{time.time_ns()}-{uuid.uuid4().hex}"
    catalog.write.parquet(path)
    commit_text(catalog.sparkSession, f"{folder.rstrip('/')}/_current", path)
    return path


def read_latest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The version that was made current last, whole; None before the first."""
    path = latest_text(spark, f"{folder.rstrip('/')}/_current")
    return None if path is None else spark.read.parquet(path)


def write_split(judged: DataFrame, kept: str, removed: str, flag: str = "dropped") -> None:
    """Kept rows and a report of removed ones, to new paths."""
    judged.filter(~F.col(flag)).drop(flag).write.json(kept)
    judged.filter(flag).write.json(removed)


def merge_report(pairs: DataFrame, probes: DataFrame, canon: DataFrame, n: int = 500) -> DataFrame:
    """The first merges: number, title, and the title merged into."""
    a = probes.select("_ord", F.col("title").alias("from_title"), F.col("funkoNumber").alias("num"))
    b = canon.select(F.col("_ord").alias("target"), F.col("title").alias("into_title"))
    return pairs.join(a, "_ord").join(b, "target").orderBy("_ord").limit(n).select("num", "from_title", "into_title")


def write_delta(records: DataFrame, folder: str) -> str | None:
    """A timestamped export; nothing is written where there is nothing to export."""
    if records.isEmpty():
        return None
    path = f"{folder.rstrip('/')}/delta-{time.strftime('%Y%m%d-%H%M%S', time.gmtime())}"
    records.write.json(path)
    return path


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """Keys of finished sets, from write_done or a JSON file of them; a missing or unreadable one starts afresh."""
    p, fs = _store(spark, path)
    empty = spark.createDataFrame([], "key string")
    if not fs.exists(p):
        return empty
    if fs.getFileStatus(p).isDirectory():
        text = latest_text(spark, path)
        return empty if text is None else spark.createDataFrame([(k,) for k in json.loads(text)], "key string")
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("key"))
    return raw.filter(F.col("key").isNotNull())


def write_done(done: DataFrame, path: str, key: str = "key") -> None:
    """Keep the keys of finished sets beside the catalog, for read_done; they are few, and each list is a commit of its own."""
    keys = sorted({r[0] for r in done.select(key).distinct().collect() if r[0] is not None})
    commit_text(done.sparkSession, path, json.dumps(keys))


def clear_done(spark: SparkSession, path: str, complete: bool) -> bool:
    """Forget the finished sets once all are; a run that stopped early keeps them, to go on from there."""
    p, fs = _store(spark, path)
    return bool(complete and fs.delete(p, True))
