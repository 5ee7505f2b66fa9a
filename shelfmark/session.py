"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch that has whole texts.
BATCH_ROWS = 1000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

_own_dir: list[str] = []
_scratch: list[list[str]] = []


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and all runs in one process (tests) a temporary folder is made;
    elsewhere executors would each write to a folder of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="shelfmark-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return "file://" + _own_dir[0]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/shelfmark/{label}-{uuid.uuid4().hex}"


def stash_path(spark: SparkSession, label: str) -> str:
    """A path for files that go when the ``scratch`` around it ends."""
    path = fresh_path(spark, label)
    for made in _scratch:
        made.append(path)
    return path


def stash(df: DataFrame, label: str = "stash") -> DataFrame:
    """Write once to the shared folder and read back.

    This cuts the lineage, so that a lost executor costs no recomputation of what lies above, and
    unlike ``checkpoint()`` it runs the plan once rather than twice. The files go when the ``scratch``
    around it ends, or by ``drop_stash``.
    """
    spark = df.sparkSession
    path = stash_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Have the session send Arrow batches of at most ``rows`` rows to Python and back.

    Spark's default suits narrow rows. Rows with whole texts fill buffers on both sides of the pipe that
    the JVM's and the worker's allocators then keep. A smaller number that the session has stays.
    """
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= rows:
        spark.conf.set(BATCH_KEY, str(rows))


def drop_path(spark: SparkSession, path: str) -> None:
    if "/shelfmark/" not in path:
        raise ValueError(f"not a stash: {path}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what was stashed inside, once the result has been written elsewhere.

    A frame that comes out of the block may read stashes: write it inside.
    """
    made: list[str] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.pop()
        for path in made:
            drop_path(spark, path)


def drop_stash(df: DataFrame) -> None:
    """Remove the files behind a stashed frame once nothing reads them any more."""
    if files := df.inputFiles():
        drop_path(df.sparkSession, files[0].rpartition("/")[0])
