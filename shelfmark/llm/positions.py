"""Rows by their place in the files they are read from, so that verdicts travel and texts do not.

A stage that drops or repeats rows decides on narrow columns. The decision comes back to the text by
place: counts are written in one folder for each file, and a task that reads a part of a file loads
the counts of that file alone. The text is read once more and never shuffled; what a task holds is
bounded by the rows of one file, whatever the corpus.

Cases. A frame that is no plain read of files (and so has no places) is written once first. Rows that
are equal in full have places of their own. Files without counts keep or lose all their rows. All
columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import give_back, renamed, restored, slices
from shelfmark.session import small_batches, stash, stash_path

FILE, ROW = "_ps_file", "_ps_row"


def placed(docs: DataFrame) -> DataFrame:
    """Add ``_ps_file, _ps_row``: the hash of the file's address and the row's number in it."""
    try:
        place = docs.metadataColumn("_metadata")
        return docs.withColumns({FILE: F.xxhash64(place["file_path"]), ROW: place["row_index"]})
    except AnalysisException:
        written = stash(docs, "placed")
        place = written.metadataColumn("_metadata")
        return written.withColumns({FILE: F.xxhash64(place["file_path"]), ROW: place["row_index"]})


def repeated(docs: DataFrame, counts: DataFrame, others: int) -> DataFrame:
    """Each row of ``docs``, a placed frame, ``n`` times as ``counts(_ps_file, _ps_row, n)`` has it, else ``others`` times."""
    folder = stash_path(docs.sparkSession, "counts")
    counts.select(FILE, ROW, F.col("n").cast("int").alias("n")).repartition(FILE).sortWithinPartitions(FILE, ROW).write.partitionBy(FILE).parquet(folder)
    docs, own = renamed(docs)
    schema = T.StructType([f for f in docs.schema.fields if f.name not in (FILE, ROW)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)

        @lru_cache(2)
        def of_file(key: int) -> tuple[np.ndarray, np.ndarray]:
            found = fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/{FILE}={key}", allow_not_found=True))
            parts = [pq.ParquetFile(fs.open_input_file(f.path)).read([ROW, "n"]) for f in found if f.base_name.endswith(".parquet")]
            if not parts:
                return np.zeros(0, np.int64), np.zeros(0, np.int32)
            rows, n = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in (ROW, "n"))
            order = np.argsort(rows, kind="stable")
            return rows[order], n[order]

        for batch in chain.from_iterable(map(slices, batches)):
            files, rows = batch.column(batch.num_columns - 2).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            n = np.full(len(rows), others, np.int64)
            for key in np.unique(files).tolist():
                here = np.flatnonzero(files == key)
                known, count = of_file(key)
                at = np.searchsorted(known, rows[here])
                met = np.flatnonzero(at < len(known))
                met = met[known[at[met]] == rows[here[met]]]
                n[here[met]] = count[at[met]]
            # one copy at a time, so that no batch grows
            for k in range(int(n.max(initial=0))):
                left = batch.filter(pa.array(n > k))
                if left.num_rows:
                    yield pa.RecordBatch.from_arrays(left.columns[:-2], schema.names)
        give_back()

    small_batches(docs.sparkSession)
    return restored(docs.select(*schema.names, FILE, ROW).mapInArrow(run, schema), own)

