"""Quality classifier: how much better a text compresses with a dictionary of good text than of bad.

Method. From a bounded sample of labelled rows two zstandard dictionaries are built, one from good
and one from bad texts. Every text is cut into blocks of ``block`` bytes (the whole text; a block is
short enough that the dictionary, not the text's own past, decides its size), each block is
compressed with either dictionary and with none, and sizes are compared. What goes through a weighted
logistic calibrator, fitted on labelled rows that no dictionary was built from, are differences that
dictionaries make and nothing else: of the summed sizes, and the least and greatest of any block.

Cases. Null and empty texts have no block, and get the score of no evidence: the share of good texts
among the labels. A text of any length is scored whole. Repeated rows get equal scores. No usable labels: a score of 0.5 for all;
one class only: its smoothed rate. Extra columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import fitting
from shelfmark.llm.common import as_bytes, crc_mod, named, per_batch, table

#: Bounds of the fit; they do not grow with the corpus.
PER_CLASS = 1500
MAX_CHARS = 60_000
DICTIONARY_BYTES = 96 * 1024
BLOCK = 256
N_FEATURES = 7


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    block: int = BLOCK
    calibrator: dict[str, list[float]] = field(default_factory=dict)
    prior: float = 0.5

    def coders(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for data in (self.good, self.bad, b""):
            plain = {"level": 3, "write_content_size": False, "write_dict_id": False}
            if len(data) >= 8:
                kind = zstandard.DICT_TYPE_FULLDICT if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
                made.append(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind), **plain))
            else:
                made.append(zstandard.ZstdCompressor(**plain))
        return made

    def features(self, text: bytes | None, coders: list[zstandard.ZstdCompressor]) -> list[float]:
        """Bad less good, plain less good, plain less bad, over the text; the first and second by block: least and greatest."""
        n = len(text or b"")
        if not n:
            return [0.0] * N_FEATURES
        sizes = [[len(c.compress(text[i : i + self.block])) - 2 for i in range(0, n, self.block)] for c in coders]
        good, bad, plain = map(sum, sizes)
        by_block = [(b - g) / (b + g) for g, b, _ in zip(*sizes)]
        saved = [(p - g) / p for g, _, p in zip(*sizes)]
        return [(bad - good) / (bad + good), (plain - good) / n, (plain - bad) / n, min(by_block), max(by_block), min(saved), max(saved)]

    def score(self, texts: list[bytes | None], coders: list[zstandard.ZstdCompressor]) -> np.ndarray:
        x = np.array([self.features(t, coders) for t in texts]).reshape(-1, N_FEATURES)
        return np.where([bool(t) for t in texts], fitting.probability(self.calibrator, x), self.prior)


def _dictionary(texts: list[bytes], size: int, block: int) -> bytes:
    pieces = [t[i : i + block] for t in texts for i in range(0, len(t), block)]
    pieces = [p for p in pieces if len(p) >= 16]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too little or too uniform to train on: its raw text serves
        return b"".join(pieces)[:size]


def fit(sample: list[tuple[bytes, int]], totals: dict[int, int], dictionary_bytes: int = DICTIONARY_BYTES, block: int = BLOCK) -> CompressionModel:
    """Odd rows of the sample build the dictionaries, even ones fit the calibrator."""
    halves = sample[1::2], sample[::2]
    model = CompressionModel(*(_dictionary([t for t, y in halves[0] if y == want], dictionary_bytes, block) for want in (1, 0)), block=block)
    coders = model.coders()
    x = np.array([model.features(t, coders) for t, _ in halves[1]]).reshape(-1, N_FEATURES)
    y = np.array([y for _, y in halves[1]], dtype=float)
    weight = np.array([totals.get(int(v), 1) / max(1, (y == v).sum()) for v in y])
    model.calibrator = fitting.logistic(x, y, weight * len(y) / max(weight.sum(), 1e-9))
    model.prior = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> CompressionModel:
    return fit(*fitting.labelled_sample(docs, labels, "quality", usable, per_class, MAX_CHARS))


def score(docs: DataFrame, model: CompressionModel, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """Add ``name`` (higher: better) to every row; the columns ``keep`` pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a fixed size

    def make():
        model = sent.value
        coders = model.coders()

        def run(batch: pa.RecordBatch) -> dict[str, list]:
            return {name: model.score(as_bytes(batch.column(text)), coders).tolist()}

        return run

    return per_batch(docs.select(*map(named, dict.fromkeys([*keep, text]))), make, f"{name} double", keep)


def training_rows() -> Column:
    """The rows whose labels may be learned."""
    return crc_mod(F.col("doc_id"), 3) != 1


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), training_rows())
    scored = score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
