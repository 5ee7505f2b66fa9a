"""The training-data pipeline: documents in, token files out.

``run(spark, sf_dir, out)`` leaves the files (``.ids``, ``.idx`` and ``manifest.idx``, see ``token_files``) in the
folder ``out``, which must hold nothing yet; its rows name the file of each document. Without ``out`` they go to a
new folder under the session's shared one.

Cases, for all stages. Columns that ``documents`` lacks pass through the first four, whatever their
names. An empty table gives empty results. Texts are read whole. A null language or source is a value
like any other. Rows that are equal in all columns are told apart by nothing, so any of them may stand
for the others. What a stage wrote on its way is removed once its result is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontam, mixing, quality, simhash, token_files
from shelfmark.llm.common import table
from shelfmark.session import drop_path, fresh_path, scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject (score of at least a half).

    Null and empty texts get the score of no evidence, and go or stay by it. Repeated rows get equal
    scores. A null id has no label and is scored. Without labels nothing is rejected.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.training_rows())
    return quality.score(docs, model, docs.columns, name="_q_score").filter("_q_score >= 0.5").drop("_q_score")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, null ids last, ties by the row's hash.

    Null and empty texts, and all without a word, are one group. Rows repeated in full are one document.
    """
    return simhash.dedup(docs)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark.

    Null and empty texts share none. Rows of equal id and text go or stay together; null ids are ids.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, three times at most.

    Texts without words have size 0 and take part in the ranks. Ties of source and size go by the id's
    hash, the id, the text's hash, so reruns agree. A null source stands last.
    """
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, out: str | None = None) -> DataFrame:
    """What the token files hold, read back by key: one row for each copy of a document, with its file's path.

    Null and empty texts are the end id alone. Null ids come last in the files; ids are whole numbers.
    """
    return token_files.encode(docs, folder=out)


STAGES = [
    ("quality", quality_stage),
    ("near-dedup", dedup_stage),
    ("decontamination", decontam_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: A fitted classifier, XXH64 and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with scratch(spark):
            more = (out,) if stage is token_stage else ()
            stage(spark, docs, sf_dir, *more).write.parquet(path)
        if before:
            drop_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
