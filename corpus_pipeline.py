"""Documents to training ids: quality, toxicity, near copies, benchmark leaks, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. The
classifiers learn from the table ``documents`` and its labels, so a stage decides alike
whatever came before it. All stages but the last return the columns of ``docs``.

Rows are kept or dropped whole: a text is dropped if its quality score is below 0.5, if its
toxicity score is 0.7 or more, if it is a near copy (five-word runs, similarity 0.8) of a
text with a smaller doc_id, or if it holds a benchmark item. Rows without doc_id are no near
copy of anything. Of near copies that share the least doc_id, the row of least hash over its columns stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.llm import byte_bpe, decontaminate, near_dedup, quality, toxicity
from folioworks.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = quality.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, trees)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, machine)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def fair(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.tokenize(docs, path, ["doc_id"], ["n_tokens", "ids", "ids_sha256", "decoded_sha256"])


STAGES = [("quality", good), ("toxicity", clean), ("near_dedup", single), ("decontamination", fair), ("byte_bpe", encoded)]

#: Trained classifiers decide; SQL can't express them (see tests/llm for the brute-force version).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between stages the rows are written to the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("append").parquet(path)
        docs = spark.read.parquet(path)
    return docs
