"""A corpus from documents to packed sequences, in stages that each call one operator of skein.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skein.llm import decontamination, language_id, packing, simhash, toxicity
from skein.llm.common import packed_rows, written


#: Rows that a stage sends to a Python worker at a time. Texts are long, and workers keep the memory
#: that their largest batch took.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


# In all stages repeated rows are rows of their own unless a stage says otherwise, an empty table gives
# no rows, columns whose names an operator also uses are kept as they are, and texts are read whole.


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language is undetermined or too close to call: null and empty texts,
    and texts without letters, go. Null labels and ids are no obstacle."""
    _small_batches(spark)
    model = language_id.fit(docs, ~language_id.held_out())
    return language_id.classify(packed_rows(docs, "text"), model).where("accepted").select("row_.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents predicted to be toxic. Null and empty texts have no toxic word and stay, unless
    the model says otherwise of words like no other; without labels of both kinds all stay."""
    _small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~toxicity.held_out())
    return toxicity.score(packed_rows(docs, "text"), model).where("predicted = 0").select("row_.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id: so of repeated
    rows one stays, and one of all texts without words, null ones included. A group none of whose
    rows has a doc_id keeps the row with the smallest text."""
    _small_batches(spark)
    return simhash.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold too much of the benchmark. Null and empty texts hold nothing and
    stay, as all do where the benchmark is empty."""
    _small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.scan(packed_rows(docs, "text"), items).where("not contaminated").select("row_.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences. A null or empty text is a piece of one
    token; a null doc_id stays null."""
    _small_batches(spark)
    # Workers still hold what other stages left them, so fewer words are remembered here.
    return packing.pack(docs, packing.word_vocabulary(), kept_pieces=300_000)


STAGES = [("language_id", language), ("toxicity", toxic), ("simhash", near_duplicates), ("decontamination", benchmark), ("packing", packed)]

#: Compression, kernels, hashing and tokenizers are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
