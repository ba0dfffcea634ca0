"""From raw documents to token ids: five stages, each one operator of ``tallyrule.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one
before it kept; all but the last return the columns of ``docs``, extra ones and
such with names that operators use included. An empty table passes every
stage as an empty one, and texts are read whole however long they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrule.llm import decontam, linededup, sentencepiece_fst, simhash, toxicity
from tallyrule.scratch import remove, scratch_path, scratch_scope

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "1000"  # rows in an Arrow batch


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` follows the text where there is such a column."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def _small_batches(spark: SparkSession) -> None:
    """Whole texts are long: fewer of them at once keep Python workers small, stage after stage.

    A stage's frame is lazy, so a caller of a single stage has the setting until
    it changes it; :func:`run` puts the old one back.
    """
    spark.conf.set(BATCH, BATCH_ROWS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as toxic go.

    Null and empty texts are judged by the model's bias alone; equal texts fare
    alike, so repeated rows stay or go together. Null ids and labels teach
    nothing. A score equal to the threshold is toxic.
    """
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, labels)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents repeat go from all but one.

    A null text stays null, an empty one empty; one that loses every line becomes
    empty and stays. Rows that share an id are one document, rows without an id
    another; of the documents with a line the largest id keeps it.
    """
    _small_batches(spark)
    return _with_length(linededup.dedup_lines(docs), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.

    It is the one with the smallest id, null ids last, then by a hash of the row;
    of rows repeated in all columns one stays. Null texts and texts without
    words are near copies of each other.
    """
    _small_batches(spark)
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go, and documents that are nothing else.

    Null and empty texts have no words and stay as they are; null and empty items
    find nothing. Repeated rows are cut alike, repeated items count as one.
    A document at exactly the limit of coverage goes.
    """
    _small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return _with_length(decontam.remove_contamination(docs, items), docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it.

    A null text has no ids and is not exact, an empty one has none and is.
    Repeated rows each get theirs.
    """
    _small_batches(spark)
    model = sentencepiece_fst.load_model(sentencepiece_fst.tokenizer_path())
    return sentencepiece_fst.round_trip(docs, model).select("doc_id", "lang", "source", "ids", "n_ids", "exact")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

# The classifier, the fingerprints and the encoding cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's result written and read again.

    What a stage staged on its way goes when its result is written, and that
    result goes when the next one is; the last one stays, since it is what is
    read. The session's settings are as before afterwards.
    """
    docs, before, rows = spark.read.parquet(f"{sf_dir}/documents.parquet"), None, spark.conf.get(BATCH)
    try:
        for name, stage in STAGES:
            path = scratch_path(spark, name)
            with scratch_scope(spark):
                kept = stage(spark, docs, sf_dir)
                kept.write.parquet(path)
            if before is not None:
                remove(spark, before)
            docs, before = spark.read.schema(kept.schema).parquet(path), path
    finally:
        spark.conf.set(BATCH, rows)
    return docs
