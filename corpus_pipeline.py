"""From raw documents to packed sequences: five stages, each written as Parquet and read again.

``STAGES`` names them in order; each takes (spark, docs, sf_dir) and all but the last return the columns
of ``documents``. Decisions take effect: a stage sees only what the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import classifier, decontaminate, line_spread, near_copies, packing
from tidemark.llm.common import scratch, table

#: Labels that the classifier learns from; the others are its test fold.
LEARNS = "crc32(cast(doc_id AS string)) % 5 <> 0"
TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"), F.expr(LEARNS))
    return classifier.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without boilerplate lines; ``n_chars`` follows the text."""
    cut = line_spread.strip_boilerplate(docs)
    count = cut.columns[-1]
    changed = F.when(F.col(count) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed).drop(count)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id: five-word shingles, similarity 0.8."""
    return near_copies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids of power-of-two lengths."""
    return packing.decompose(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

#: The classifier's model has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
