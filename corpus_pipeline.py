"""Documents to training sequences: quality classifier, quality rules, SimHash near-duplicates, suffix-array passages, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is written as Parquet before the next one reads it.
A lost executor costs tasks of one stage. All but the last return the columns of docs, whatever their names.

Null and empty texts: the classifier gives them its prior's score; what it keeps of them fails the base rule. Rows with a null doc_id pass through like
any other, and of a group of near-duplicates without any id one row stays. Repeated rows count once from simhash_dedup on.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import packing, quality, rules, simhash, suffixes
from tidewright.llm.common import materialize, read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score below the threshold; the model learns from the labels of the training folds."""
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rule fails or the weighed rules hold for bad."""
    return rules.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near-duplicates."""
    return simhash.keep_first(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts; n_chars follows the text."""
    left = suffixes.keep_unique(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("passage_dedup", passage_dedup),
    ("packing", packed),
]

#: Trained vectors, components and token ids are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
