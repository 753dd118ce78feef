"""Corpus pipeline: quality rules, quality classifier, near duplicates, repeated passages, packing.

Each stage takes what the stage before it kept and returns the columns of documents; the last returns pieces of
sequences. Stages are written as Parquet to the shared folder between each other, so a lost executor costs no earlier stage.

Cases: a null or empty text fails the base rules and goes in the first stage. Null identifiers are identifiers like any
other, before all others. Repeated rows: the rules and the classifier judge each alike, the near-duplicate stage keeps one
of them; rows of one identifier with other texts are told apart. Extra columns of the input are dropped. An empty table
gives an empty table after each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm import ngram_join, packing, pu_quality, quality_rules, substring_dedup
from strataframe.llm.common import new_folder, table
from strataframe.llm.queries import WORD_BPE

#: The columns of documents.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voted rules keep."""
    return quality_rules.judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these documents and the labels, takes for good."""
    picked = docs.select(*COLUMNS)
    model, _ = pu_quality.train(picked, table(spark, sf_dir, "labels"))
    return pu_quality.score(picked, model, keep=COLUMNS).where(F.col("score") >= pu_quality.THRESHOLD).select(*COLUMNS)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group that links of 80 % common shingles connect; rows without words stay, equal rows become one."""
    return ngram_join.firsts(docs.select(*COLUMNS)).select(*COLUMNS)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; those that nothing remains of go."""
    left = substring_dedup.dedup(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))
    return left.where((F.size("removed_spans") == 0) | F.col("text").rlike("\\S")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, WORD_BPE, end_id=1, with_ids=False)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("passages", passages_stage),
    ("packing", packing_stage),
]

#: Learned weights, connected components and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
