"""Clean a corpus and turn it into training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again
as the next one's ``docs``. All but the last keep the columns of documents, and only drop rows or
change texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, ngram_join, quality_rules, secret_scan, sentencepiece_topk
from quayside.llm.exprs import fresh, numbered
from quayside.llm.queries import TOKENIZERS, table
from quayside.session import durable


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    name = fresh(docs, "quality")
    judged = quality_rules.apply_rules(docs, out=name)
    return judged.where(F.col(f"{name}.kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row stays: that with the least id, and of equal ids the first one read.

    Rows are told apart by a number of their own, so neither repeated nor missing ids blur a decision;
    a row without an id stays only where no row of its group has one. Documents without words are
    linked with nothing and stay.
    """
    row = fresh(docs, "row")
    rows = numbered(docs, row)
    labels = ngram_join.similar_components(rows, doc_id=row)
    named = rows.select(row, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row")).alias("order"))
    first = labels.select(row, "component_id").join(named, row).groupBy("component_id").agg(F.min("order").alias("first"))
    return rows.join(first.select(F.col("first.row").alias(row)), row, "left_semi").select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, whether they have an id or not."""
    row = fresh(docs, "row")
    rows = numbered(docs, row)
    leaks = decontaminate.find_leaks(rows, table(spark, sf_dir, "benchmark"), doc_id=row)
    return decontaminate.without_leaks(rows, leaks, doc_id=row).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; ``n_chars`` follows the text."""
    name = fresh(docs, "findings")
    found, _ = secret_scan.scan_versions(docs, secret_scan.empty_ledger(spark), out=name)
    text = secret_scan.redact(F.col("text"), F.col(name))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every text as id lists, with their scores."""
    drawn = sentencepiece_topk.sample_segmentations(
        docs, f"{TOKENIZERS}/piece_bpe_32k.model", k=2, alpha=1.0, seed=17, keep=["doc_id", "lang", "source", "n_chars"]
    )
    return drawn


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("secret_scan", secrets),
    ("sentencepiece", segmentations),
]

#: The sampled segmentations cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs
