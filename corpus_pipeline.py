"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays,
documents with benchmark passages go, secrets are masked, and what is left is tokenised.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's ``docs``. A null text is kept as it is by the filters and has
no tokens. Columns beyond those of ``documents`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, queries, secret_scan, simhash, toxicity
from millrace.session import scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of documents; a new text brings its own length."""
    docs = docs.select(*COLUMNS)
    if text is None:
        return docs
    changed = docs.select("*", text.alias("new"))
    length = F.when(F.col("new").eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length("new"))
    return changed.select("doc_id", F.col("new").alias("text"), "lang", "source", length.cast("bigint").alias("n_chars"))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled folds, lets pass."""
    model = queries.toxicity_model(spark, sf_dir)
    return _documents(docs).where(toxicity.score(spark, model, F.col("text")) < 0.5)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    return simhash.one_of_each(_documents(docs))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark's windows."""
    items = queries.table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(_documents(docs), items, into="contamination")
    return _documents(found.where(~decontaminate.contaminated(F.col("contamination"))))


def with_secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    found = secret_scan.spans(F.col("text"))
    return _documents(docs, secret_scan.redacted(F.col("text"), found))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, tokens and the digest of the decoded bytes."""
    coder = queries.tokenizer(spark)
    rows = _documents(docs).select("doc_id", "lang", "source", coder.encode(F.col("text")).alias("tokens"))
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        "tokens",
        F.sha2(coder.decode(F.col("tokens")), 256).alias("text_sha256"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmarks),
    ("secret scans", with_secrets_masked),
    ("byte-level BPE", tokenised),
]

#: Kernel machines and tokenizers are beyond SQL; the tests hold a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    # Gone when the driver's JVM ends, results included: write them elsewhere to keep them.
    folder = scratch(spark)
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
