"""From raw documents to a deduplicated, mixed and tokenised corpus, in stages that each read what the last one wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.line_dedup import drop_repeated_lines
from shelfsight.llm.mixing import mixed
from shelfsight.llm.piece_codec import coded_documents
from shelfsight.llm.simhash import one_of_each_group
from shelfsight.llm.toxicity import toxic_documents
from shelfsight.session import shared_folder

# The SQL twin would need the toxicity classifier and the tokenizer; the stages are tested one by one instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_documents(docs, labels).where("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` follows the text."""
    cleaned = drop_repeated_lines(docs).drop("n_lines", "n_dropped")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, and one only where ids repeat."""
    return one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of the mix asks for."""
    return mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of each document's tokens and of the text they decode to."""
    return coded_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
