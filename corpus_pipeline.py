"""The corpus pipeline over documents: quality rules, near-duplicates, personal data, mixing, tokenisation.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
The texts of a stage's input are those that its predecessor kept or rewrote.

Defined cases, by stage: null, empty and wordless texts fail the quality rules, which judge rows with a null lang or source as
groups of their own; repeated rows are judged each, and one of them stays after the n-gram join, as of any group (the smallest
doc_id's; rows without an id count last); a null doc_id never drops a row by itself; texts of any length are read whole; personal data in a
null text is none; mixing takes a document 0 to 3 times, so rows may repeat again, and drops those that it takes 0 times; the
tokens of an empty text are none. An empty table stays empty at every stage. Columns beyond those of documents pass through all
stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import mixing, ngram_join, pii, quality_rules, sentencepiece_scan
from touchline.llm.base import materialize


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_documents(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by word shingles."""
    return ngram_join.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix_documents(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and piece ids of each document."""
    return sentencepiece_scan.encode_documents(docs, ["doc_id", "lang", "source"]).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality rules", rules_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("personal data", pii_stage),
    ("mixing", mixing_stage),
    ("SentencePiece", tokens_stage),
]
#: Bootstrapping and Viterbi paths are beyond SQL: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
