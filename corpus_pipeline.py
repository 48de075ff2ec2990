"""From raw documents to token ids: five stages, each one operator, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontaminate, minhash, pii, toxicity
from millrace.llm.common import stash, table
from millrace.llm.queries import tokenizer
from millrace.session import tune

#: Similarity, in percent, from which the pipeline takes documents for near duplicates.
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from those of the labelled rows that are here."""
    return toxicity.without_toxic(docs, table(tune(spark), sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    tune(spark)
    return minhash.one_of_each(docs, percent=NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.without_benchmark(docs, table(tune(spark), sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    tune(spark)
    return pii.mask_pii(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and whether they decode to the text."""
    tune(spark)
    return bpe.round_trip(docs.select("doc_id", "text", "lang", "source", "n_chars"), tokenizer()).drop("text")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", mask_personal),
    ("byte_bpe", tokenize),
]

#: No SQL form: trained scores, signatures and merges. Tested against plain versions of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of documents that pass all stages: doc_id, lang, source, n_chars, n_tokens, ids, same."""
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
