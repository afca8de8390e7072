"""A training corpus from ``documents``: five stages, each written as Parquet and reread.

Each stage function takes (spark, docs, sf_dir); all but the last return the
columns of ``docs``. Rows that a stage drops are gone for the later ones.

Defined cases: an empty table passes through all stages; null and empty texts are
of no language and go first; a null lang is never learned from; a row of a null id
belongs to no group of near-duplicates, and all such rows are drawn alike when
sources are mixed; repeated rows of one id are one document after the join; texts
of any length are read whole; further columns pass through up to the last stage,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docengine.llm import decontam, langid, mixing, sigtree, tokens
from docengine.llm.queries import bound_batches, table
from docengine.llm.shared import fresh, materialize

#: Share of letters that a document's language must have; less is no language.
LEAST_LANGUAGE_SHARE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told; texts without letters, or of no main language, go."""
    bound_batches(spark)
    model = langid.train_language_model(docs)
    out = fresh(docs, "told")
    told = langid.identify(spark, docs, model, out=out)
    return told.where((told[out]["lang_pred"] != langid.UNKNOWN) & (told[out]["score"] >= LEAST_LANGUAGE_SHARE)).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of every group of near-duplicates the document of the least id, once."""
    bound_batches(spark)
    return sigtree.keep_one(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more is benchmark text."""
    out = fresh(docs, "found")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), out=out)
    return found.where(~found[out]["contaminated"]).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents by probabilities raked to source, language and topic targets."""
    return mixing.sample_documents(spark, docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files and return their digest by document."""
    import public_tokenizers

    bound_batches(spark)
    return tokens.token_output(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: A trained language model and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), name)
    return docs
