"""The registered queries of this subpackage: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Text rows in one Arrow batch, and its bytes: very long documents must not add up.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def bound_batches(spark: SparkSession) -> None:
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lattice_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lattice import near_duplicate_vectors

    return near_duplicate_vectors(spark, table(spark, sf_dir, "embeddings"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .tokens import token_output

    return token_output(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hostpaths import page_report

    return page_report(spark, table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_report

    return language_report(spark, table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_report

    return toxicity_report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sigtree import jaccard_components

    return jaccard_components(spark, table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_report

    return quality_report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import language_model_scores

    return language_model_scores(spark, table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixing_report

    return mixing_report(spark, table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination_report

    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpetree import token_digests

    return token_digests(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .negatives import negatives_report

    return negatives_report(spark, table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical import ranked_documents

    return ranked_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    from . import mixing, oracles

    return {"op1_lattice_neardup": oracles.NEAR_VECTORS, "op6_jaccard_join": oracles.JACCARD, "op9_source_mixing": mixing.mixing_sql(), "op10_decontamination": oracles.DECONTAMINATION, "op12_hard_negatives": oracles.NEGATIVES, "op13_lexical_search": oracles.LEXICAL}
