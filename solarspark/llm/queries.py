"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import oracle_sql
from .common import read
from .decontaminate import ORACLE_SQL


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_digests
    return encode_digests(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import edited_fingerprints
    return edited_fingerprints(read(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .partenum import similar_components
    return similar_components(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens
    return count_tokens(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import predict_language
    return predict_language(read(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import find_secrets
    return find_secrets(read(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_text
    return extract_text(read(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations
    return collocations(read(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants
    return spelling_variants(read(spark, sf_dir, "documents"), slip_every=97)


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_bpe, op3_fingerprints, op4_ngram_jaccard, op5_token_counts, op6_language,
    op7_secrets, op8_html_text, op9_toxicity, op10_quality, op11_phrases,
    op12_spelling, op13_minhash)}
ORACLE: dict[str, str] = {
    "op1_decontaminate": ORACLE_SQL, "op4_ngram_jaccard": oracle_sql.similar(3, 90), "op11_phrases": oracle_sql.phrases(),
    "op12_spelling": oracle_sql.spelling(), "op13_minhash": oracle_sql.similar(5, 85, kept=True)}
