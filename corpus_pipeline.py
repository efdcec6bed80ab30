"""The corpus pipeline: documents through five operators, each stage written and read again.

Stages are computed by whoever writes them, so the session keeps handing over few texts at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solarspark.llm.bpe import encode_digests
from solarspark.llm.common import few_at_once, read, staged
from solarspark.llm.decontaminate import drop_contaminated
from solarspark.llm.partenum import keep_first
from solarspark.llm.queries import tokenizer
from solarspark.llm.secrets import redact_secrets
from solarspark.llm.toxicity import keep_clean

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.

    Null and empty texts score as low as texts can and stay. Repeated rows score alike.
    """
    few_at_once(spark)
    return keep_clean(docs.select(DOCUMENTS), read(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar word n-grams, the smallest id stays.

    Near-duplicate stages take five words and a similarity of 0.8. Null and empty texts and
    rows with a null id all stay; of rows that repeat an id that stays, one does.
    """
    few_at_once(spark)
    return keep_first(docs.select(DOCUMENTS), percent=80, n=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Each row is judged by its text; null and empty ones stay, repeated rows go together.
    """
    few_at_once(spark)
    return drop_contaminated(docs.select(DOCUMENTS), read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay.

    A null text stays null and keeps its n_chars, others are counted anew.
    """
    few_at_once(spark)
    length = F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars"))
    return redact_secrets(docs.select(DOCUMENTS)).withColumn("n_chars", length)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, a row each; a null text counts as empty."""
    few_at_once(spark)
    return encode_digests(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard), ("decontamination", decontamination),
          ("secrets", secrets), ("bpe", bpe)]

#: A trained network, connected components and a tokenizer's merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each one's rows are written before the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
