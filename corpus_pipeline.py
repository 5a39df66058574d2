"""Corpus pipeline over ``documents``: five stages, each written as Parquet and reread as the next one's input.

1. ``language`` drops documents whose language can't be told: null texts and texts without a letter; if no language was
   learned, these alone.
2. ``exact_dedup`` keeps one row of each text that is equal after lower-casing A-Z, that with the largest id.
3. ``simhash_dedup`` keeps one row of each component of near-duplicates, that with the smallest id.
4. ``mix`` repeats or drops documents so that the sources' words come near their target weights.
5. ``pack`` tokenises what is left and packs it into sequences of 1024 tokens; its rows are the pieces with their places.

Stages 1 to 4 return the columns of their input.  Repeated rows count as rows of their own in every stage, nulls and empty
tables go through, and no stage looks at other columns than doc_id, text, lang (of training rows only) and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.llm import exact, langid, mixing, packing, simhash
from changeledger.llm.common import fresh, stored, table
from changeledger.llm.tokens import vocabulary_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, training = fresh(docs, "found"), langid.sample(docs)
    if not training:  # every text would count as unknown
        return docs.where(langid.lettered()(F.col("text").cast("string")))
    predict = langid.prediction(training)
    return docs.withColumn(found, predict(F.col("text").cast("string"))).where(F.col(f"{found}.lang_pred") != langid.UNKNOWN).drop(found)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicated(docs, keep="last")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs, shingle=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, vocabulary_path("byte_bpe_50k.json"), 2, 1024), 1024)


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("simhash_dedup", simhash_dedup), ("mix", mix), ("pack", pack)]

#: The first stage's model can't be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
