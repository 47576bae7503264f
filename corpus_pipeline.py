"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, documents, folder of the tables) and returns a DataFrame;
all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statement_lake.llm import language, mixture, near_duplicates, packing, secret_scan
from statement_lake.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Predictions below this probability count as undecided.
SURE = 0.5
#: Bytes of words that a worker remembers when packing: all stages share the executors' memory.
REMEMBERED = 32 << 20


def identify_language(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that the model knows; the predicted language is their lang.

    Texts that are null, have no letter or are undecided go.  Rows with equal
    doc_ids are told apart by their text.
    """
    told = language.predict_rows(documents, ~language.held_out())
    kept = told.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= SURE))
    lang = F.col("lang_pred").cast(documents.schema["lang"].dataType)
    return kept.select(
        *[lang.alias(c) if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in documents.columns]
    )


def drop_near_duplicates(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.one_of_each(documents)


def mask_secrets(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return secret_scan.mask_secrets(documents)


def mix_sources(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Documents by target weights, each taken once at most."""
    return mixture.mixed_documents(documents, epochs=1)


def pack(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    return packing.best_fit(documents, public_tokenizers.path(packing.TOKENIZER), remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixture", mix_sources),
    ("best_fit_packing", pack),
]

#: Trained models, SimHash and tokenizers are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between stages a written table."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        documents = settle(stage(spark, documents, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, documents, sf_dir)
