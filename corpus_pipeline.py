"""From documents to token ids: language, near-duplicates, mixture, encoding.

Each stage works on all rows that its predecessor kept; a run writes a stage's rows as
Parquet to the shared folder and reads them again for the next one, so that a lost executor
costs no more than tasks of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import encode_texts
from strata.llm.dedup import drop_near_duplicates
from strata.llm.langid import fit_language_model, held_out, keep_identified
from strata.llm.mixing import mix_documents
from strata.llm.shipping import ship
from strata.session import working_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: The stages draw on a language model, hashes and counts: no SQL of moderate size gives their rows.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language the network can tell; those without text or letters go."""
    ship(spark)
    return keep_identified(docs, fit_language_model(docs.where(~held_out(docs["doc_id"]))))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of sources takes it."""
    ship(spark)
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each row."""
    ship(spark)
    encoded = encode_texts(docs, TOKENIZER)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_copies),
    ("mixture", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = working_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
