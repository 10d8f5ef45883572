"""A training corpus from a table of documents, stage by stage.

Each stage reads what its predecessor kept, as a Parquet table. All but the last return the
columns of documents; the last returns every piece and its place in a sequence.

1. language   documents whose language is not recognised go
2. exact      of equal texts, white space aside, one stays
3. near       of each group of near copies by SimHash one stays
4. mix        sources are repeated or thinned to target weights
5. pack       documents are packed into sequences of 4096 tokens
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from covaria.llm import exact, language, mixing, packing, simhash
from covaria.llm.queries import language_model, tokenizer_file
from covaria.llm.text import documents
from covaria.operators.durable import table_folder


def recognise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.recognised(docs, language_model(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs, words_each=3, max_bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs, mixing.cycled(1, 2, 3), max_epochs=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, tokenizer_file(), most_tokens=4096)


STAGES = [
    ("language", recognise),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("mix", mix),
    ("pack", pack),
]

#: Trained, hashed and seeded stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result written and read again."""
    folder = f"{table_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
