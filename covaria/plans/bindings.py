"""The roles an analysis needs, bound to the star-schema test tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covaria.operators.features import FeatureTable
from covaria.sources.catalog import FeatureCatalog

LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
DIRTY_FEATURES = (*LINE_FEATURES, "d_const", "d_gaps", "d_inf", "d_empty")
BAND_FEATURES = ("l_quantity", "l_extendedprice")
TEXT_FEATURES = ("n_chars", "n_spaces", "n_digits", "n_capitals", "n_marks")
ENTITY_FEATURES = ("customer_balance", "supplier_balance")

DIGITS = "0123456789"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = ".,;:!?"

LINE_CATALOG = FeatureCatalog.of(
    "lines",
    {
        "size": ["l_quantity", "l_extendedprice"],
        "rates": ["l_discount", "l_tax", "l_surcharge"],
        "mixed": ["l_extendedprice", "l_tax"],
    },
    defaults=["l_quantity", "l_tax"],
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, label: str | None = None) -> FeatureTable:
    return FeatureTable.of(table(spark, sf_dir, "lineitem"), LINE_FEATURES, label)


def dirty_lines(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """Line features plus a constant, one with gaps, one with infinities, an empty one."""
    number = F.col("l_linenumber")
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    df = table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS,
        *LINE_FEATURES,
        F.lit(7.0).alias("d_const"),
        F.when(number == 1, F.lit(None)).when(number == 2, nan).otherwise(F.col("l_quantity")).alias("d_gaps"),
        F.when(number == 3, inf).when(number == 4, -inf).otherwise(F.col("l_tax")).alias("d_inf"),
        F.lit(None).cast("double").alias("d_empty"),
    )
    return FeatureTable.of(df, DIRTY_FEATURES)


def price_band() -> Column:
    price = F.col("l_extendedprice")
    return F.when(price < 35000, "low").when(price < 70000, "mid").otherwise("high")


def banded_lines(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """Three price bands to be told apart by quantity and price."""
    df = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *BAND_FEATURES, price_band().alias("band"))
    return FeatureTable.of(df, BAND_FEATURES, "band")


# Bytes of text looked at together: what counting holds beyond a batch is a small multiple.
COUNTED_BYTES = 1 << 18


def _character_counts(batches):
    """Counts over the UTF-8 bytes of each text; ASCII bytes stand for themselves there.

    Bytes are taken piece by piece, across texts and inside long ones alike.
    """
    # Continuation bytes are kind 5; every other byte starts a character.
    kind = np.zeros(256, np.uint8)
    for k, characters in enumerate((" ", DIGITS, CAPITALS, MARKS), start=1):
        kind[list(characters.encode())] = k
    kind[0x80:0xC0] = 5
    for batch in batches:
        text = batch.column(1).cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        counts = np.zeros((len(TEXT_FEATURES), len(text)))
        for start in range(int(offsets[0]), int(offsets[-1]), COUNTED_BYTES):
            stop = min(start + COUNTED_BYTES, int(offsets[-1]))
            first = np.searchsorted(offsets, start, "right") - 1
            last = np.searchsorted(offsets, stop, "left")
            bounds = np.clip(offsets[first : last + 1], start, stop) - start
            kinds = kind[data[start:stop]]
            for row, flags in enumerate((kinds != 5, kinds == 1, kinds == 2, kinds == 3, kinds == 4)):
                # Flagged bytes of each text in the piece, from running totals.
                running = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
                counts[row, first:last] += np.diff(running[bounds])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c) for c in counts]], names=["doc_id", *TEXT_FEATURES]
        )


def text_samples(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """Labelled documents described by character counts; the text itself is never shuffled."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in TEXT_FEATURES)
    counted = documents.mapInArrow(_character_counts, schema)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return FeatureTable.of(counted.join(labels, "doc_id"), TEXT_FEATURES, "quality")


def vectors(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """Embeddings as one array column of 64 features."""
    df = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label")
    )
    return FeatureTable.of(df, [f"e{i}" for i in range(64)], "label", array="embedding")


def halved_vectors(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """Embeddings with their labels in two classes."""
    whole = vectors(spark, sf_dir)
    half = F.when(F.col("label").cast("int") < 5, "low").otherwise("high")
    return FeatureTable.of(whole.df.withColumn("half", half), whole.features, "half", array="embedding")


def gapped_lines(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """The lines to be told apart, three line numbers with a missing or infinite value."""
    lines = banded_lines(spark, sf_dir)
    number = F.col("l_linenumber")
    quantity = F.when(number != 1, F.col("l_quantity").cast("double"))
    price = (
        F.when(number == 2, F.lit(float("nan")))
        .when(number == 3, F.lit(float("inf")))
        .otherwise(F.col("l_extendedprice").cast("double"))
    )
    return lines.with_df(lines.df.withColumns({"l_quantity": quantity, "l_extendedprice": price}))


def partly_labelled_texts(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """The labelled documents with every fourth label taken away."""
    texts = text_samples(spark, sf_dir)
    return texts.with_df(texts.df.withColumn("quality", F.when(F.col("doc_id") % 4 != 0, F.col("quality"))))


def vector_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two embedding entries as points with a label."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.get("embedding", F.lit(0)).cast("double").alias("x"),
        F.get("embedding", F.lit(1)).cast("double").alias("y"),
        F.col("label").cast("string").alias("label"),
    )


def nation_symbol(key: str) -> Column:
    return F.char(F.lit(65) + F.col(key))


def entities(spark: SparkSession, sf_dir: str) -> FeatureTable:
    """Nations with customers and suppliers, described by their mean balances."""

    def balances(name: str, key: str, amount: str, alias: str) -> DataFrame:
        return table(spark, sf_dir, name).groupBy(F.col(key).alias("nation")).agg(F.avg(amount).alias(alias))

    both = balances("customer", "c_nationkey", "c_acctbal", "customer_balance").join(
        balances("supplier", "s_nationkey", "s_acctbal", "supplier_balance"), "nation"
    )
    df = both.select(nation_symbol("nation").alias("Symbol"), *ENTITY_FEATURES)
    return FeatureTable.of(df, ENTITY_FEATURES)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer nation and supplier nation of each line, with its return flag; distinct."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", nation_symbol("c_nationkey").alias("a"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", nation_symbol("s_nationkey").alias("b"))
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.concat("a", "b").alias("formula"), F.col("l_returnflag").alias("structure"))
        .distinct()
    )
