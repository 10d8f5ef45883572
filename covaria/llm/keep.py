"""Keep one row of each group of documents, given marks on (id, text) pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.llm.text import small_enough
from covaria.operators.durable import stored


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def winners(rows: DataFrame, group: list[str], first: list[Column]) -> DataFrame:
    """Per group its size and best row: smallest in ``first``, then id (null last), then hash.

    ``rows`` has doc_id and h. Rows that agree in all of these are twins, counted in ``n``.
    Combines inside each task twice, so a group may hold any share of the rows.
    """
    rows = rows.withColumn("rank", F.struct(*first, F.col("doc_id").isNull().alias("absent"), "doc_id", "h"))
    return (
        rows.groupBy(*group, "rank")
        .agg(F.count("*").alias("n"))
        .groupBy(*group)
        .agg(F.min(F.struct("rank", "n")).alias("best"), F.sum("n").alias("group_size"))
        .select(*group, "group_size", F.col("best.rank").alias("best"), F.col("best.n").alias("n_twins"))
    )


def one_of_each(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows marked as not kept, and with one of identical kept rows.

    ``marks`` has doc_id, h (``text_hash``), kept and n_twins. Its rows that change anything
    are joined by (id, hash); texts are shuffled only if those exceed the broadcast size.
    A document travels packed as one struct beside its keys, so that columns of any name,
    ``__id``, ``__h`` or names with dots among them, come back as they were.
    """
    key = ["__id", "__h"]
    named = marks.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "kept", "n_twins")
    changes = stored(named.where(~F.col("kept") | (F.col("n_twins") > 1)).distinct())
    twins = changes.where("kept")
    keyed = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("__row"),
        column(id_col).alias("__id"),
        text_hash(column(text_col)).alias("__h"),
    )

    def joined(other: DataFrame, how: str) -> DataFrame:
        other = small_enough(other.select(*key), 144)
        same = reduce(lambda a, b: a & b, [keyed[k].eqNullSafe(other[k]) for k in key])
        return keyed.join(other, same, how)

    kept = joined(changes, "left_anti").select("__row")
    if not twins.isEmpty():
        one = (
            joined(twins, "left_semi")
            .groupBy(*key)
            .agg(F.max_by(F.col("__row"), F.xxhash64(F.to_json(F.col("__row")))).alias("__row"))
            .select("__row")
        )
        kept = kept.union(one)
    return kept.select([F.col("__row").getField(c).alias(c) for c in docs.columns])
