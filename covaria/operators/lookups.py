"""Lookups by key in a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.sources.categories import UNKNOWN_CATEGORY

# A lookup table is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows with a NULL key match nothing; a shuffled join deals them to so many places.
NULL_PLACES = 256


def measured_bytes(table: DataFrame) -> int:
    """Bytes the table's values take, from one pass: text by its length, other fields 16 each."""
    size = F.lit(0).cast("long")
    for f in table.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column(f.name)), F.lit(0)) + 16
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column(f.name)))), F.lit(0))
        else:
            size = size + 16
    return table.agg(F.sum(size)).first()[0] or 0


def lookup(
    rows: DataFrame,
    table: DataFrame,
    row_key: str,
    table_key: str,
    keep_unmatched: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    table_bytes: int | None = None,
) -> DataFrame:
    """Add the columns of ``table`` (one row per ``table_key``) to the matching rows.

    A table measured (or known, ``table_bytes``) to be small is broadcast, so hot keys do no
    harm. A larger one is joined by one shuffle of each side: adaptive execution splits the
    partitions of hot keys, and rows with a NULL key, which match nothing, are dealt evenly.
    """
    how = "left" if keep_unmatched else "inner"
    match_key = "__lookup_key"
    table = table.withColumnRenamed(table_key, match_key)
    same = column(row_key) == column(match_key)
    if (measured_bytes(table) if table_bytes is None else table_bytes) <= broadcast_bytes:
        return rows.join(F.broadcast(table), same, how).drop(match_key)
    if not keep_unmatched:
        return rows.join(table, same, how).drop(match_key)
    # By a hash of the row, so that a task run again deals its rows alike.
    plain = [column(f.name) for f in rows.schema.fields if not f.dataType.simpleString().startswith(("map", "array", "struct"))]
    spread = F.pmod(F.xxhash64(*plain), F.lit(NULL_PLACES)).cast("int") + 1
    place = F.when(column(row_key).isNull(), spread).otherwise(0)
    dealt = rows.withColumn("__place", place)
    zero = table.withColumn("__at", F.lit(0))
    joined = dealt.join(zero, same & (F.col("__place") == F.col("__at")), how)
    return joined.drop(match_key, "__place", "__at")


def invert_categories(
    categories: DataFrame,
    category: str = "category",
    members: str = "symbols",
    order_by: str = "ord",
) -> DataFrame:
    """``symbol, category`` from rows of category and member array.

    A symbol listed by several categories goes to the last of them by ``order_by``.
    """
    listed = categories.select(
        F.explode(column(members)).alias("symbol"), column(category).alias("category"), column(order_by).alias("ord")
    )
    return listed.groupBy("symbol").agg(F.max_by("category", "ord").alias("category"))


def with_category(
    rows: DataFrame,
    symbols: DataFrame,
    key: str,
    unknown: str = UNKNOWN_CATEGORY,
    symbol_bytes: int | None = None,
) -> DataFrame:
    """Add ``category`` from a ``symbol, category`` table; unlisted keys get ``unknown``."""
    found = lookup(rows, symbols.select("symbol", "category"), key, "symbol", True, table_bytes=symbol_bytes)
    return found.withColumn("category", F.coalesce("category", F.lit(unknown)))


def first_per_key(table: DataFrame, key: str, values: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the values of its first row by ``order_by``.

    Without an order the smallest values win, so that the outcome is defined. Partial
    results are combined before the shuffle, however many rows repeat one key.
    """
    payload = F.struct(*[column(v) for v in values])
    order = F.struct(*[column(o) for o in order_by]) if order_by else payload
    first = table.groupBy(column(key).alias(key)).agg(F.min_by(payload, order).alias("__first"))
    return first.select(column(key), *[F.col("__first").getField(v).alias(v) for v in values])
