"""Pairs of entities placed in component space."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.functions import column, formula_tokens
from covaria.operators.durable import settle
from covaria.operators.lookups import first_per_key, lookup, measured_bytes


def split_pairs(pairs: DataFrame, formula: str = "formula") -> DataFrame:
    """Add ``tokens``: the element symbols of the formula."""
    return pairs.withColumn("tokens", formula_tokens(column(formula)))


def valid_pairs(pairs: DataFrame, formula: str = "formula") -> DataFrame:
    """Pairs of exactly two symbols, with ``symbol_a`` and ``symbol_b``."""
    # As a generator, not a filter: a filter would be pushed below whatever made the pairs
    # distinct, and the pattern searched in every row there instead of once per pair.
    ends = F.struct(F.get("tokens", F.lit(0)).alias("symbol_a"), F.get("tokens", F.lit(1)).alias("symbol_b"))
    two = F.filter(F.array(ends), lambda _: F.size("tokens") == 2)
    return split_pairs(pairs, formula).select(*pairs.columns, F.inline(two))


def rejected_pairs(pairs: DataFrame, formula: str = "formula") -> DataFrame:
    """Pairs whose formula is missing or does not hold exactly two symbols."""
    split = split_pairs(pairs, formula)
    return (
        split.withColumn("n_tokens", F.coalesce(F.size("tokens"), F.lit(0)))
        .where(F.col("tokens").isNull() | (F.col("n_tokens") != 2))
        .drop("tokens")
    )


def _ends(
    pairs: DataFrame, scores: DataFrame, key: str, x: str, y: str, order_by: Sequence[str], keep_unmatched: bool
) -> DataFrame:
    # Looked up twice and counted: computed once and stored.
    entities = settle(first_per_key(scores, key, [x, y], order_by))
    size = measured_bytes(entities)

    def coordinates(i: int) -> DataFrame:
        return entities.select(
            column(key).alias(f"__key{i}"), column(x).alias(f"x{i}"), column(y).alias(f"y{i}")
        )

    start = lookup(valid_pairs(pairs), coordinates(0), "symbol_a", "__key0", keep_unmatched, table_bytes=size)
    return lookup(start, coordinates(1), "symbol_b", "__key1", keep_unmatched, table_bytes=size)


def pair_links(
    pairs: DataFrame,
    scores: DataFrame,
    key: str = "Symbol",
    x: str = "PC1",
    y: str = "PC2",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``formula, structure``, the coordinates of both ends and their midpoint.

    A pair with an end the score table does not list is left out. An entity listed more
    than once counts with its first row by ``order_by``.
    """
    ends = _ends(pairs, scores, key, x, y, order_by, keep_unmatched=False)
    return ends.select(
        "formula",
        "structure",
        "x0",
        "y0",
        "x1",
        "y1",
        ((F.col("x0") + F.col("x1")) / 2).alias("mid_x"),
        ((F.col("y0") + F.col("y1")) / 2).alias("mid_y"),
    )


def link_counts(
    pairs: DataFrame, scores: DataFrame, key: str = "Symbol", x: str = "PC1", y: str = "PC2"
) -> DataFrame:
    """One row: ``n_pairs`` with two symbols, ``n_links`` placed, ``n_skipped`` unknown."""
    ends = _ends(pairs, scores, key, x, y, (), keep_unmatched=True)
    placed = F.col("x0").isNotNull() & F.col("x1").isNotNull()
    return ends.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count(F.when(placed, 1)).alias("n_links"),
        F.count(F.when(~placed, 1)).alias("n_skipped"),
    )
