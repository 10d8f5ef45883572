"""Column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")

# Fixed value: an element symbol is one capital letter and at most one small letter.
SYMBOL_PATTERN = "[A-Z][a-z]?"


def column(name: str) -> Column:
    """Column by exact name; names may hold dots, slashes, commas or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def total(terms: Sequence[Column]) -> Column:
    """Sum of the terms as a balanced tree, so that long sums stay shallow."""
    terms = list(terms)
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        pairs = [terms[i] + terms[i + 1] for i in range(0, len(terms) - 1, 2)]
        terms = pairs + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


def finite(value: Column) -> Column:
    """The value where it is a finite number, NULL for NULL, NaN and both infinities.

    Spark orders NaN above every number, so one comparison rejects NaN and infinity.
    """
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def clean_value(value: Column, nan_value: float = 0.0, inf_value: float = 0.0) -> Column:
    """Replace NULL and NaN by ``nan_value`` and both infinities by ``inf_value``."""
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(float(nan_value)))
        .when(F.abs(value) == F.lit(INFINITY), F.lit(float(inf_value)))
        .otherwise(value)
    )


def safe_division(a: Column, b: Column, default: float = 0.0) -> Column:
    """``a / b``, or ``default`` where ``b`` is zero; NULL operands stay NULL."""
    return F.when(b == 0, F.lit(float(default))).otherwise(a / F.when(b != 0, b))


def formula_tokens(formula: Column) -> Column:
    """Element symbols of a formula in order; digits and other characters are ignored."""
    return F.regexp_extract_all(formula, F.lit(SYMBOL_PATTERN), F.lit(0))


def display_number(value: Column) -> Column:
    """Three decimals, or ``N/A`` where the number is undefined."""
    undefined = value.isNull() | F.isnan(value)
    return F.when(undefined, F.lit("N/A")).otherwise(F.format_string("%.3f", value))


def display_percent(value: Column) -> Column:
    """One decimal and a percent sign."""
    return F.format_string("%.1f%%", value)


def argmax_first(values: Column) -> Column:
    """1-based position of the largest array entry; the first one wins a tie."""
    return F.array_position(values, F.array_max(values)).cast("int")


def join_names(names: Column) -> Column:
    """Array of names as comma-joined text."""
    return F.concat_ws(",", names)


def split_names(text: Column) -> Column:
    """Comma-joined text as an array of names; empty text gives an empty array."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))
