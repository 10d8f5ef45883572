"""Words, ids and small expressions that the operators of this package share.

White space is the six ASCII characters space, tab, line feed, vertical tab, form feed and
carriage return; a word is a longest run of other characters. ``bytes.split()`` cuts at
exactly these characters, so Python and Spark agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covaria.functions import column

SPACES = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: A broadcast table may hold so many bytes; a larger one is joined by a shuffle.
BROADCAST_BYTES = 64 << 20
_ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_array(text: Column) -> Column:
    """The words of a text in order; null gives an empty array."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_BYTES.decode()))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACES}]+"))


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with the value computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of an id written as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def lower_ascii(raw: bytes) -> bytes:
    return raw.translate(_ASCII_LOWER)


def shuffled(table: DataFrame) -> DataFrame:
    """``table`` marked to be joined by a shuffle, however small Spark takes it to be.

    Spark broadcasts what it guesses to be small, and guesses the rows a Python function or an
    explode puts out from the bytes put in, and a stored table from its packed files.
    """
    return table.hint("merge")


def small_enough(table: DataFrame, row_bytes: int) -> DataFrame:
    """``table`` marked for broadcast if a pass over it proves it small, else for a shuffle.

    ``row_bytes`` bounds the size of a row without its texts. These are measured, and count
    twice: a broadcast row holds its key apart.
    """
    size = F.lit(row_bytes).cast("long")
    for name, kind in table.dtypes:
        if kind in ("string", "binary"):
            size = size + 2 * F.coalesce(F.octet_length(column(name)), F.lit(0))
    held = table.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(table) if held <= BROADCAST_BYTES else shuffled(table)


def slices(values: list[bytes], most: int = 4 << 20):
    """Ranges of ``values`` that hold about ``most`` bytes, one value at least."""
    begin, held = 0, 0
    for k, value in enumerate(values):
        if held and held + len(value) > most:
            yield begin, k
            begin, held = k, 0
        held += len(value)
    if begin < len(values):
        yield begin, len(values)


def raw_texts(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]
