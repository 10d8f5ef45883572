"""Quality rules: a table of thresholds compiled into one Spark projection.

Measures are columns made of built-in functions only. ``RULES`` names a measure and the
range in which a good document lies; ``verdict`` turns the whole table into one boolean
column, so that adding a rule adds a comparison and no pass.

Defined results: a null text has no words and fails; a text of white space likewise. Rows
are judged one by one, so repeated rows and ids get equal verdicts. Other columns,
whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.llm.text import SPACES, let, word_array

WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED_PERCENT = 30
SYMBOLS = r"#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with",
    "der", "die", "das", "und", "zu", "den", "von", "ist", "nicht", "ein",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "est",
    "el", "los", "las", "y", "en", "por", "para", "con", "se", "del",
)


@dataclass(frozen=True)
class Rule:
    """A measure and the values, both included, that a good document has."""

    measure: str
    least: float | None = None
    most: float | None = None


#: Wide enough for short notes and tables; what is outside is no running text.
RULES = (
    Rule("mean_word_chars", 1.5, 25.0),
    Rule("symbols_per_word", None, 1.0),
    Rule("stop_word_share", 0.005, None),
    Rule("dup_line_share", None, 0.6),
)


def _doubled(hashes: Column, shift: int) -> Column:
    """From hashes of runs of ``shift`` words, those of runs of twice as many."""
    n = F.size(hashes) - shift
    pair = F.zip_with(
        F.slice(hashes, F.lit(1), F.greatest(n, F.lit(0))),
        F.slice(hashes, F.lit(shift + 1), F.greatest(n, F.lit(0))),
        lambda a, b: F.xxhash64(a, b),
    )
    return F.when(n > 0, pair).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twins = let(
        placed,
        lambda s: F.transform(
            F.filter(
                F.zip_with(
                    s,
                    F.concat(F.array(F.lit(None).cast(_PLACED)), F.slice(s, F.lit(1), F.size(s) - 1)),
                    lambda a, b: F.struct(a.alias("own"), b.alias("before")),
                ),
                lambda p: p["own"]["h"] == p["before"]["h"],
            ),
            lambda p: F.array(p["own"]["i"], p["before"]["i"]),
        ),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(twins)))
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        starts,
        start,
        lambda acc, i: F.struct(
            (acc["words"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("words"), i.alias("last")
        ),
        lambda acc: acc["words"],
    )


_PLACED = "struct<h:bigint,i:int>"


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with counts and the ratios that rules name."""
    lines = F.filter(F.split(F.col("text"), "\n"), lambda line: line.rlike(f"[^{SPACES}]"))
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = base.select("doc_id", "text", word_array(F.col("text")).alias("words"), lines.alias("lines"))
    counted = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    for shift in (1, 2, 4):
        counted = counted.withColumn("h", _doubled(F.col("h"), shift))
    repeated = F.when(F.size(F.array_distinct("h")) < F.size("h"), _covered(F.col("h"))).otherwise(F.lit(0))
    some = lambda n: F.greatest(F.col(n), F.lit(1))
    return counted.withColumn("n_repeat_words", repeated.cast("long")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("word_chars") / some("n_words")).alias("mean_word_chars"),
        (F.col("n_symbols") / some("n_words")).alias("symbols_per_word"),
        (F.col("n_stop_words") / some("n_words")).alias("stop_word_share"),
        (F.col("n_dup_lines") / some("n_lines")).alias("dup_line_share"),
    )


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule of the table holds."""
    checks = [F.col(r.measure) >= r.least for r in rules if r.least is not None]
    checks += [F.col(r.measure) <= r.most for r in rules if r.most is not None]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures of every document with ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return measures(docs, id_col, text_col).select(
        *columns, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept")
    )
