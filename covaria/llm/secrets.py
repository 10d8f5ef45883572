r"""Secret scans by patterns and a battery of randomness tests, in built-in functions only.

Patterns find assignments, access keys and hexadecimal strings (``PATTERNS``). Beyond them,
every run of 20 or more key characters with a capital, or with a small letter and a digit, is
a candidate (of random base36 strings 0.2 % have small letters alone, as words do), also
behind an equals sign; of a run that overlaps a pattern's span, each part of that length outside it is. Its
encoding is inferred from its characters (hex, base32, base36, base62, base64), which gives
each character a value below the alphabet's size k. Against the hypothesis that the values
are independent and uniform, three tests are made:

* chi-squared uniformity of the alphabet, (k / n) sum o^2 - n, standardised by its exact
  mean and variance under the hypothesis, since n is small against k; upper tail;
* the Wald-Wolfowitz runs test of values below and above the middle, two-sided;
* the serial correlation of neighbours, two-sided.

Fisher's method combines the p-values. Over all candidates of the corpus in a class of
lengths, Benjamini-Hochberg decides which are structured text and not random; the classes
have levels of their own, larger for short strings, where tests have little power. What is
not rejected is reported as ``random``. The procedure
needs the order of p-values only, so it counts them in bins of 0.01 in -log10(p): a fixed
number of rows whatever the data, with thresholds on the cautious side of a bin.

Positions are code points, the end exclusive. Defined results: a null text counts as empty
and has no spans. Repeated rows get equal results (each occurrence counts as a candidate).
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covaria.llm.text import let
from covaria.operators.durable import stored

# The patterns of the contract, in its order of kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGNED = 12
LEAST_KEY = 20
KEY = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
# Pattern, alphabet, size; the first that matches is the encoding.
ENCODINGS = (
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("^[0-9A-Za-z+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_+/"),
)
#: Shortest length of a class, and the rate of random strings it may miss among those rejected.
LEVELS = ((20, 0.25), (28, 0.10), (40, 0.05))
#: Bins of 0.01 in -log10(p), the last one open.
BINS = 1500
_BLOCK = 256


def _running(numbers: Column) -> Column:
    """Sum of what stands before each number."""
    start = F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(
        numbers,
        start,
        lambda acc, x: F.struct(
            (acc["s"] + x).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")
        ),
        lambda acc: acc["out"],
    )


def _before(numbers: Column) -> Column:
    """As ``_running``, in blocks, so that long arrays are not copied once per element."""
    count = F.floor((F.size(numbers) + _BLOCK - 1) / _BLOCK).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))

    def joined(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x))
        moved = F.zip_with(blocks, _running(sums), lambda b, s: F.transform(_running(b), lambda x: x + s))
        return F.flatten(moved)

    return let(F.transform(starts, lambda b: F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK))), joined)


def _matches(text: Column, pattern: str) -> Column:
    """start, end and text of all leftmost matches; the text between them is what split leaves."""
    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern).alias("gaps")
    )

    def placed(m: Column) -> Column:
        pair = F.zip_with(
            F.slice(m["gaps"], F.lit(1), F.size(m["hits"])),
            m["hits"],
            lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("n"), hit.alias("hit")),
        )
        return let(
            pair,
            lambda p: F.zip_with(
                p,
                _before(F.transform(p, lambda x: x["gap"] + x["n"])),
                lambda x, at: F.struct(
                    (at + x["gap"]).alias("start"), (at + x["gap"] + x["n"]).alias("end"), x["hit"].alias("hit")
                ),
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return F.when(text.rlike(pattern), let(both, placed)).otherwise(none)


def _spans(matches: Column, kind: int) -> Column:
    return F.transform(
        matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    )


def _upper_tail(z: Column) -> Column:
    """Probability of a normal value above z (Abramowitz and Stegun 26.2.17)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    # The published coefficients.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / 2.5066282746310002 * poly
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-15))


def battery(token: Column) -> Column:
    """Combined p-value of the three tests for a string of key characters."""
    alphabet = F.coalesce(
        *[F.when(token.rlike(p), F.lit(a)) for p, a in ENCODINGS[:-1]], F.lit(ENCODINGS[-1][1])
    )

    def tested(v: Column) -> Column:
        # v: values below k, and k
        n, k, x = F.size(v["x"]).cast("double"), v["k"].cast("double"), v["x"]
        zero = F.lit(0.0)
        counted = F.aggregate(
            F.sort_array(x),
            F.struct(F.lit(-1).alias("last"), zero.alias("run"), zero.alias("squares")),
            lambda acc, y: F.struct(
                y.alias("last"),
                F.when(acc["last"] == y, acc["run"] + 1).otherwise(1.0).alias("run"),
                # A run that grows from r to r + 1 adds 2 r + 1 to the sum of squares.
                (acc["squares"] + F.when(acc["last"] == y, 2 * acc["run"] + 1).otherwise(1.0)).alias("squares"),
            ),
            lambda acc: acc["squares"],
        )
        walk = F.aggregate(
            x,
            F.struct(
                F.lit(-1).alias("last"), zero.alias("runs"), zero.alias("high"),
                zero.alias("s"), zero.alias("ss"), zero.alias("sp"),
            ),
            lambda acc, y: F.struct(
                y.alias("last"),
                (
                    acc["runs"]
                    + F.when((acc["last"] >= 0) & ((2 * acc["last"] >= k) == (2 * y >= k)), 0.0).otherwise(1.0)
                ).alias("runs"),
                (acc["high"] + F.when(2 * y >= k, 1.0).otherwise(0.0)).alias("high"),
                (acc["s"] + y).alias("s"),
                (acc["ss"] + y * y).alias("ss"),
                (acc["sp"] + F.when(acc["last"] >= 0, acc["last"] * y).otherwise(0.0)).alias("sp"),
            ),
        )

        def combined(w: Column) -> Column:
            chi = (k / n * counted - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
            m = 2 * w["high"] * (n - w["high"]) / n
            spread = m * (m - 1) / (n - 1)
            runs = F.when(spread > 0, (w["runs"] - m - 1) / F.sqrt(spread)).otherwise(F.lit(-9.0))
            mean = w["s"] / n
            variance = w["ss"] / n - mean * mean
            outer = F.element_at(x, 1) + F.element_at(x, -1)
            r = (w["sp"] + mean * outer - mean * mean * (n + 1)) / n / variance
            serial = F.when(variance > 0, (r + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
            p = [_upper_tail(chi), 2 * _upper_tail(F.abs(runs)), 2 * _upper_tail(F.abs(serial))]
            half = -(F.log(p[0]) + F.log(F.least(p[1], F.lit(1.0))) + F.log(F.least(p[2], F.lit(1.0))))
            # Fisher's statistic has six degrees of freedom.
            return F.exp(-half) * (1 + half + half * half / 2)

        return let(walk, combined)

    def values(a: Column) -> Column:
        chars = F.filter(F.split(token, ""), lambda c: c != "")
        places = F.transform(chars, lambda c: (F.instr(a, c) - 1))
        return F.struct(places.alias("x"), F.length(a).alias("k"))

    return let(alphabet, lambda a: let(values(a), tested))


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(p) * 100), F.lit(BINS)).cast("int")


def _length_class(n: Column) -> Column:
    return sum((n >= least).cast("int") for least, _ in LEVELS) - 1


def _outside(m: Column, base: Column) -> Column:
    """start, end and text of the parts of a match that no span of ``base`` covers."""
    hits = F.filter(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    part = lambda start, end: F.array(F.struct(start.alias("start"), end.alias("end")))
    start = F.struct(m["start"].alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    parts = F.aggregate(
        hits,
        start,
        lambda acc, b: F.struct(
            F.greatest(acc["at"], b["end"]).alias("at"),
            F.when(b["start"] > acc["at"], F.concat(acc["out"], part(acc["at"], b["start"]))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.when(m["end"] > acc["at"], F.concat(acc["out"], part(acc["at"], m["end"]))).otherwise(acc["out"]),
    )
    return F.transform(
        parts,
        lambda p: F.struct(
            p["start"].alias("start"),
            p["end"].alias("end"),
            F.substring(m["hit"], p["start"] - m["start"] + 1, p["end"] - p["start"]).alias("hit"),
        ),
    )


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (spans of patterns) and candidates (start, end, length class, bin)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    assign = F.filter(
        _matches(F.col("text"), ASSIGN),
        lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= LEAST_ASSIGNED,
    )
    keys = _matches(F.col("text"), KEY)
    rows = rows.select(
        "doc_id",
        F.array_sort(F.concat(
            _spans(assign, 0), _spans(_matches(F.col("text"), ACCESS), 1), _spans(_matches(F.col("text"), HEX), 2)
        )).alias("base"),
        keys.alias("keys"),
    )
    parts = F.flatten(F.transform("keys", lambda m: _outside(m, F.col("base"))))
    free = F.filter(parts, lambda m: (m["end"] - m["start"] >= LEAST_KEY) & m["hit"].rlike("[A-Za-z]") & m["hit"].rlike("[0-9A-Z]"))
    scored = F.transform(
        free,
        lambda m: F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            _length_class(m["end"] - m["start"]).alias("class"),
            _bin(battery(m["hit"])).alias("bin"),
        ),
    )
    return rows.select("doc_id", "base", scored.alias("candidates"))


def thresholds(rows: DataFrame) -> DataFrame:
    """Per length class the first bin that Benjamini-Hochberg rejects; none if nothing is."""
    each = rows.select(F.explode("candidates").alias("c")).groupBy("c.class", "c.bin").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("class")
    level = F.element_at(F.array(*[F.lit(q) for _, q in LEVELS]), F.col("class") + 1)
    # All in a bin have p of at most 10^(-bin / 100), the p-value of its lower edge.
    rank = F.sum("n").over(by_class.orderBy(F.col("bin").desc()))
    passed = F.pow(F.lit(10.0), -F.col("bin") / 100) <= level * rank / F.sum("n").over(by_class)
    return each.withColumn("passed", passed).where("passed").groupBy("class").agg(F.min("bin").alias("from"))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and all spans: arrays of (start, kind, end), kind an index into ``KINDS``."""
    rows = stored(found(docs, id_col, text_col))
    # One row per length class.
    first = {r["class"]: r["from"] for r in thresholds(rows).collect()}
    limits = F.array(*[F.lit(first.get(k, BINS + 1)) for k in range(len(LEVELS))])
    random = F.filter("candidates", lambda c: c["bin"] < F.element_at(limits, c["class"] + 1))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", _spans(random, 3))).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
