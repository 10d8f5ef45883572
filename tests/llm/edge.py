"""A small table with what real tables hold: nulls, empty and long texts, repeated rows, odd columns."""

EXTRA = ("h", "row", "fp", "kept", "rank", "part", "size", "place", "words", "best", "sequence_id", "class_id")

TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b"),
    (4, "one two"),
    (4, "one two"),
    (None, "a row without an id has words too"),
    (None, None),
    (5, "one  two"),
    (6, "word " * 40_000),
    (7, "é x… İ ß\x1cy"),
    (1, "the same id with another text"),
    (8, "ONE TWO"),
    (9, "x" * 100_000),
    (10, " ".join(f"w{i}" for i in range(300))),
    (11, " ".join(f"w{i}" for i in range(300))),
]


def table(spark, rows=TEXTS):
    """doc_id, text, lang, source and further columns named like the operators' own."""
    langs, sources = ["en", None, "de"], ["b", None, "a", "b"]
    data = [
        (i, t, langs[k % 3], sources[k % 4], *[f"{name}{k}" for name in EXTRA]) for k, (i, t) in enumerate(rows)
    ]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame(data, schema)
