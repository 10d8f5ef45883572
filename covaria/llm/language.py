"""Language ID by averaged hashed subword embeddings and a linear softmax.

A text, ASCII letters lowered and white space turned into blanks, is described by the
average embedding of its subwords: byte runs of ``SIZES`` lengths, blanks marking word
boundaries, hashed to ``BUCKETS`` rows. A linear softmax over that average gives the language.
Both are trained together by stochastic gradient descent in numpy.

The model is fitted on a bounded sample of labelled rows: ``per_language`` rows expected of
each language, chosen by a seeded hash, none with more than ``LONGEST`` bytes. A fifth of the
sample is not trained on but calibrates: it sets the temperature of the softmax, and the
rejection level so that at most ``reject_share`` of the correctly recognised texts fall
below it (and never above one half). Prediction reads every text whole and needs no shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is
rejected. Without labelled rows every text is. Ties go to the first language in order. Only
the text is an input of a prediction. Repeated rows get equal results. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covaria.functions import column
from covaria.llm.text import lower_ascii, raw_texts, slices

SIZES = (2, 3, 4)
BUCKETS = 1 << 15
WIDTH = 8
PER_LANGUAGE = 400
LONGEST = 100_000
REJECT_SHARE = 0.001
SEED = 7
UNKNOWN = "und"
#: Positions hashed at a time.
BLOCK = 1 << 19
_BLANKS = bytes(32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))
_PAD = b" " * max(SIZES)


@dataclass(frozen=True)
class Model:
    """Embeddings (buckets by width), softmax weights and bias, temperature, rejection level."""

    languages: tuple[str, ...]
    embeddings: object
    weights: object
    bias: object
    temperature: float = 1.0
    level: float = 0.0


def _flat(raws: list[bytes]):
    """The texts padded by blanks in one array, and where each begins and ends with one blank around."""
    import numpy as np

    texts = [lower_ascii(r).translate(_BLANKS) for r in raws]
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(_PAD + _PAD.join(texts) + _PAD + _PAD, np.uint8)
    ends = len(_PAD) + np.cumsum(lengths + len(_PAD)) - len(_PAD)
    return flat, ends - lengths - 1, ends


def _buckets(flat, begin: int, end: int):
    """For each size, the buckets of the subwords that start in a range."""
    import numpy as np

    code, found = flat[begin:end].astype(np.uint64), []
    for size in range(2, max(SIZES) + 1):
        code = (code << np.uint64(8)) | flat[begin + size - 1 : end + size - 1]
        if size in SIZES:
            mixed = (code + np.uint64(size << 40)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(49)).astype(np.int64) % BUCKETS)
    return found


def averages(raws: list[bytes], columns):
    """Average embedding of each text; ``columns`` are the embeddings by dimension."""
    import numpy as np

    flat, starts, ends = _flat(raws)
    out = np.zeros((len(raws), len(columns)))
    for at in range(int(starts[0]), int(ends[-1]), BLOCK):
        upto = min(at + BLOCK, int(ends[-1]))
        here = np.flatnonzero((starts < upto) & (ends > at))
        lo, hi = np.maximum(starts[here], at) - at, np.minimum(ends[here], upto) - at
        edges = np.stack([lo, hi], axis=1).ravel()
        for buckets in _buckets(flat, at, upto):
            for k, column in enumerate(columns):
                values = np.append(column[buckets], 0.0)  # so that an edge may stand at the end
                out[here, k] += np.add.reduceat(values, edges)[::2]
    return out / (len(SIZES) * (ends - starts))[:, None]


def _softmax(logits):
    import numpy as np

    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(
    raws: list[bytes], labels: list[str], epochs: int = 20, rate: float = 3.0, batch: int = 16, seed: int = SEED,
    reject_share: float = REJECT_SHARE,
) -> Model | None:
    """A model of labelled texts, or None without any."""
    import numpy as np

    if not raws:
        return None
    languages = tuple(sorted(set(labels)))
    y = np.array([languages.index(label) for label in labels])
    random = np.random.default_rng(seed)
    order = random.permutation(len(raws))
    held, train = order[: len(raws) // 5], order[len(raws) // 5 :]
    features = []
    for raw in raws:
        flat, starts, ends = _flat([raw])
        ids, n = np.unique(np.concatenate(_buckets(flat, int(starts[0]), int(ends[0]))), return_counts=True)
        features.append((ids, n / n.sum()))
    embeddings = random.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    weights, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    steps = epochs * -(-len(train) // batch)
    step = 0
    for _ in range(epochs):
        random.shuffle(train)
        for at in range(0, len(train), batch):
            some = train[at : at + batch]
            ids = np.concatenate([features[k][0] for k in some])
            shares = np.concatenate([features[k][1] for k in some])
            sizes = np.array([len(features[k][0]) for k in some])
            begin = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(embeddings[ids] * shares[:, None], begin)
            error = _softmax(mean @ weights + bias)
            error[np.arange(len(some)), y[some]] -= 1
            pull = np.repeat(error @ weights.T, sizes, axis=0) * shares[:, None]
            now = rate * (1 - step / steps)
            weights -= now * mean.T @ error / len(some)
            bias -= now * error.mean(axis=0)
            # Shares are small, so embeddings move by sums over the batch at a larger rate.
            for k in range(WIDTH):
                embeddings[:, k] -= 20 * now * np.bincount(ids, pull[:, k], BUCKETS)
            step += 1
    model = Model(languages, embeddings, weights, bias)
    return _calibrated(model, [raws[k] for k in held], y[held], reject_share)


def _calibrated(model: Model, raws: list[bytes], y, reject_share: float) -> Model:
    """``model`` with the temperature that suits unseen texts best, and its rejection level."""
    import numpy as np

    if not raws:
        return model
    logits = averages(raws, list(model.embeddings.T.copy())) @ model.weights + model.bias
    heats = np.geomspace(0.1, 10, 61)
    loss = [-np.log(_softmax(logits / h)[np.arange(len(y)), y] + 1e-300).mean() for h in heats]
    heat = float(heats[int(np.argmin(loss))])
    p = _softmax(logits / heat)
    right = p.argmax(axis=1) == y
    level = float(np.quantile(p.max(axis=1)[right], reject_share)) if right.any() else 0.0
    return Model(model.languages, model.embeddings, model.weights, model.bias, heat, min(level, 0.5))


def sampled(labelled: DataFrame, per_language: int = PER_LANGUAGE, seed: int = SEED) -> tuple[list[bytes], list[str]]:
    """Texts and languages of the sample; ``labelled`` has text and lang, neither null."""
    usable = labelled.where(F.octet_length("text") <= LONGEST)
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "text"), 12) / float(1 << 52)
    rows = (
        usable.join(F.broadcast(counts), "lang")  # one row per language
        .where(place < F.lit(float(per_language)) / F.col("n"))
        .select("text", "lang")
        .collect()
    )
    rows = sorted((r["lang"], r["text"]) for r in rows)
    return [t.encode() for _, t in rows], [lang for lang, _ in rows]


def predicted(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every document, and the columns ``also``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        columns = list(np.ascontiguousarray(model.embeddings.T)) if model else []
        for batch in batches:
            raws = raw_texts(batch.column("__text"))
            names, scores = [], []
            for begin, end in slices(raws, 1 << 20):
                some = raws[begin:end]
                if model:
                    p = _softmax((averages(some, columns) @ model.weights + model.bias) / model.temperature)
                for k, raw in enumerate(some):
                    text = raw.decode("utf-8", "replace") if model else ""
                    if any(map(str.isalpha, text)):
                        best = int(p[k].argmax())
                        names.append(model.languages[best])
                        scores.append(min(1.0, float(p[k, best])))
                    else:
                        names.append(UNKNOWN)
                        scores.append(0.0)
            level = model.level if model else 1.0
            rejected = [n == UNKNOWN or s < level for n, s in zip(names, scores)]
            rest = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                rest + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), *also, F.col(text_col).alias("__text"))
    kept = rows.columns[:-1]
    # As types, not as text: field names of a packed row may hold dots or other signs.
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def learned(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model of the rows where ``usable`` holds and text and language are known."""
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    return fit(*sampled(rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")), per_language))


def recognised(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents whose language the model recognises, with all their columns."""
    if len(docs.columns) == 0:
        return docs
    whole = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), column(text_col).alias("__t"))
    found = predicted(whole, model, "row", "__t")
    return found.where("NOT rejected").select("doc_id.*")
