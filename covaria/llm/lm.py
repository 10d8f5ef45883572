"""LM scoring: base word counts and a causal self-attention model over subword ids.

Two passes read the texts, ASCII letters lowered; the second alone cuts them into ids.

1. Counting, over all training documents: words and ends of text. Each task counts before the
   shuffle. Every distinct word is then cut into subword ids once, and pairs of neighbouring
   ids are counted as often as their words occur; what follows a word is the start of the
   next or the end. Per id and class the counts go to the driver, a bounded number.
2. Reading, over all documents, those of any length: their windows are written once, for
   training and for scoring, and beside them figures of each document's words. The ``HEAD``
   most frequent words (or slightly fewer) are sent to the tasks with their counts, a fixed
   number of short words; a document's other words, each rare by construction, leave the task
   as (row, word, times) and are joined with the counts by a shuffle.

The stored windows are then read without the texts, the tokenizer or the words.

3. Training, over all windows of training documents, in ``ROUNDS`` rounds, each window in one
   of them. In a round every task goes through its own windows from the same weights; sums of
   weights, a fixed size, are added up by tasks and reach the driver. Small corpora are read up
   to ``TRAIN_PASSES`` times. The result depends a little on how rows are dealt to tasks.
4. Scoring, over all windows (see ``attention``): what a document's windows add to its score is
   summed by its row number. Pairs of ids beyond the ``HEAD_PAIRS`` most frequent are joined
   with their counts by a shuffle.

Defined results: a null text counts as empty and has the end alone. Repeated rows get equal
scores. Without training documents every count is zero. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.llm import attention
from covaria.llm.text import lower_ascii, raw_texts, slices
from covaria.llm.tokens import WordIds, segments, split_words, worker_words
from covaria.operators.durable import stored

#: Ids of the tokenizer, and the one that ends a text; the start of a word has the next number.
IDS = 49_408
END = 49_407
#: In pair counts, what follows a word's last id.
WORD_END = -1
HEAD = 1 << 18
LONGEST_HEAD = 32
#: Words that a worker remembers, and words that it counts before it passes counts on.
WORDS, COUNTED = 600_000, 500_000
#: Pairs of ids whose counts are sent to the tasks.
HEAD_PAIRS = 1 << 20
#: Corpora with fewer steps than this are read again.
TRAIN_STEPS = 3_000
#: Times that training reads each window at most, windows of one step, rounds of one reading.
TRAIN_PASSES, TRAIN_BATCH, ROUNDS = 4, 128, 4
RATE = 0.01
#: Windows written in one row, and what marks that nothing follows.
PIECE, NOTHING = 1 << 14, 65_535
SEED = 13
#: Bytes of text whose words a task holds at a time.
SLICE = 1 << 20
#: The end of a text among words; no word holds white space.
END_WORD = b"\n"


def _token_slices(raws: list[bytes], encoder: WordIds):
    """Ranges of texts with their words' numbers by text; very long texts come alone, in parts."""
    import numpy as np

    for begin, end in slices(raws, SLICE):
        if end - begin > 1:
            words, counts = split_words([lower_ascii(raw) for raw in raws[begin:end]])
            yield begin, end, [(encoder.numbers(words), counts)]
        else:
            yield begin, end, (
                (encoder.numbers(words), np.array([len(words)]))
                for part in segments(lower_ascii(raws[begin]), SLICE)
                for words in [part.split()]
            )


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word and n: partial counts of words, and of ends of text under ``END_WORD``."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        counts: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_pydict({
                "word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64()),
            })
            counts.clear()
            return batch

        for batch in batches:
            raws = raw_texts(batch.column("text"))
            counts[END_WORD] += len(raws)
            for begin, end in slices(raws, SLICE):
                for part in segments(b"\n".join(raws[begin:end]), SLICE):
                    counts.update(lower_ascii(part).split())
                if len(counts) > COUNTED:
                    yield flush()
        yield flush()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n bigint")


def paired(counts: DataFrame, tokenizer: str) -> DataFrame:
    """a, b, n: partial counts of pairs of ids inside words, from ``counts`` (word, c).

    ``IDS`` before a word's first id, ``WORD_END`` after its last.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encoder = worker_words(tokenizer, WORDS)
        width = IDS + 2
        pairs: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def added():
            codes, inverse = np.unique(np.concatenate([c for c, _ in pairs]), return_inverse=True)
            return codes, np.bincount(inverse, np.concatenate([n for _, n in pairs]), len(codes)).astype(np.int64)

        for batch in batches:
            words = batch.column("word").to_pylist()
            n = batch.column("c").to_numpy(zero_copy_only=False)
            if END_WORD in words:  # the end of a text has no ids of its own
                pairs.append((np.array([IDS * width + END + 1]), n[[words.index(END_WORD)]]))
                n = n[[w != END_WORD for w in words]]
                words = [w for w in words if w != END_WORD]
            for at in range(0, len(words), 50_000):
                some, own = words[at : at + 50_000], n[at : at + 50_000]
                known, ids, sizes = encoder.encoded(some)
                place = {w: k for k, w in enumerate(some)}
                own = own[np.fromiter(map(place.__getitem__, known), np.int64, len(known))]
                ends = np.cumsum(sizes)
                # A start before each word and an end after it; a word without ids is nothing.
                flat = np.insert(ids.astype(np.int64), ends - sizes, IDS)
                before = flat
                after = np.append(flat[1:], WORD_END)
                after[after == IDS] = WORD_END
                use = np.repeat(own, sizes + 1)
                keep = (before != IDS) | (after != WORD_END)
                pairs.append((before[keep] * width + after[keep] + 1, use[keep]))
                if sum(len(c) for c, _ in pairs) > 2_000_000:
                    pairs[:] = [added()]
        codes, times = added()
        yield pa.RecordBatch.from_pydict({
            "a": pa.array((codes // width).astype(np.int32)), "b": pa.array((codes % width - 1).astype(np.int32)),
            "n": pa.array(times),
        })

    return counts.select("word", "c").mapInArrow(run, "a int, b int, n bigint")


def _first(table: DataFrame, value: Column, most: int) -> DataFrame:
    """Rows of ``table`` with the smallest positive values: nearly ``most`` of them, never more.

    The bound is found from a histogram of the values' logarithms, so that nothing is sorted
    and only the rows chosen go on.
    """
    place = F.floor(F.log2(value) * 16)
    sizes = sorted((r["place"], r["count"]) for r in table.groupBy(place.alias("place")).count().collect())
    total, bound = 0, None
    for at, n in sizes:  # at most some thousand classes
        if total + n > most:
            bound = at
            break
        total += n
    return table if bound is None else table.where(place < bound)


def statistics(pairs: DataFrame, vocabulary: int) -> attention.Statistics:
    """What the model takes from the whole corpus."""
    import numpy as np

    ids = np.zeros(IDS)
    for r in pairs.where(f"b <> {WORD_END}").groupBy("b").agg(F.sum("n").alias("n")).collect():  # one row per id
        ids[r["b"]] = r["n"]
    number = attention.numbered(ids, vocabulary)
    size = int(number.max()) + 1
    spark = pairs.sparkSession
    names = spark.createDataFrame(
        [(i, int(number[i])) for i in np.flatnonzero(number < size - 1).tolist()] + [(IDS, size), (WORD_END, -1)],
        "id int, number int",
    )
    named = lambda side: F.coalesce(F.col(f"{side}.number"), F.lit(size - 1))
    joined = pairs.join(F.broadcast(names).alias("x"), F.col("a") == F.col("x.id"), "left").join(
        F.broadcast(names).alias("y"), F.col("b") == F.col("y.id"), "left"
    )  # one row per number of the vocabulary
    table = joined.groupBy(named("x").alias("a"), named("y").alias("b")).agg(F.sum("n").alias("n")).collect()
    return attention.statistics(ids, [(r["a"], r["b"], r["n"]) for r in table], IDS, number)


def by_id(pairs: DataFrame, number, rest: int, most: int) -> attention.Pairs:
    """Pair counts of all ids; ``pairs`` has a, b, n once per pair, ``number`` the number of each id."""
    import numpy as np

    def summed(rows: DataFrame, key: str, size: int):
        table = rows.groupBy(key).agg(F.sum("n").alias("n")).toArrow()  # one row per id
        out = np.zeros(size)
        out[table["a" if key == "a" else "b"].to_numpy()] = table["n"].to_numpy()
        return out

    inner = pairs.where(f"b <> {WORD_END}")
    classes = pairs.sparkSession.createDataFrame(
        [(i, int(number[i])) for i in np.flatnonzero(number < rest).tolist()], "id int, class int"
    )
    named = inner.join(F.broadcast(classes), F.col("b") == F.col("id"), "left").withColumn("c", F.coalesce("class", F.lit(rest)))
    cells = named.groupBy("a", "c").agg(F.sum("n").alias("n")).toArrow()  # at most ids x classes, whatever the corpus
    by_class = np.zeros((IDS + 1, rest + 1))
    by_class[cells["a"].to_numpy(), cells["c"].to_numpy()] = cells["n"].to_numpy()
    last = named.where(f"c = {rest}").select("a", "b", "n")
    frequent = _first(last, 1.0 / F.col("n"), most)
    table = frequent.toArrow()
    codes = table["a"].to_numpy().astype(np.int64) << 32 | table["b"].to_numpy()
    order = np.argsort(codes)
    return attention.Pairs.of(
        summed(inner, "b", IDS), summed(inner.where(f"a = {IDS}"), "b", IDS), summed(pairs.where(f"b = {WORD_END}"), "a", IDS + 1),
        by_class, number, rest, codes[order], table["n"].to_numpy()[order], frequent is last,
    )


class _TextIds:
    """Ids of a slice's texts in a row, each text's end included, put together part by part."""

    def __init__(self, encoder: WordIds, texts: int):
        import numpy as np

        self._encoder, self._texts, self._ids, self._sizes = encoder, texts, [], np.zeros(texts, np.int64)

    def add(self, numbers, counts) -> None:
        import numpy as np

        own, each = self._encoder.ids(numbers)
        stops = np.concatenate([[0], np.cumsum(each)])[np.cumsum(counts)]
        self._sizes += np.diff(stops, prepend=0)
        self._ids.append(np.insert(own.astype(np.int64), stops, END) if self._texts > 1 else own)

    def whole(self):
        """The ids, and how many each text has."""
        import numpy as np

        ids = [*self._ids, [END]] if self._texts == 1 else self._ids
        return np.concatenate(ids).astype(np.int64), self._sizes + 1


def _pieces(ids, sizes, first: int, random):
    """Windows of texts in a row in pieces, those of each round apart, and the texts' row numbers."""
    import numpy as np

    some, following = attention.cut_flat(ids, sizes, IDS, IDS + 1)
    following[attention.beyond(sizes)] = NOTHING
    rows = np.concatenate([some, following], axis=1, dtype=np.uint16, casting="unsafe")
    owner = first + np.repeat(np.arange(len(sizes)), -(-sizes // attention.STRIDE))
    order = random.permutation(len(rows))
    for at in range(0, len(rows), PIECE):
        own = order[at : at + PIECE]
        # Few windows are dealt to random rounds, so that the first gets no more than others.
        turn = int(random.integers(ROUNDS))
        parts = [own[(k + turn) % ROUNDS :: ROUNDS] for k in range(ROUNDS)]
        yield len(own), [(rows[part].tobytes(), owner[part].tobytes()) for part in parts]


def read(docs: DataFrame, tokenizer: str, head: dict[bytes, int], also: list[str]) -> DataFrame:
    """All texts read once: rows of documents (``trained``, ``also``, row and figures of words) and
    of windows (``row`` null).

    A document has its number of words, how many of them are frequent, the sum of these ones'
    logarithms, and its other words. A row of windows has their number n, whether they are learned
    from, and, as bytes, in ``w0``, ``w1``, ... those of each round and in ``o0``, ``o1``, ... their
    documents' rows. A window is its ids and what follows in its second half, 16 bits each.
    """
    import pyarrow as pa
    from pyspark import SparkContext

    context: SparkContext = docs.sparkSession.sparkContext
    # As bytes pickled with their code, so that workers need no copy of this package.
    sent = context.broadcast(pickle.dumps(head))
    tail = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
    rows = docs.select("trained", *also, "text")
    kept = rows.columns[1:-1]
    figures_of = {"row": pa.int64(), "n_words": pa.int64(), "n_head": pa.int64(), "head_log": pa.float64(), "tail": tail}
    bytes_of = {f"{c}{k}": pa.binary() for k in range(ROUNDS) for c in "wo"}
    names = ["trained", *kept, *figures_of, "n", *bytes_of]

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        head = pickle.loads(sent.value)
        count, used = np.zeros(1 << 14, np.int64), 0

        def learn(words):
            nonlocal count, used
            upto = used + len(words)
            if len(count) < upto:
                count = np.concatenate([count, np.zeros(max(upto, len(count)), np.int64)])
            count[used:upto] = [head.get(w, -1) for w in words]
            used = upto

        def forget():
            nonlocal used
            used = 0

        def figures(numbers, counts, into):
            """Add a part's words to the figures of its texts; ``counts`` words each."""
            owner = np.repeat(np.arange(len(counts)), counts)
            times = count[numbers]
            frequent = times >= 0
            into[0] += counts
            into[1] += np.bincount(owner, frequent, len(counts)).astype(np.int64)
            into[2] += np.bincount(owner, np.where(frequent, np.log10(np.maximum(times, 0) + 0.5), 0), len(counts))
            pairs, n = np.unique((owner[~frequent] << 32) | numbers[~frequent], return_counts=True)
            names = encoder.known() if len(pairs) else []
            into[3] += np.bincount(pairs >> 32, minlength=len(counts))
            return [names[k] for k in (pairs & (2**32 - 1)).tolist()], n

        encoder = worker_words(tokenizer, WORDS)
        learn(encoder.known())
        encoder.listen(learn, forget)
        row = TaskContext.get().partitionId() << 33
        randoms = {trained: np.random.default_rng(SEED) for trained in (True, False)}

        def found(docs, trained, raws, parts):
            """Rows of a slice of documents and of their windows."""
            size = len(raws)
            into = [np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size), np.zeros(size, np.int64)]
            held, words, times = _TextIds(encoder, size), [], [np.zeros(0, np.int64)]
            for numbers, counts in parts:
                held.add(numbers, counts)
                some, n = figures(numbers, counts, into)
                words += some
                times.append(n)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(into[3])).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(np.concatenate(times))], fields=list(tail.value_type)),
            )
            yield pa.RecordBatch.from_arrays(
                [docs.column("trained"), *[docs.column(c) for c in kept], pa.array(np.arange(row, row + size)),
                 *[pa.array(v) for v in into[:3]], lists, pa.nulls(size, pa.int64()), *[pa.nulls(size, t) for t in bytes_of.values()]],
                names=names,
            )
            for n, own in _pieces(*held.whole(), row, randoms[trained]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([trained]), *[pa.nulls(1, docs.column(c).type) for c in kept], *[pa.nulls(1, t) for t in figures_of.values()],
                     pa.array([n]), *[pa.array([b], pa.binary()) for pair in own for b in pair]],
                    names=names,
                )

        try:
            for batch in batches:
                flags = np.array(batch.column("trained").fill_null(False))
                for trained in (True, False):
                    docs = batch.take(pa.array(np.flatnonzero(flags == trained)))
                    raws = raw_texts(docs.column("text"))
                    for begin, end, parts in _token_slices(raws, encoder):
                        yield from found(docs.slice(begin, end - begin), trained, raws[begin:end], parts)
                        row += end - begin
        finally:
            encoder.listen()  # the worker keeps its words, but not the counts of this task

    own = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    more = ", ".join(f"{c} binary" for c in bytes_of)
    return rows.mapInArrow(
        run, f"{own}, row bigint, n_words bigint, n_head bigint, head_log double, tail array<struct<word:binary,n:bigint>>, n bigint, {more}"
    )


def windows(docs: DataFrame, tokenizer: str) -> DataFrame:
    """All windows of all texts, as ``read`` gives them."""
    rows = read(docs.select(F.lit(True).alias("trained"), "text"), tokenizer, {}, [])
    return rows.where("row IS NULL").select("n", *[f"w{k}" for k in range(ROUNDS)])


def _batches(pieces, model: attention.Model, size: int):
    """Batches for ``model`` from windows as bytes; what is left of a piece goes with the next."""
    import numpy as np

    names, width = model.named(), attention.WINDOW + attention.STRIDE
    rest = np.zeros((0, width), np.uint16)

    def batch(rows):
        ids, after = rows[:, : attention.WINDOW].astype(np.int64), rows[:, attention.WINDOW :].astype(np.int64)
        following = np.where(after == NOTHING, -1, model.number[np.minimum(after, IDS - 1)])
        return names[ids], following, ids[:, attention.STRIDE :]

    for piece in pieces:
        rest = np.concatenate([rest, np.frombuffer(piece, np.uint16).reshape(-1, width)])
        whole = len(rest) - len(rest) % size
        for at in range(0, whole, size):
            yield batch(rest[at : at + size])
        rest = rest[whole:]
    if len(rest):
        yield batch(rest)


def train(model: attention.Model, table: DataFrame, steps: int) -> None:
    """Train the weights over all of ``windows``."""
    import numpy as np

    n, parts = table.agg(F.sum("n")).first()[0] or 0, table.rdd.getNumPartitions()
    if not n:
        return
    context = table.sparkSession.sparkContext
    # As bytes pickled with their code, so that workers need no copy of this package.
    base = context.broadcast(cloudpickle.dumps(model))
    passes = min(max(1, steps * TRAIN_BATCH // n), TRAIN_PASSES)
    groups = max(1, round(parts**0.5))

    def task(column, weights, rate):
        def run(batches):
            import pyarrow as pa
            from pyspark import TaskContext

            own = pickle.loads(base.value)
            own.weights = pickle.loads(weights.value)
            pieces = (p.as_buffer() for b in batches for p in b.column(column))
            seen = own.learn(_batches(pieces, own, TRAIN_BATCH), rate)
            total = b"".join((w.astype(np.float64) * seen).tobytes() for w in own.weights.values())
            if seen:
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([TaskContext.get().partitionId() % groups]), "n": pa.array([seen]), "total": pa.array([total])}
                )

        return run

    def added(batches):
        import pyarrow as pa

        seen, total = 0, 0
        for b in batches:
            for n, t in zip(b.column("n").to_pylist(), b.column("total").to_pylist()):
                seen, total = seen + n, total + np.frombuffer(t)
        if seen:
            yield pa.RecordBatch.from_pydict({"n": pa.array([seen]), "total": pa.array([total.tobytes()])})

    for turn in range(passes * ROUNDS):
        column = f"w{turn % ROUNDS}"
        weights = context.broadcast(pickle.dumps(model.weights))
        run = task(column, weights, RATE * (1 - turn / (passes * ROUNDS)))
        sums = table.select(column).mapInArrow(run, "part bigint, n bigint, total binary")
        sums = sums.repartition(groups, "part").select("n", "total").mapInArrow(added, "n bigint, total binary")
        rows = sums.collect()  # about as many as the root of the number of tasks
        seen = sum(r["n"] for r in rows)
        flat = sum((np.frombuffer(r["total"]) for r in rows), np.zeros(1)) / max(seen, 1)
        at = 0
        for name, w in model.weights.items() if seen else ():
            model.weights[name] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
        weights.destroy()
    base.destroy()


def fitted(learned: DataFrame, pairs: DataFrame, vocabulary: int, steps: int, head_pairs: int) -> attention.Model:
    """The attention model trained on all windows of ``learned``."""
    stats = statistics(pairs, vocabulary)
    model = attention.Model(stats)
    model.pairs = by_id(pairs, stats.number, model.rest, head_pairs)
    model.prior = model.inside = None  # counts by number are of no use then
    train(model, learned, steps)
    return model


def _scores(table: DataFrame, model: attention.Model) -> DataFrame:
    """row, score, links: what the windows of a row of ``table`` add to the scores of documents."""
    import pyarrow as pa
    from pyspark import SparkContext

    context: SparkContext = table.sparkSession.sparkContext
    # As bytes pickled with their code, so that workers need no copy of this package.
    sent = context.broadcast(cloudpickle.dumps(model))
    linked = pa.list_(pa.struct([("code", pa.int64()), ("n", pa.int64()), ("added", pa.float64())]))

    def run(batches):
        import numpy as np

        model = pickle.loads(sent.value)
        for batch in batches:
            for k in range(batch.num_rows):
                piece = [[batch.column(f"{c}{r}")[k].as_buffer() for r in range(ROUNDS)] for c in "wo"]
                windows = np.concatenate([np.frombuffer(b, np.uint16) for b in piece[0]])
                windows = windows.reshape(-1, attention.WINDOW + attention.STRIDE).astype(np.int64)
                rows, owner = np.unique(np.concatenate([np.frombuffer(b, np.int64) for b in piece[1]]), return_inverse=True)
                following = windows[:, attention.WINDOW :]
                following[following == NOTHING] = -1
                scores, (own, *pairs) = model.score_windows(windows[:, : attention.WINDOW], following, owner, len(rows))
                links = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(np.bincount(own, minlength=len(rows)))).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(p) for p in pairs], fields=list(linked.value_type)),
                )
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(scores), links], names=["row", "score", "links"])

    return table.select(*[f"{c}{r}" for r in range(ROUNDS) for c in "wo"]).mapInArrow(
        run, "row bigint, score double, links array<struct<code:bigint,n:bigint,added:double>>"
    )


def scored(
    docs: DataFrame,
    trains: Column,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int = attention.VOCABULARY,
    steps: int = TRAIN_STEPS,
    head_words: int = HEAD,
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """One row per document: doc_id, trained, n_tokens, n_known, train_tokens, base_score, score.

    ``trains`` says which documents are learned from.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), trains.alias("trained"))
    learned = named.where("trained").select("text")
    counts = stored(counted(learned).groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"))
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    total = total or 0
    ends = counts.where(F.col("word") == F.lit(END_WORD)).first()
    end_count = ends["c"] if ends else 0
    pairs = stored(paired(counts, tokenizer).groupBy("a", "b").agg(F.sum("n").alias("n")))
    short = counts.where(F.octet_length("word") <= LONGEST_HEAD)
    frequent = _first(short, 1.0 / F.col("c"), head_words)
    known = frequent.select("word", "c").toArrow()
    head = dict(zip(known["word"].to_pylist(), known["c"].to_pylist()))
    table = stored(read(named, tokenizer, head, ["doc_id"]))
    found, cuts = table.where("row IS NOT NULL"), table.where("row IS NULL")
    model = fitted(cuts.where("trained"), pairs, vocabulary, steps, head_pairs)
    parts = stored(_scores(cuts, model))
    words = found.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    rest = (
        words.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_log"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("n_tail"),
        )
    )
    held = pairs.where(f"b <> {WORD_END}").select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("code"), F.col("n").alias("held"))
    more = (
        parts.select("row", F.explode("links").alias("t")).select("row", "t.*").join(held, "code")
        .groupBy("row").agg(F.sum(F.col("n") * F.log10(1 + F.col("held") / F.col("added"))).alias("more"))
    )
    size = F.log10(F.lit(float(total)) + 0.5 * (distinct + 1))
    n_tokens = F.col("n_words") + 1
    end_log = F.log10(F.lit(end_count + 0.5))
    scores = parts.groupBy("row").agg(F.sum("score").alias("score"))
    documents = found.select("doc_id", "trained", "row", "n_words", "n_head", "head_log")
    return documents.join(scores, "row").join(rest, "row", "left").join(more, "row", "left").select(
        "doc_id",
        "trained",
        n_tokens.alias("n_tokens"),
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0)) + int(end_count > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) + end_log - n_tokens * size).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
