"""Best-fit packing of documents into sequences under several capacities.

A document is its token ids and an end id. Only documents longer than a sequence are cut,
into whole sequences and a rest. Each piece has three demands: tokens, one document, and
attention cost (its length squared); a sequence has a capacity for each. Pieces are placed
in descending order of their weighted demand; each goes to the open sequence that can take
it under every capacity and

    norm  leaves the smallest weighted norm of residual capacities, or
    dot   has the largest weighted dot product of residual capacities and demands.

Pieces are dealt evenly to groups of about ``GROUP``, each packed in one task; rows of any
one document, source or length spread over all groups. A group leaves at most about one
sequence partly filled, so the number of sequences is that of one large packing up to one
in some thousands.

Defined results: a null text counts as empty and has the end id alone. Repeated rows are
packed as often as they occur. Other columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.llm.text import lower_ascii, raw_texts
from covaria.llm.tokens import REMEMBERED, encoded, worker_words
from covaria.operators.durable import stored

GROUP = 20_000
END_ID = 1


def _lowered(raw: bytes) -> bytes:
    """The tokenizer lowers letters anyway, but finds its special tokens before."""
    return raw if b"<|" in raw else lower_ascii(raw)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    most_tokens: int = 4096,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary) of every piece.

    A Python worker keeps the ids of ``remembered`` words: more memory, less work.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encoder = worker_words(tokenizer, remembered)
        for batch in batches:
            rows, numbers, starts, lengths, sums, held = [], [], [], [], [], []
            for k, ids in encoded([_lowered(raw) for raw in raw_texts(batch.column("text"))], encoder):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), most_tokens)):
                    own = ids[start : start + most_tokens].tobytes()
                    rows.append(k)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(len(own) // 4)
                    sums.append(zlib.crc32(own))
                    if with_ids:
                        held.append(own)
            columns = [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ] + ([pa.array(held, pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_fit(lengths, capacities, weights=(1.0, 1.0, 1.0), choose: str = "norm"):
    """Sequence number and offset of each piece.

    ``capacities`` bounds tokens, documents and attention cost of a sequence; each piece
    alone must fit.
    """
    import numpy as np

    caps, weights = np.array(capacities, float), np.array(weights, float)
    lengths = np.asarray(lengths, np.int64)
    demand = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2]) / caps[:, None]
    if len(lengths) and demand.max() > 1:
        raise ValueError("a piece exceeds a capacity by itself")
    least = demand.min(axis=1) if len(lengths) else None
    number = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    left = np.zeros((3, 1024))  # residual capacities of open sequences, as shares
    ids = np.zeros(1024, np.int64)
    filled: list[int] = []
    n_open = 0
    slack = 1e-12
    for step, item in enumerate(np.argsort(-(weights @ demand), kind="stable").tolist()):
        need = demand[:, item]
        if step % 128 == 0 and n_open:  # sequences that not even the smallest demands fit are closed
            alive = np.flatnonzero((left[:, :n_open] >= least[:, None] - slack).all(axis=0))
            left[:, : len(alive)], ids[: len(alive)] = left[:, alive], ids[alive]
            n_open = len(alive)
        free = left[:, :n_open] - need[:, None]
        fits = free[0] >= -slack
        fits &= free[1] >= -slack
        fits &= free[2] >= -slack
        at = np.flatnonzero(fits)
        if len(at):
            if choose == "norm":
                best = at[np.argmin(weights @ (free[:, at] ** 2))]
            else:
                best = at[np.argmax((weights * need) @ left[:, at])]
        else:
            if n_open == len(ids):
                left = np.concatenate([left, np.zeros_like(left)], axis=1)
                ids = np.concatenate([ids, np.zeros_like(ids)])
            best = n_open
            left[:, best], ids[best] = 1.0, len(filled)
            filled.append(0)
            n_open += 1
        left[:, best] -= need
        number[item] = ids[best]
        offset[item] = filled[ids[best]]
        filled[ids[best]] += int(lengths[item])
    return number, offset


def placed(
    rows: DataFrame,
    most_tokens: int = 4096,
    most_documents: int | None = None,
    most_cost: float | None = None,
    weights=(1.0, 0.0, 0.0),
    choose: str = "norm",
    group: int = GROUP,
) -> DataFrame:
    """``rows`` (with length) and the sequence_id and offset of each.

    Without bounds on documents and cost these are as many as tokens and their square, which
    no sequence of ``most_tokens`` tokens exceeds.
    """
    capacities = (most_tokens, most_documents or most_tokens, most_cost or float(most_tokens) ** 2)
    groups = max(1, ceil(rows.count() / group))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        number, offset = best_fit(table.column("length").to_numpy(), capacities, weights, choose)
        first = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(number + first, pa.int64()))
        yield from table.append_column("offset", pa.array(offset, pa.int64())).to_batches()

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", sequence_id bigint, offset bigint"
    return rows.repartition(groups).mapInArrow(run, schema)


def packed(docs: DataFrame, tokenizer: str, most_tokens: int = 4096, with_ids: bool = False, **options) -> DataFrame:
    """Every piece of every document and its place; ``options`` as for ``placed``."""
    names = {k: options.pop(k) for k in ("id_col", "text_col", "end_id", "remembered") if k in options}
    return placed(stored(pieces(docs, tokenizer, most_tokens, with_ids=with_ids, **names)), most_tokens, **options)


def sequences(rows: DataFrame) -> DataFrame:
    """sequence_id and ids (little-endian, 4 bytes each) of every sequence of ``packed(with_ids=True)``."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    together = F.aggregate(own, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.groupBy("sequence_id").agg(together.alias("ids"))
