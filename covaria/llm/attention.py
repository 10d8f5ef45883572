"""A small causal self-attention model over subword ids, in numpy.

The next id is drawn by class: the ``classes - 1`` most frequent ids are classes of their
own, the others share the last. The class has the softmax

    z = W tanh(attention + own + previous) + log p(class | id),

where ``attention`` is masked self-attention over the window with learned queries, keys and
values per id and a learned bias per distance, ``own`` and ``previous`` are vectors of the
last two ids, and p comes from pair counts over the whole corpus, so that training starts
from the pair model. Inside the last class, ids follow the pair counts. With ``Pairs`` both
kinds of counts are by id, all ids apart; without, by number, where all ids outside the
vocabulary are alike and follow their own counts.

Training is local: every task of a round goes through its own windows from the same weights
(``learn``), and the weights that tasks come to are averaged by their numbers of windows.

Texts are cut into windows of ``WINDOW`` ids that overlap by half. Each id is scored once,
in the second half of a window, with at least ``STRIDE`` ids of context where there are as
many. A batch of windows is a few matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

WINDOW, STRIDE = 32, 16
WIDTH = 16
CLASSES = 128
VOCABULARY = 1024
#: Weight of the counts of single ids in the pair model.
PRIOR = 5.0
#: Windows computed at a time.
BATCH = 256
#: Bound on weights, so that exponentials stay within single precision.
BOUND = 4.0


@dataclass(frozen=True)
class Statistics:
    """Counts over the whole corpus.

    ``number`` maps an id to its number: frequent ids from 0, then one number for all others;
    ``within`` is the log probability of an id given its number. ``pairs`` counts (previous,
    next) by number; the last row stands for the start of a word.
    """

    number: object
    within: object
    pairs: object


def statistics(id_counts, pair_counts, n_ids: int, number) -> Statistics:
    """From counts per id and (previous number, next number, count) triples inside words.

    A next number of -1 is the end of a word; then the start of another follows, or the end
    of the text, as often as words start and texts end.
    """
    import numpy as np

    size = int(number.max()) + 1
    within = np.zeros(n_ids)
    other = number == size - 1
    held = id_counts[other] + 0.1
    within[other] = np.log(held / held.sum())
    pairs, ended = np.zeros((size + 1, size)), np.zeros(size + 1)
    for a, b, n in pair_counts:
        if b < 0:
            ended[a] += n
        else:
            pairs[a, b] += n
    start = pairs[size] / max(pairs[size].sum(), 1)
    pairs[:size] += ended[:size, None] * start
    return Statistics(number, within, pairs)


def numbered(id_counts, vocabulary: int = VOCABULARY):
    """Number of each id: by falling count, all beyond the vocabulary alike."""
    import numpy as np

    order = np.argsort(-id_counts, kind="stable")
    number = np.full(len(id_counts), vocabulary - 1, np.int64)
    number[order[: vocabulary - 1]] = np.arange(vocabulary - 1)
    return number


@dataclass(frozen=True)
class Pairs:
    """Pair counts by id; the number of ids stands for the start of a word.

    ``shares`` (rows, classes) has p(class | id), one row for all ids without counts, a row
    of ones for padding last; ``row`` says which row an id has. An id b
    of the last class follows a as often as n(a, b) + ``ended[a] * begins[b]`` +
    ``PRIOR * single[b]`` to ``total[a]``. ``codes`` (sorted, a * 2^32 + b) and ``times`` hold
    n for the frequent pairs; ``complete`` says that these are all there are.
    """

    shares: object
    row: object
    single: object
    begins: object
    ended: object
    total: object
    codes: object
    times: object
    complete: bool

    @staticmethod
    def of(single, begins, ended, by_class, number, rest: int, codes, times, complete: bool) -> Pairs:
        """From single counts, counts at the start and at the end of words, and counts by class."""
        import numpy as np

        single = (single + 0.1) / (single + 0.1).sum()
        begins = begins / max(begins.sum(), 1)
        group = np.minimum(number, rest)
        share = lambda p: np.bincount(group, p, rest + 1)
        table = by_class + ended[:, None] * share(begins) + PRIOR * share(single)
        seen = (by_class.sum(axis=1) > 0) | (ended > 0)
        some = np.append(np.flatnonzero(seen), np.flatnonzero(~seen)[:1])
        row = np.where(seen, np.cumsum(seen) - 1, int(seen.sum()))
        shares = table[some] / table[some].sum(axis=1, keepdims=True)
        shares = np.concatenate([shares, np.ones((1, rest + 1))]).astype(np.float32)
        return Pairs(shares, np.append(row, len(shares) - 1).astype(np.int32), single, begins, ended, table[:, rest].copy(), codes, times, complete)

    def found(self, before, ids):
        """Count of each pair among the frequent ones, -1 if it is not there; what is added to it."""
        import numpy as np

        code = before.astype(np.int64) << 32 | ids
        n = np.full(len(code), 0 if self.complete else -1, np.int64)
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            n = np.where(self.codes[at] == code, self.times[at], n)
        return code, n, self.ended[before] * self.begins[ids] + PRIOR * self.single[ids]


class Model:
    """Tables and weights; ``start`` and ``pad`` are numbers after the vocabulary."""

    #: Pair counts by id; without them, those by number count.
    pairs: Pairs | None = None

    def __init__(self, stats: Statistics, seed: int = 5, classes: int = CLASSES):
        import numpy as np

        size = stats.pairs.shape[1]
        self.number, self.within = stats.number, stats.within
        self.start, self.pad, self.rest = size, size + 1, min(classes, size) - 1
        single = stats.pairs.sum(axis=0) + 0.1
        single /= single.sum()
        p = (stats.pairs + PRIOR * single) / (stats.pairs.sum(axis=1, keepdims=True) + PRIOR)
        grouped = np.concatenate([p[:, : self.rest], p[:, self.rest :].sum(axis=1, keepdims=True)], axis=1)
        logs = np.log(grouped)
        self.prior = np.concatenate([logs, np.zeros((1, logs.shape[1]))]).astype(np.float32)
        inside = np.log(p) - logs[:, -1:]
        inside[:, : self.rest] = 0
        self.inside = inside.astype(np.float32)
        random = np.random.default_rng(seed)
        table = lambda scale: (random.normal(size=(size + 2, WIDTH)) * scale).astype(np.float32)
        self.weights = {
            "query": table(0.3), "key": table(0.3), "value": table(0.3), "own": table(0.3), "previous": table(0.3),
            "distance": np.zeros(WINDOW, np.float32), "out": np.zeros((WIDTH, self.rest + 1), np.float32),
        }
        apart = (np.arange(STRIDE)[:, None] + STRIDE) - np.arange(WINDOW)[None, :]
        self.apart, self.future = np.maximum(apart, 0), np.where(apart < 0, np.float32(-1e9), np.float32(0))
        self.hidden = np.zeros(size + 2, np.float32)
        self.hidden[self.pad] = -1e9

    def forward(self, ids, before=None):
        """For windows (n, WINDOW): scores that the weights give to classes after each id of the
        second half, p(class | id) beside them, and steps.

        ``before`` has the ids of the second halves where pair counts are by id.
        """
        import numpy as np

        w, late = self.weights, ids[:, STRIDE:]
        q, k, v = w["query"].take(late, 0), w["key"].take(ids, 0), w["value"].take(ids, 0)
        q *= np.float32(WIDTH**-0.5)
        s = q @ k.transpose(0, 2, 1)
        s += w["distance"][self.apart] + self.future
        padded = np.flatnonzero((ids == self.pad).any(axis=1))
        s[padded] += self.hidden.take(ids[padded])[:, None, :]
        np.exp(s, out=s)  # at most exp(BOUND^2 * WIDTH^0.5 + BOUND), as weights are bounded
        share = 1 / (s.reshape(-1, WINDOW) @ np.ones(WINDOW, s.dtype)).reshape(s.shape[0], STRIDE, 1)
        seen = s @ v
        seen *= share
        h = w["own"].take(late, 0)
        h += w["previous"].take(ids[:, STRIDE - 1 : -1], 0)
        h += seen
        np.tanh(h, out=h)
        z = h.reshape(-1, WIDTH) @ w["out"]
        p = np.exp(self.prior.take(late.ravel(), 0)) if before is None else self.pairs.shares.take(self.pairs.row.take(before.ravel()), 0)
        return z, p, (q, k, v, s, share, seen, h)

    def log_probabilities(self, ids, following, before=None):
        """Natural log of the probability of ``following`` (n, STRIDE), by number; with ``before``, of its class."""
        import numpy as np

        z, p, _ = self.forward(ids, before)
        late, target = ids[:, STRIDE:].ravel(), following.ravel()
        at = np.arange(0, z.size, z.shape[1]) + np.minimum(target, self.rest)
        own = z.ravel().take(at) + np.log(p.ravel().take(at))
        np.exp(z, out=z)  # at most exp(WIDTH * BOUND)
        z *= p
        own -= np.log(z @ np.ones(z.shape[1], z.dtype))
        return own if before is not None else own + self.inside.ravel().take(
            np.minimum(late, self.start) * self.inside.shape[1] + target
        )

    def gradients(self, ids, following, before=None):
        """Mean loss of the classes, and its gradient for each weight."""
        import numpy as np

        w = self.weights
        z, p, (q, k, v, s, share, seen, h) = self.forward(ids, before)
        use = ((ids[:, STRIDE:] != self.pad) & (following >= 0)).ravel()
        target = np.minimum(np.maximum(following.ravel(), 0), self.rest)
        np.exp(z, out=z)
        z *= p
        total = z @ np.ones(z.shape[1], z.dtype)
        at = np.arange(0, z.size, z.shape[1]) + target
        own = z.ravel().take(at)
        loss = (np.log(total) - np.log(own))[use].mean()
        z.ravel()[at] = own - total  # divided by ``total``, rows are the gradient of the scores
        scale = (use / (total * use.sum())).astype(z.dtype)[:, None]
        out = {"out": (h.reshape(-1, WIDTH) * scale).T @ z}
        dh = z @ w["out"].T
        dh *= scale
        dh = dh.reshape(h.shape)
        dh *= 1 - h * h
        s *= share
        ds = dh @ v.transpose(0, 2, 1)
        ds -= np.einsum("nij,nij->ni", dh, seen)[:, :, None]
        ds *= s
        apart = np.ones(len(ds), ds.dtype) @ ds.reshape(len(ds), -1)
        out["distance"] = np.bincount(self.apart.ravel(), apart, WINDOW).astype(np.float32)
        dq = ds @ k
        dq *= np.float32(WIDTH**-0.5)
        size = len(w["own"])
        for names, at, d in (
            (("query", "own"), ids[:, STRIDE:], (dq, dh)),
            (("key", "value"), ids, (ds.transpose(0, 2, 1) @ q, s.transpose(0, 2, 1) @ dh)),
            (("previous",), ids[:, STRIDE - 1 : -1], (dh,)),
        ):
            summed = _summed_by(at.ravel(), np.concatenate(d, axis=2).reshape(-1, len(d) * WIDTH), size)
            for name, g in zip(names, np.split(summed, len(d), axis=1)):
                out[name] = g
        return loss, out

    def learn(self, batches, rate: float) -> int:
        """Adam over ``batches`` of (windows, following, before); returns the number of windows.

        Weights, gradients and moments lie in one row each, so that a step is a few passes.
        """
        import numpy as np

        flat = np.concatenate([w.ravel() for w in self.weights.values()])
        upto = np.cumsum([w.size for w in self.weights.values()])
        for (name, w), part in zip(list(self.weights.items()), np.split(flat, upto[:-1])):
            self.weights[name] = part.reshape(w.shape)  # a view of ``flat``
        first, second, held = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
        g, grads = np.zeros_like(flat), {}
        for name, part in zip(self.weights, np.split(g, upto[:-1])):
            grads[name] = part.reshape(self.weights[name].shape)
        seen = 0
        for step, (windows, following, before) in enumerate(batches, 1):
            for name, own in self.gradients(windows, following, before)[1].items():
                grads[name][...] = own
            now = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            first *= np.float32(0.9)
            np.multiply(g, np.float32(0.1), out=held)
            first += held
            g *= g
            g *= np.float32(0.001)
            second *= np.float32(0.999)
            second += g
            np.sqrt(second, out=held)
            held += np.float32(1e-8)
            np.divide(first, held, out=held)
            held *= np.float32(now)
            flat -= held
            if max(flat.max(), -flat.min()) > BOUND:
                np.clip(flat, -BOUND, BOUND, out=flat)
            seen += len(windows)
        return seen

    def named(self):
        """The number of each id, of the start and of padding."""
        import numpy as np

        return np.append(self.number, [self.start, self.pad])

    def score(self, texts) -> list[float]:
        """log10 probability of each text: ids in a row, the end included, each at least one long."""
        import numpy as np

        return self.score_flat(np.concatenate(texts), np.array([len(t) for t in texts], np.int64)).tolist()

    def score_flat(self, ids, sizes):
        """The same for texts that stand in a row, given their sizes."""
        import numpy as np

        windows, following = cut_flat(self.number[ids], sizes, self.start, self.pad)
        outside = np.add.reduceat(self.within[ids], np.cumsum(sizes) - sizes)
        return (self._summed(windows, following, sizes) + outside) / np.log(10)

    def score_by_id(self, ids, sizes):
        """Scores with pair counts by id of texts that stand in a row; see ``score_windows``."""
        import numpy as np

        windows, following = cut_flat(ids, sizes, len(self.number), len(self.number) + 1)
        blocks = -(-sizes // STRIDE)
        following[beyond(sizes)] = -1
        return self.score_windows(windows, following, np.repeat(np.arange(len(sizes)), blocks), len(sizes))

    def score_windows(self, windows, following, owner, texts: int):
        """Sums by ``owner`` (one of ``texts`` for each window) with pair counts by id, and the
        pairs whose counts are not at hand; nothing follows where ``following`` is negative.

        These are scored as if their count n was 0 and come as text, code, times and what is
        added to n: log10(1 + n / added) is to be added to the score for each time.
        """
        import numpy as np

        names, before = self.named(), windows[:, STRIDE:]
        own, last = np.zeros(texts), [np.zeros(0, np.int64)]
        for k in range(0, len(windows), BATCH):
            some, after = windows[k : k + BATCH], following[k : k + BATCH]
            number = self.number[np.maximum(after, 0)]
            logs = self.log_probabilities(names[some], number, before[k : k + BATCH]).reshape(after.shape)
            logs[after < 0] = 0
            own += np.bincount(owner[k : k + BATCH], logs.sum(axis=1, dtype=np.float64), texts)
            last.append(np.flatnonzero((number >= self.rest) & (after >= 0)) + k * STRIDE)
        last = np.concatenate(last)
        owner, before = owner[last // STRIDE], before[last // STRIDE, last % STRIDE]
        code, n, added = self.pairs.found(before, following.ravel()[last])
        own += np.bincount(owner, np.log((np.maximum(n, 0) + added) / self.pairs.total[before]), texts)
        absent = np.flatnonzero(n < 0)
        order = absent[np.lexsort((code[absent], owner[absent]))]
        new = np.ones(len(order), bool)
        new[1:] = (owner[order][1:] != owner[order][:-1]) | (code[order][1:] != code[order][:-1])
        first = order[new]
        times = np.diff(np.append(np.flatnonzero(new), len(order)))
        return own / np.log(10), (owner[first], code[first], times, added[first])

    def _summed(self, windows, following, sizes, before=None):
        """Per text the sum of the log probabilities of what follows in its windows."""
        import numpy as np

        own = np.concatenate([
            self.log_probabilities(
                windows[k : k + BATCH], following[k : k + BATCH], None if before is None else before[k : k + BATCH]
            )
            for k in range(0, len(windows), BATCH)
        ]).astype(np.float64)
        blocks = -(-sizes // STRIDE) * STRIDE
        first = np.cumsum(blocks) - blocks
        own[np.arange(len(own)) - np.repeat(first, blocks) >= np.repeat(sizes, blocks)] = 0
        return np.add.reduceat(own, first)


def _summed_by(at, d, size: int):
    """Sums of the rows of ``d`` by the numbers ``at``, each below ``size``."""
    import numpy as np

    at = at.astype(np.uint16 if size <= 1 << 16 else np.int64)
    order = np.argsort(at, kind="stable")
    at = at[order]
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out = np.zeros((size, d.shape[1]), d.dtype)
    # Complex numbers are pairs that are added up at once.
    two = np.result_type(d.dtype, np.complex64)
    out.view(two)[at[begin]] = np.add.reduceat(d.view(two).take(order, 0), begin)
    return out


def beyond(sizes):
    """Where nothing follows in the second halves of the windows of texts of these ``sizes``."""
    import numpy as np

    blocks = -(-sizes // STRIDE) * STRIDE
    inside = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return (inside >= np.repeat(sizes, blocks)).reshape(-1, STRIDE)


def cut(texts, start: int, pad: int):
    """Windows of each text's numbers, what follows in each second half, and the texts' sizes.

    A window's second half holds the ids (the start first) after which an id is scored.
    """
    import numpy as np

    sizes = np.array([len(t) for t in texts], np.int64)
    return *cut_flat(np.concatenate(texts), sizes, start, pad), sizes


def cut_flat(flat, sizes, start: int, pad: int):
    """Windows and what follows, for texts in a row given by their sizes."""
    import numpy as np

    blocks = -(-sizes // STRIDE)
    spans = (blocks + 1) * STRIDE  # room for a first half before each text
    begin = np.cumsum(spans) - spans
    ids = np.full(int(spans.sum()), pad, np.int64)
    after = np.zeros(int(spans.sum()), np.int64)
    place = np.repeat(begin + STRIDE - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    after[place] = flat
    ids[begin + STRIDE] = start
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(sizes) - 1] = False
    ids[place[inner] + 1] = flat[inner]
    at = np.repeat(begin - np.cumsum(blocks * STRIDE) + blocks * STRIDE, blocks) + np.arange(int(blocks.sum())) * STRIDE
    return ids[at[:, None] + np.arange(WINDOW)], after[at[:, None] + np.arange(STRIDE, WINDOW)]
