"""Token ids by a public tokenizer, one lookup per word.

The tokenizer ``word_bpe_49k`` drops white space and never joins characters across it, so a
text's ids are the ids of its words in a row. Each Python worker remembers the words it has
seen, also from task to task; a full memory is emptied, so its size is bounded whatever the
data.
"""

from __future__ import annotations

import operator
import os
import re
import sys
import unicodedata
from itertools import compress, repeat
from types import ModuleType

from covaria.llm.text import SPACE_BYTES, slices

#: Words a worker remembers.
REMEMBERED = 600_000
#: Words in a row for the model.
ROW = 200
#: Bytes of text whose words are held as Python objects at a time.
SEGMENT = 2 << 20
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_MARKS = (b".", b",", b";", b":", b"!", b"?")


def segments(raw: bytes, most: int = SEGMENT):
    """A text in parts of about ``most`` bytes, cut at white space only."""
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, min(at + most, len(raw)))
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def _byte_level() -> dict[int, int]:
    """Code points by which byte-level models write bytes: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(rest) if b != 10}  # line feeds part the words


_BYTE_LEVEL = _byte_level()


def split_words(raws: list[bytes]):
    """The words of all texts in a row, and how many each text has."""
    import numpy as np

    joined = b"\n".join(raws) + b"\n"
    space = np.zeros(256, bool)
    space[list(SPACE_BYTES)] = True
    blank = space[np.frombuffer(joined, np.uint8)]
    begins = ~blank
    begins[1:] &= blank[:-1]
    ends = np.cumsum([len(raw) + 1 for raw in raws])
    return joined.split(), np.diff(np.searchsorted(np.flatnonzero(begins), ends), prepend=0)


class WordIds:
    """Ids of words, and of whole texts.

    Words of letters alone need no normalising or splitting; they go to the tokenizer's model
    in rows of many. A last punctuation mark after ASCII letters is a piece of its own. All other words go through the whole tokenizer.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import numpy as np

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self._np, self._most = np, remembered
        whole = Tokenizer.from_file(path)
        self._encode = whole.encode_batch_fast
        rows = Tokenizer(whole.model)
        rows.pre_tokenizer = WhitespaceSplit()
        self._encode_rows = rows.encode_batch_fast
        vocabulary = whole.get_vocab(with_added_tokens=False)
        self._closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self._closes[[k for piece, k in vocabulary.items() if piece.endswith("</w>")]] = True
        self._marks = {m: self._encode([m.decode()], add_special_tokens=False)[0].ids for m in _MARKS}
        self.listen()
        self._clear()

    def listen(self, on_learn=None, on_forget=None) -> None:
        """``on_learn(words)`` is told of words as they get the next numbers, ``on_forget()``
        before all numbers become void."""
        self._on_learn, self._on_forget = on_learn, on_forget

    def _clear(self) -> None:
        self._index: dict[bytes, int] = {}
        self._words: list[bytes] = []
        self._flat = self._np.zeros(1 << 16, self._np.uint32)
        self._starts = self._np.zeros(1 << 14, self._np.int64)
        self._sizes = self._np.zeros(1 << 14, self._np.int64)
        self._used = 0

    def _room(self, name: str, size: int) -> None:
        held = getattr(self, name)
        if len(held) < size:
            grown = self._np.zeros(max(size, 2 * len(held)), held.dtype)
            grown[: len(held)] = held
            setattr(self, name, grown)

    def encoded(self, words: list[bytes]) -> tuple[list[bytes], object, object]:
        """The words, those of letters first, their ids in a row, and how many each has."""
        np = self._np
        # All words at once, as text and as the model's characters.
        raw = b"\n".join(words)
        text = raw.decode("utf-8", "replace")
        each = text.split("\n")
        usual = list(map(str.isalpha, each))
        if text.lower() != text or not unicodedata.is_normalized("NFC", text):
            usual = [u and t.lower() == t and unicodedata.is_normalized("NFC", t) for u, t in zip(usual, each)]
        ascii_only = list(map(bytes.isascii, words))
        plain = [w for w, u, a in zip(words, usual, ascii_only) if u and a]
        shown = b"\n".join(plain).decode().split("\n") if plain else []
        wide = [w for w, u, a in zip(words, usual, ascii_only) if u and not a]
        if wide:
            plain += wide
            shown += b"\n".join(wide).decode("latin-1").translate(_BYTE_LEVEL).split("\n")
        others, marked, ends = [], len(plain), []
        for word in compress(words, map(operator.not_, usual)):
            stem = word[:-1]
            if word[-1:] in self._marks and stem.isalpha() and stem.islower():
                plain.append(word)
                shown.append(stem.decode())
                ends.append(word[-1:])
            else:
                others.append(word)
        rows = [" ".join(shown[k : k + ROW]) for k in range(0, len(shown), ROW)]
        found = self._encode_rows(rows, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, np.uint32) for e in found]])
        upto = np.flatnonzero(self._closes[ids]) + 1  # a word's last piece says so
        sizes = np.diff(upto, prepend=0)
        extra = [self._marks[m] for m in ends]
        more = np.array([len(m) for m in extra], np.int64)
        ids = np.insert(ids, np.repeat(upto[marked:], more), np.array([i for m in extra for i in m], np.uint32))
        sizes[marked:] += more
        rest = [e.ids for e in self._encode([w.decode("utf-8", "replace") for w in others], add_special_tokens=False)]
        ids = np.concatenate([ids, np.array([i for own in rest for i in own], np.uint32)])
        return plain + others, ids, np.concatenate([sizes, np.array([len(own) for own in rest], np.int64)])

    def _learn(self, words: list[bytes]) -> None:
        words, ids, sizes = self.encoded(words)
        first = len(self._index)
        self._room("_flat", self._used + len(ids))
        self._room("_starts", first + len(words))
        self._room("_sizes", first + len(words))
        self._index.update(zip(words, range(first, first + len(words))))
        self._words += words
        self._flat[self._used : self._used + len(ids)] = ids
        own = slice(first, first + len(words))
        self._sizes[own] = sizes
        self._starts[own] = self._used + self._np.cumsum(sizes) - sizes
        self._used += len(ids)
        if self._on_learn:
            self._on_learn(words)

    def known(self) -> list[bytes]:
        """The words by number."""
        return self._words

    def numbers(self, words: list[bytes]):
        """The number of each word, until words are forgotten."""
        np = self._np
        k = np.fromiter(map(self._index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(k < 0).tolist()
        if missing:
            unknown = [words[i] for i in missing]
            fresh = set(unknown)
            if len(self._index) + len(fresh) > self._most and self._index:
                if self._on_forget:
                    self._on_forget()
                self._clear()
                self._learn(list(set(words)))
                return np.fromiter(map(self._index.__getitem__, words), np.int64, len(words))
            self._learn(list(fresh))
            k[missing] = np.fromiter(map(self._index.__getitem__, unknown), np.int64, len(unknown))
        return k

    def ids(self, numbers):
        """Ids of numbered words in a row, and how many each word has."""
        np = self._np
        sizes = self._sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._starts[numbers] - ends + sizes, sizes) + np.arange(total)], sizes

    def words(self, words: list[bytes]):
        """Ids of the words in a row, and how many each word has."""
        return self.ids(self.numbers(words))

    def texts(self, raws: list[bytes]):
        """Ids of each text as an array; texts are small enough to be held as words together."""
        np = self._np
        words, counts = split_words(raws)
        ids, sizes = self.words(words)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = upto[np.cumsum(counts)]
        return np.split(ids, ends[:-1])

    def text(self, raw: bytes):
        """Ids of a text of any size, segment by segment."""
        parts = [self.words(part.split())[0] for part in segments(raw)]
        return self._np.concatenate(parts) if parts else self._np.zeros(0, self._np.uint32)


def worker_words(path: str, remembered: int = REMEMBERED) -> WordIds:
    """The worker's memory of words; functions sent to a worker come and go, this stays."""
    place = sys.modules.setdefault("_covaria_words", ModuleType("_covaria_words"))
    if getattr(place, "key", None) != (path, remembered):
        place.key, place.words = (path, remembered), WordIds(path, remembered)
    place.words.listen()
    return place.words


def encoded(raws: list[bytes], encoder: WordIds):
    """Pairs of position and ids of every text, holding the words of a segment at a time."""
    for begin, end in slices(raws, SEGMENT):
        if end - begin == 1:
            yield begin, encoder.text(raws[begin])
        else:
            yield from enumerate(encoder.texts(raws[begin:end]), begin)
