"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words come from texts: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased (other
letters stay). Where 97 divides the unsigned crc32 of ``<doc_id>:<run>`` (UTF-8; a null id
writes as empty text), the run loses its code point at ``crc % length`` (this plants variants
reproducibly). Words are the distinct results of at least ``shortest`` code points that occur
at least ``least`` times over all texts. Two words are near when one inserted, deleted or
replaced code point turns one into the other.

Near words are found by a bit-sliced position index. Words are indexed in blocks of one length
and one two-letter affix (first two or last two code points): every pair of words one edit
apart (of 5 code points or more) shares its first two or its last two code points, and their
lengths differ by at most one, so a word asks the blocks of its own affixes at its length and
the two beside it. A block keeps, for each (position, letter), the set of its words with that
letter there as a bitset (uint64 words over the block). All words that ask one block are run
at once through word-parallel recurrences over positions: a zero-error set (prefix equal so
far) and a one-error set (one replacement; or, against words one longer or shorter, the
positions shifted by one after an insertion or deletion). The one-error set at the end holds
the near words. Blocks of many words are split by a hash into parts of ``block_words`` words
at most, and so are the words that ask them: one task meets at most ``block_words`` askers and
``block_words`` indexed words, however frequent an affix is.

A word's form is its near word of largest count (ties: smallest in code-point order) if that
count is at least ``2 *`` its own, else null; forms raise counts at every step, so following
them ends. Roots follow forms by pointer doubling (a join a round, log of the chain length).

Defined cases: null texts have no words; empty tables give no rows; long texts and long runs
are read whole; counts are over all rows, repeated ones included; other columns are not read.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.llm.text import BROADCAST_BYTES
from covaria.operators.durable import stored

# Fixed values of the contract: letters of a word, and what is lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
BLOCK_WORDS = 4096
_PAIRS = "word string, near string"


def planted(doc_id: Column, run: Column, every: int = 97) -> Column:
    """The run lower-cased in A-Z, less one code point where ``every`` divides its crc32."""
    low = F.translate(run, UPPER, LOWER)
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), low))
    at = (h % F.length(low)).cast("int")
    cut = F.concat(low.substr(F.lit(1), at), low.substr(at + 2, F.length(low)))
    return F.when(h % every == 0, cut).otherwise(low)


def counted(docs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """word, n: words of all texts of at least ``shortest`` code points and ``least`` occurrences."""
    runs = docs.select(
        F.col("doc_id"), F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(LETTERS), 0)).alias("run")
    )
    words = runs.select(planted(F.col("doc_id"), F.col("run")).alias("word"))
    return (
        words.where(F.length("word") >= shortest)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
    )


class Index:
    """Bitsets per (position, letter) over a block of words of one length."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = len(words[0])
        self.width = (len(words) + 63) // 64
        codes = np.array([[ord(ch) for ch in w] for w in words], dtype=np.int32)
        self.letters = {}
        for p in range(self.length):
            column = codes[:, p]
            for code in np.unique(column):
                self.letters[(p, int(code))] = self._bits(column == code)
        self.all = self._bits(np.ones(len(words), dtype=bool))

    def _bits(self, mask: np.ndarray) -> np.ndarray:
        packed = np.packbits(mask, bitorder="little")
        return np.pad(packed, (0, self.width * 8 - len(packed))).view(np.uint64)

    def _at(self, p: int, codes: np.ndarray) -> np.ndarray:
        """Bitsets of letter ``codes[i]`` at position ``p``, one row per asking word."""
        zero = np.zeros(self.width, dtype=np.uint64)
        distinct, which = np.unique(codes, return_inverse=True)
        table = np.stack([self.letters.get((p, int(code)), zero) for code in distinct])
        return table[which.reshape(-1)]

    def near(self, asking: list[str]) -> list[tuple[str, str]]:
        """Pairs (asking word, indexed word) one edit apart; all asking words have one length."""
        m, n = len(asking[0]), self.length
        codes = np.array([[ord(ch) for ch in w] for w in asking], dtype=np.int32)
        exact = np.broadcast_to(self.all, (len(asking), self.width)).copy()
        one = np.zeros_like(exact)
        for p in range(n):
            if m == n:  # replacement
                match = self._at(p, codes[:, p])
                one = (one & match) | (exact & ~match)
                exact &= match
            elif m == n + 1:  # the asking word has one code point more: w[p] meets q[p] or, shifted, q[p + 1]
                shifted = self._at(p, codes[:, p + 1])
                one = (one & shifted) | (exact & shifted)
                exact &= self._at(p, codes[:, p])
            else:  # m == n - 1: the indexed word has one more; q[p - 1] after an insertion
                grown = (one & self._at(p, codes[:, p - 1])) if p > 0 else np.zeros_like(one)
                one = grown | exact
                exact = exact & self._at(p, codes[:, p]) if p < m else np.zeros_like(exact)
        if m == n + 1:
            one |= exact  # the asking word's last code point deleted
        hits = np.unpackbits(one.view(np.uint8), axis=1, bitorder="little")[:, : len(self.words)]
        rows, cols = np.nonzero(hits)
        return [(asking[r], self.words[c]) for r, c in zip(rows, cols)]


def _near(index: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one block. A pair whose words share their first two code points is left to the
    block of that prefix, so that every pair comes out once and needs no distinct."""
    if index.empty or asking.empty:
        return pd.DataFrame({"word": [], "near": []})
    built = Index(index["indexed"].tolist())
    pairs = []
    for _, same in asking.groupby(asking["word"].str.len()):
        pairs += built.near(same["word"].tolist())
    if index["family"].iloc[0] == "s":
        pairs = [(q, w) for q, w in pairs if q[:2] != w[:2]]
    return pd.DataFrame(pairs, columns=["word", "near"])


def _keys(word: Column, lengths: list[int]) -> Column:
    """The blocks a word is indexed in (offset 0) or asks (offsets -1, 0, 1): family, affix, length."""
    size = F.length(word)
    return F.array(*[
        F.struct(F.lit(family).alias("family"), affix.alias("affix"), (size + d).alias("size"))
        for family, affix in (("p", word.substr(F.lit(1), F.lit(2))), ("s", word.substr(size - 1, F.lit(2))))
        for d in lengths
    ])


def pairs(vocab: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, near: every ordered pair of distinct words of ``vocab`` one edit apart."""
    index = vocab.select(F.col("word").alias("indexed"), F.explode(_keys(F.col("word"), [0])).alias("k")).select("indexed", "k.*")
    asking = vocab.select("word", F.explode(_keys(F.col("word"), [-1, 0, 1])).alias("k")).select("word", "k.*")
    key = ["family", "affix", "size"]
    sizes = (
        index.groupBy(*key).agg(F.count("*").alias("ni"))
        .join(asking.groupBy(*key).agg(F.count("*").alias("na")), key)
        .select(*key, F.ceil(F.col("ni") / block_words).alias("parts_i"), F.ceil(F.col("na") / block_words).alias("parts_a"))
    )
    # A row holds a letter, two code points, and three numbers: 64 bytes bound it.
    sizes = stored(sizes)
    if sizes.count() * 64 <= BROADCAST_BYTES:
        sizes = F.broadcast(sizes)
    index = index.join(sizes, key).select(
        "indexed", *key,
        F.pmod(F.xxhash64("indexed", F.lit(1)), F.col("parts_i")).cast("long").alias("part_i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts_a") - 1)).alias("part_a"),
    )
    asking = asking.join(sizes, key).select(
        "word", *key,
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts_i") - 1)).alias("part_i"),
        F.pmod(F.xxhash64("word", F.lit(2)), F.col("parts_a")).cast("long").alias("part_a"),
    )
    group = [*key, "part_i", "part_a"]
    found = index.groupBy(*group).cogroup(asking.groupBy(*group)).applyInPandas(_near, _PAIRS)
    return found


def _rooted(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the end by pointer doubling."""
    up = stored(forms.select("word", F.coalesce("form", "word").alias("up")))
    while True:
        step = up.alias("a").join(up.alias("b"), F.col("a.up") == F.col("b.word")).select(
            F.col("a.word").alias("word"), F.col("a.up").alias("old"), F.col("b.up").alias("up")
        )
        step = stored(step)
        if step.where(F.col("old") != F.col("up")).limit(1).count() == 0:
            return step.select("word", F.col("up").alias("root"))
        up = step.select("word", "up")


def grouped(docs: DataFrame, shortest: int = 5, least: int = 3, ratio: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (needs ``doc_id`` and ``text``).

    Blocks by two-letter affixes find every near pair only among words of 4 code points or more.
    """
    if shortest < 4:
        raise ValueError("near words are blocked by two-letter affixes: shortest must be 4 or more")
    vocab = stored(counted(docs, shortest, least))
    linked = pairs(vocab, block_words)
    counts = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        linked.join(counts, "near")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near").alias("near"))).alias("top"))
    )
    forms = stored(
        vocab.join(best, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("top.neg") >= ratio * F.col("n"), F.col("top.near")).alias("form"),
            F.when(-F.col("top.neg") >= ratio * F.col("n"), -F.col("top.neg")).cast("long").alias("form_n"),
        )
    )
    roots = _rooted(forms)
    return forms.join(roots, "word").select("word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n")
