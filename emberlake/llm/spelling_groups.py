"""Spelling variants by reduced alphabets: near words have near reductions, so candidates meet on reduced words.

Letters are hashed to a few symbols. Two words that differ by one inserted, deleted or replaced letter reduce to words
that are equal or differ by one such step, so the neighbourhoods of one edit of all reduced words (and they themselves) are
joined with the reduced vocabulary, and every pair of words behind a match is verified letter by letter. As two near
words lie in each other's neighbourhood, each edge of it is generated from one of its ends: the longer word deletes what
the shorter would insert, and the lower symbol is replaced by the higher. A reduced word is named by a
polynomial hash, from which the names of all its neighbours follow by arithmetic, so a word of any length costs its
length times the number of symbols, and equal names only ever add candidates.

The number of symbols grows with the vocabulary's logarithm, so that reduced words stay far more than words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import store_once
from emberlake.llm.shingles import mix

#: Fixed values of the word rules: letters of a run, the divisor that marks a slip, the least length and count of a word.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLIP = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


@dataclass(frozen=True)
class SpellingSettings:
    """``ratio``: how many times more frequent a word's form is. ``spare``: see :func:`symbols_for`. ``held_words``:
    distinct words that a task counts before it hands them on."""

    ratio: int = 5
    spare: float = 32.0
    held_words: int = 200_000


def _counted(held_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(RUN.findall((text.as_py() or "").translate(_LOWER))).items():
                    drawn = zlib.crc32(word.encode(), prefix)
                    if drawn % SLIP == 0:
                        at = drawn % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= LEAST_LETTERS:
                        total[word] += n
                if len(total) > held_words:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)
    return run


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def word_counts(docs: DataFrame, settings: SpellingSettings = SpellingSettings()) -> DataFrame:
    """(word, n) of all words that are long and frequent enough. Counts are combined per task before the shuffle."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (texts.mapInArrow(_counted(settings.held_words), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


def symbols_for(words: int, spare: float) -> int:
    """So many symbols that reduced words of the least length are ``spare`` times as many as words."""
    return max(4, int(np.ceil((spare * max(words, 1)) ** (1 / LEAST_LETTERS))))


_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = _U(pow(_BASE, -1, 1 << 64))
_CELLS = 1 << 20


class Reducer:
    """Names of reduced words and of their neighbours."""

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.values = mix(np.arange(1, symbols + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95))

    def _parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words of one length: symbols, powers of the base, and sums of the first i terms."""
        length = len(words[0])
        codes = np.array(words, dtype=f"U{length}").view(np.uint32).reshape(len(words), length).astype(np.uint64)
        symbol = (mix(codes + _U(1)) % _U(self.symbols)).astype(np.int64)
        power = np.cumprod(np.append(_U(1), np.full(length, _BASE, dtype=np.uint64)))
        sums = np.zeros((len(words), length + 1), dtype=np.uint64)
        np.cumsum(self.values[symbol] * power[:length], axis=1, out=sums[:, 1:])
        return symbol, power, sums

    def names(self, words: list[str]) -> np.ndarray:
        return self._named(self._parts(words)[2][:, -1:], len(words[0])).reshape(-1)

    @staticmethod
    def _named(sums: np.ndarray, length: int) -> np.ndarray:
        return mix(sums + _U(length)).view(np.int64)

    def neighbours(self, words: list[str]) -> list[np.ndarray]:
        """For each word the distinct names of its reduction, and of all that one edit makes of that and that don't make
        it themselves: those with a symbol less, or with one replaced by a higher one."""
        length, v = len(words[0]), self.values
        symbol, power, sums = self._parts(words)
        whole = sums[:, -1:]
        deleted = sums[:, :-1] + (whole - sums[:, 1:]) * _INVERSE
        replaced = whole[:, :, None] + (v[None, None, :] - v[symbol][:, :, None]) * power[None, :length, None]
        higher = (np.arange(self.symbols)[None, None, :] > symbol[:, :, None]).reshape(len(words), -1)
        replaced = self._named(replaced.reshape(len(words), -1), length)
        itself, deleted = self._named(whole, length), self._named(deleted, length - 1)
        return [np.unique(np.concatenate([i, d, r[h]])) for i, d, r, h in zip(itself, deleted, replaced, higher)]


def _by_length(words: list[str], symbols: int) -> Iterator[list[int]]:
    """Positions of words of one length, in runs of bounded neighbourhood size."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        where = np.flatnonzero(lengths == length)
        step = max(1, _CELLS // (int(length) * symbols))
        for at in range(0, len(where), step):
            yield where[at:at + step].tolist()


def _reduced(symbols: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reducer = Reducer(symbols)
        for batch in batches:
            words = batch.column("word").to_pylist()
            names = np.zeros(len(words), dtype=np.int64)
            for run_ in _by_length(words, symbols):
                names[run_] = reducer.names([words[i] for i in run_])
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(names)], ["word", "n", "reduced"])
    return run


def _spread(symbols: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reducer = Reducer(symbols)
        for batch in batches:
            words, names = batch.column("word").to_pylist(), batch.column("reduced")
            for run_ in _by_length(words, symbols):
                found = reducer.neighbours([words[i] for i in run_])
                yield pa.RecordBatch.from_arrays([
                    names.take(pa.array(np.repeat(run_, [len(x) for x in found]))), pa.array(np.concatenate(found))], ["reduced", "near"])
    return run


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """(word, near, near_n) for every ordered pair of ``words`` (word, n) that one edit turns into each other."""
    reduced = store_once(words.select("word", "n").mapInArrow(_reduced(symbols), "word string, n long, reduced long"), "reduced")
    # words that reduce alike have one neighbourhood
    vocabulary = reduced.groupBy("reduced").agg(F.min("word").alias("word"))
    around = vocabulary.mapInArrow(_spread(symbols), "reduced long, near long")
    met = around.join(vocabulary.select(F.col("reduced").alias("near")), "near")
    left = reduced.select("reduced", "word", "n", F.length("word").alias("letters"))
    right = reduced.select(F.col("reduced").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"),
                           F.length("word").alias("near_letters"))
    candidates = (met.join(left, "reduced").join(right, "near")
                  .where((F.abs(F.col("letters") - F.col("near_letters")) <= 1) & (F.col("word") != F.col("near_word")))
                  .where((F.col("reduced") != F.col("near")) | (F.col("word") < F.col("near_word"))))
    pairs = candidates.where(F.levenshtein("word", "near_word", 1) == 1)
    both = F.array(F.struct("word", F.col("near_word").alias("near"), "near_n"), F.struct(F.col("near_word").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    # hashed names could name both ends of an edge alike, so a pair may come twice
    return pairs.select(F.inline(both)).distinct()


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): from each word along forms to the last. Steps double, so chains end in log rounds."""
    current = store_once(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        current = store_once(current.join(onward, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        if current.where("moved").isEmpty():
            return current.select("word", "root")


def spelling_groups(docs: DataFrame, settings: SpellingSettings = SpellingSettings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text) by the contract's rules.

    Null and empty texts have no words; a null doc_id counts as empty. Repeated rows count as often as they come. Equal
    frequencies go by code points. A form is at least ``ratio`` times as frequent as its word, so forms form no circle.
    An empty table gives an empty table. Texts and words count whole, whatever their length; other columns are ignored.
    """
    words = store_once(word_counts(docs, settings), "words")
    pairs = near_words(words, symbols_for(words.count(), settings.spare))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("b"))
    strong = -F.col("b.k") >= settings.ratio * F.col("n")
    forms = store_once(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("b.near")).alias("form"), F.when(strong, -F.col("b.k")).alias("form_n")), "forms")
    return forms.join(follow_forms(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
