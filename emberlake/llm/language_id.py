"""Languages of mixed texts: scripts narrow the candidates of a word, and Viterbi labels spans of words.

Every word, a run of letters, is scored for each learned language by its character trigrams, hashed to a fixed number of
cells. Only languages that are written in the word's script are candidates. Viterbi then finds the best labelling of the
words of a text, where each change of language costs a fixed penalty, so spans come out instead of flickering words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.shingles import mix

UNDETERMINED = "und"
#: Script ranges by their first code point; what lies between named scripts counts as one of its own.
SCRIPT_STARTS = {
    0x0000: "latin", 0x0370: "greek", 0x0400: "cyrillic", 0x0530: "armenian", 0x0590: "hebrew", 0x0600: "arabic",
    0x0700: "other", 0x0900: "devanagari", 0x0980: "indic", 0x0E00: "thai", 0x0E80: "asian", 0x10A0: "georgian",
    0x1100: "hangul", 0x1200: "other", 0x1E00: "latin", 0x1F00: "greek", 0x2000: "other", 0x2C60: "latin", 0x2C80: "other",
    0x3040: "kana", 0x3100: "han", 0xA000: "other", 0xA640: "cyrillic", 0xA6A0: "other", 0xA720: "latin", 0xA800: "other",
    0xAC00: "hangul", 0xD800: "other", 0xF900: "han", 0xFB00: "latin", 0xFB1D: "hebrew", 0xFB50: "arabic", 0xFE00: "other",
    0xFE70: "arabic", 0xFF00: "latin", 0xFF66: "kana", 0xFFA0: "hangul", 0x10000: "other", 0x20000: "han",
}
SCRIPTS = list(dict.fromkeys(SCRIPT_STARTS.values()))


@dataclass(frozen=True)
class LanguageSettings:
    """``cells``: hashed trigrams, a power of two. ``penalty``: cost of a change of language, in nats.
    ``script_share``: share of a language's letters from which a script counts as its own. ``smoothing``: added counts."""

    cells: int = 1 << 16
    penalty: float = 8.0
    script_share: float = 0.01
    smoothing: float = 0.5


@dataclass
class LanguageModel:
    """``scores[cell, language]``: log probabilities. ``writes[language, script]``: whether it is a candidate there."""

    languages: list[str]
    scores: np.ndarray
    writes: np.ndarray
    settings: LanguageSettings


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), dtype=bool, count=0x110000)
    starts = np.array(list(SCRIPT_STARTS))
    numbers = np.array([SCRIPTS.index(s) for s in SCRIPT_STARTS.values()], dtype=np.uint8)
    return letters, numbers[np.searchsorted(starts, np.arange(0x110000), "right") - 1]


def trigrams(text: str, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per letter its trigram's cell and its script, and where words begin among the letters."""
    letters, scripts = _tables()
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters[points]
    at = np.flatnonzero(is_letter)
    padded = np.zeros(len(points) + 2, dtype=np.uint64)
    padded[1:-1] = np.where(is_letter, points, 0)
    cell = (mix(padded[at] << np.uint64(42) | padded[at + 1] << np.uint64(21) | padded[at + 2]) % np.uint64(cells)).astype(np.int64)
    return cell, scripts[points[at]], np.flatnonzero(padded[at] == 0)


def _count(languages: list[str], cells: int) -> Callable:
    number = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), cells + len(SCRIPTS)), dtype=np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                cell, script, _ = trigrams(text.as_py(), cells)
                if len(cell):
                    counts[number[lang], :cells] += np.bincount(cell, minlength=cells)
                    counts[number[lang], cells:] += np.bincount(script, minlength=len(SCRIPTS))
        language, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language, pa.int64()), pa.array(cell, pa.int64()), pa.array(counts[language, cell], pa.int64())],
            ["language", "cell", "n"])
    return run


def learn(labelled: DataFrame, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """Counts trigrams of every row of ``labelled`` (text, lang); rows with a null in either teach nothing.

    What reaches the driver are counts: languages times cells, whatever the number of rows.
    """
    rows = labelled.selectExpr("CAST(text AS STRING) AS text", "CAST(lang AS STRING) AS lang").where("text IS NOT NULL AND lang IS NOT NULL")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    counts = np.zeros((len(languages), settings.cells + len(SCRIPTS)))
    if languages:
        found = (rows.mapInArrow(_count(languages, settings.cells), "language long, cell long, n long")
                 .groupBy("language", "cell").agg(F.sum("n").alias("n")).toArrow())
        counts[found.column("language").to_numpy(), found.column("cell").to_numpy()] = found.column("n").to_numpy()
    grams, scripts = counts[:, :settings.cells], counts[:, settings.cells:]
    smoothed = grams + settings.smoothing
    scores = np.log(smoothed / smoothed.sum(axis=1, keepdims=True)) if languages else grams
    writes = scripts >= np.maximum(1, settings.script_share * scripts.sum(axis=1, keepdims=True))
    return LanguageModel(languages, np.ascontiguousarray(scores.T, dtype=np.float32), writes, settings)


def word_scores(text: str, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """(words x languages) log scores relative to each word's best, and letters per word."""
    cell, script, starts = trigrams(text, model.settings.cells)
    if not len(cell):
        return np.zeros((0, len(model.languages))), np.zeros(0, dtype=np.int64)
    summed = np.add.reduceat(model.scores[cell], starts, axis=0).astype(np.float64)
    candidate = model.writes[:, script[starts]].T
    candidate |= ~candidate.any(axis=1, keepdims=True)  # a script that no language was learned in tells nothing
    summed = np.where(candidate, summed, summed.min(axis=1, keepdims=True) - 50.0)
    return summed - summed.max(axis=1, keepdims=True), np.diff(np.append(starts, len(cell)))


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best labels of each text's words. All texts step together; the longest go first, so the active ones are a
    head of the arrays. Ties go to staying, then to the first language."""
    lengths = np.array([len(x) for x in scores])
    order = np.argsort(-lengths, kind="stable")
    result: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(scores)
    order = order[lengths[order] > 0]
    if not len(order):
        return result
    sizes = lengths[order]
    starts = np.append(0, np.cumsum(sizes)[:-1])
    flat = np.concatenate([scores[i] for i in order])
    languages = flat.shape[1]
    stays, best_before = np.ones(flat.shape, dtype=bool), np.zeros(len(flat), dtype=np.int16)
    value, label = flat[starts].copy(), np.zeros(len(flat), dtype=np.int64)
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")  # texts with more than t words
    for t in range(1, sizes[0]):
        n = active[t]
        at, before = starts[:n] + t, value[:n]
        top = before.argmax(axis=1)
        switch = before[np.arange(n), top][:, None] - penalty
        stay = before >= switch
        value[:n] = np.where(stay, before, switch) + flat[at]
        stays[at], best_before[at] = stay, top
    now = np.zeros(len(order), dtype=np.int64)
    for t in range(sizes[0] - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        ending = sizes[:n] == t + 1
        now[:n][ending] = value[:n][ending].argmax(axis=1)
        label[at] = now[:n]
        now[:n] = np.where(stays[at, now[:n]], now[:n], best_before[at])
    for i, start, size in zip(order, starts, sizes):
        result[i] = label[start:start + size]
    return result


BATCH_WORDS = 400_000


def _labelled(texts: Iterator[str], model: LanguageModel) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(labels, letters per word, scores) of each text, in runs of a bounded number of words and of one text at least."""
    scores, letters, held = [], [], 0
    for text in texts:
        s, n = word_scores(text, model)
        scores.append(s)
        letters.append(n)
        held += len(n)
        if held >= BATCH_WORDS:
            yield from zip(viterbi(scores, model.settings.penalty), letters, scores)
            scores, letters, held = [], [], 0
    yield from zip(viterbi(scores, model.settings.penalty), letters, scores)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, n_spans, spans): the language of most letters, and the labelled spans of words.

    ``spans`` lists (language, words, letters) in text order. ``score`` is the predicted language's share of all letters,
    times how surely its words are of it. A text that is null, or has no letter, is ``und`` with score 0 and no spans,
    as is every text if nothing was learned. Ties of letters go to the language first in the alphabet. Only ``text`` is
    looked at; rows come back as often as they came.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for labels, letters, scores in _labelled((x.as_py() or "" for x in batch.column("text")), model):
                if not len(labels) or not model.languages:
                    rows.append((UNDETERMINED, 0.0, 0, []))
                    continue
                totals = np.bincount(labels, weights=letters, minlength=len(model.languages))
                best = int(totals.argmax())
                gap = scores[labels == best].sum(axis=0)
                sure = 1 / np.exp(np.clip(gap - gap[best], -50, 50)).sum()
                first = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
                spans = [(model.languages[labels[i]], int(w), int(c)) for i, w, c in zip(
                    first, np.diff(np.append(first, len(labels))), np.add.reduceat(letters, first))]
                rows.append((model.languages[best], float(totals[best] / totals.sum() * sure), len(spans), spans))
            predicted, score, n_spans, spans = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(predicted, pa.string()), pa.array(score, pa.float64()), pa.array(n_spans, pa.int64()),
                 pa.array([[dict(zip(("lang", "words", "letters"), s)) for s in x] for x in spans],
                          pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64()), ("letters", pa.int64())])))],
                ["doc_id", "lang_pred", "score", "n_spans", "spans"])
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, n_spans long, spans array<struct<lang:string,words:long,letters:long>>")


def held_out(doc_id: str = "doc_id"):
    """The fold that is never learned from. A null doc_id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_spans) of every document, learned from those that aren't held out."""
    model = learn(docs.where(~held_out()).select("text", "lang"), settings)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_spans")
