"""BPE encoding with word ends, by walking the trie of a batch's distinct words.

A BPE encoding is valid exactly if each pair of neighbouring tokens is the encoding of the pair's own text. So the last
token of a prefix depends only on the last tokens of shorter prefixes, and a depth-first walk of the trie finds it once
for all words that share the prefix. Sorting the words is the trie: neighbours share their longest common prefix, and
the path to the current node is the only state. The vocabulary is read from a file of the tokenizers library's format;
nothing is trained.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

WORD_END = "</w>"
#: White space as the file's normalizer sees it; it never lies inside a word.
_BLANK = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RAW_WORD = re.compile(f"[^{_BLANK}]+")
#: The split pattern of the vocabulary file, applied to lower-cased words.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: What is letter or number in tables newer than the library's (Unicode 16), and not to the library.
_NEWER_RANGES = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DFFF), (0x1E6C0, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x3FC3F)]
#: Lower case of the capitals of Unicode 16 and 17, where Python's tables are older.
_NEWER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 32 for c in range(0x10D50, 0x10D66)}, **{c: c + 27 for c in range(0x16EA0, 0x16EB9)}}
_NEWER_CLASS = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _NEWER_RANGES)
_NEWER = regex.compile(f"[{_NEWER_CLASS}]")
_PIECE_WITH_NEWER = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_NEWER_CLASS}]]+|[\p{{N}}--[{_NEWER_CLASS}]]|(?:[^\s\p{{L}}\p{{N}}]|[{_NEWER_CLASS}])+")
#: Characters that Python's own split takes as blank and the normalizer doesn't.
_ODD_BLANK = re.compile("[\x1c-\x1f]")
#: Below this character Python's letters are the library's, and nothing is composed.
_PLAIN_BELOW = "\u0180"
#: What a worker keeps between batches, twice over: pieces and their characters in all. And answers about pairs of tokens.
CACHED_PIECES = 100_000
CACHED_CHARACTERS = 2_000_000
CACHED_PAIRS = 300_000


def _byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def _pieces(word: str) -> list[str]:
    if max(word) < _PLAIN_BELOW:
        word = word.lower()
        return [word] if word.isalpha() else _PIECE.findall(word)
    word = _normal(word)
    return (_PIECE if word.isascii() or not _NEWER.search(word) else _PIECE_WITH_NEWER).findall(word)


def _reach(tokens: dict[str, str]) -> dict[str, int]:
    """The longest token for each three last characters; where there is none, tokens have two at most."""
    reach: dict[str, int] = {}
    for token in tokens:
        reach[token[-3:]] = max(len(token), reach.get(token[-3:], 2))
    return reach


@dataclass
class TrieBpe:
    """Vocabulary, merges and added tokens, with the walk over words and what it has learnt about token pairs."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    added: dict[str, int]
    letters: dict[int, str] = field(default_factory=_byte_characters)

    def __post_init__(self) -> None:
        self.inner = {t: t for t in self.vocab if not t.endswith(WORD_END)}
        self.final = {t[:-len(WORD_END)]: t for t in self.vocab if t.endswith(WORD_END)}
        self.inner_reach, self.final_reach = _reach(self.inner), _reach(self.final)
        self.names = {i: t for t, i in (self.vocab | self.added).items()}
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self.held = 0
        self.marks = {t: (int(i).to_bytes(4, "little"), t) for t, i in self.added.items()}
        self.ids = {t: int(i).to_bytes(4, "little") for t, i in self.vocab.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    @classmethod
    def from_file(cls, path: str) -> TrieBpe:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in content["model"]["merges"]]
        return cls(content["model"]["vocab"], {m: i for i, m in enumerate(merges)},
                   {t["content"]: t["id"] for t in content["added_tokens"]})

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE on a few symbols; only ever asked about one or two tokens."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.ranks.get((symbols[i], symbols[i + 1]), 1 << 60))
            if (symbols[best], symbols[best + 1]) not in self.ranks:
                break
            symbols[best:best + 2] = [symbols[best] + symbols[best + 1]]
        return symbols

    def stands(self, left: str, right: str) -> bool:
        """Whether ``left`` then ``right`` is how their joint text is encoded; an empty left asks about right alone."""
        answer = self.fits.get((left, right))
        if answer is None:
            body = right.removesuffix(WORD_END)
            symbols = [*left, *body]
            if right.endswith(WORD_END):
                symbols[-1] += WORD_END
            answer = self.fits[left, right] = self.merge(symbols) == ([left, right] if left else [right])
        return answer

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, tokens) of distinct words of byte characters, depth first through their trie."""
        inner, final, fits, inner_reach, final_reach = self.inner, self.final, self.fits, self.inner_reach, self.final_reach
        last: list[str] = [""]  # last[i]: last token of the current word's first i characters
        path = ""
        for word in sorted(words):
            depth = 0
            for one, other in zip(path, word):
                if one != other:
                    break
                depth += 1
            del last[depth + 1:]
            size = len(word)
            for end in range(len(last), size):
                start = end - inner_reach.get(word[end - 3 if end > 3 else 0:end], 2)
                for start in range(start if start > 0 else 0, end):
                    token = inner.get(word[start:end])
                    if token is not None:
                        fit = fits.get((last[start], token))
                        if fit or fit is None and self.stands(last[start], token):
                            last.append(token)
                            break
            path = word[:len(last) - 1]
            for start in range(max(0, size - final_reach.get(word[-3:], 2)), size):
                token = final.get(word[start:])
                if token is not None:
                    fit = fits.get((last[start], token))
                    if fit or fit is None and self.stands(last[start], token):
                        break
            tokens = [token]
            while start:
                token = last[start]
                tokens.append(token)
                start -= len(token)
            tokens.reverse()
            yield word, tokens

    def learn(self, raw: set[str]) -> dict[str, tuple[bytes, str]]:
        """For each raw word its ids as little-endian bytes, and its tokens joined by blanks.

        Pieces are kept: words differ by capitals and marks more often than in their letters. Once enough are known, those
        that have not been met since the time before are dropped.
        """
        if len(self.known) > CACHED_PIECES or self.held > CACHED_CHARACTERS:
            self.older, self.known, self.held = self.known, {}, 0
        if len(self.fits) > CACHED_PAIRS:
            self.fits.clear()
        known, older = self.known, self.older
        split = {w: _pieces(w) for w in raw}
        spelled = {}
        for piece in {p for parts in split.values() for p in parts}.difference(known):
            answer = older.get(piece)
            if answer is None:
                spelled[piece.encode().decode("latin-1").translate(self.letters)] = piece
            else:
                known[piece] = answer
            self.held += len(piece)
        ids = self.ids.__getitem__
        for word, tokens in self.walk(spelled):
            known[spelled[word]] = (b"".join(map(ids, tokens)), " ".join(tokens))
        answers = {}
        for word, parts in split.items():
            if len(parts) == 1:
                answers[word] = known[parts[0]]
            else:
                found = [known[p] for p in parts]
                answers[word] = (b"".join([i for i, _ in found]), " ".join([shown for _, shown in found]))
        return answers

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and what they decode to."""
        split = [self._raw_words(text) for text in texts]
        found = self.learn(set().union(*split).difference(self.added)) | self.marks
        for words in split:
            answers = [found[w] for w in words]
            yield b"".join([ids for ids, _ in answers]), " ".join([shown for ids, shown in answers if ids])

    def _raw_words(self, text: str) -> list[str]:
        if self.split is not None and self.split.search(text):
            return [w for part in self.split.split(text) for w in ([part] if part in self.added else self._blank_split(part))]
        return self._blank_split(text)

    @staticmethod
    def _blank_split(text: str) -> list[str]:
        return _RAW_WORD.findall(text) if _ODD_BLANK.search(text) else text.split()


def _normal(word: str) -> str:
    """Composed and lower-cased character by character, so a final sigma is an ordinary one."""
    if word.isascii():
        return word.lower()
    return unicodedata.normalize("NFC", word).replace("Σ", "σ").translate(_NEWER_LOWER).lower()


@lru_cache(maxsize=2)
def _loaded(path: str) -> TrieBpe:
    return TrieBpe.from_file(path)


SLICE_CHARACTERS = 2_000_000


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded`` (string) behind its columns; those names are replaced.

    Encodes every whole text as the tokenizers library does with the file ``vocabulary``, which must be readable on the
    executors, without added special tokens; strings of special tokens inside a text are these tokens. Null texts count
    as empty and have no ids. Rows come back as often as they came. What a worker keeps between batches is bounded by
    ``CACHED_PIECES``, ``CACHED_CHARACTERS`` and ``CACHED_PAIRS`` besides one run of texts, whatever the texts hold. An empty
    table gives an empty table.
    """
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(vocabulary)
        for batch in batches:
            ids, shown = [], []
            for texts in _slices(batch.column(text)):
                for raw, decoded in model.encode_batch(texts):
                    ids.append(np.frombuffer(raw, dtype="<i4"))
                    shown.append(decoded)
            offsets = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(shown, pa.string())],
                [*kept, "ids", "decoded"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, text])]).mapInArrow(run, f"{fields}, ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the encoding of :func:`encode` in short, for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(vocabulary)
        for batch in batches:
            rows = [(len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                    for texts in _slices(batch.column("text")) for raw, decoded in model.encode_batch(texts)]
            counts, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _slices(column: pa.Array) -> Iterator[list[str]]:
    """A batch's texts in runs of bounded length, so that only one run's words are held at a time."""
    run, size = [], 0
    for value in column:
        run.append(value.as_py() or "")
        size += len(run[-1])
        if size >= SLICE_CHARACTERS:
            yield run
            run, size = [], 0
    if run:
        yield run
