"""What a worker of the BPE encoder keeps from one run of texts to the next."""

import public_tokenizers
import pyarrow as pa

from emberlake.llm import trie_bpe


def test_pieces_of_known_words_are_not_walked_again(monkeypatch):
    model = trie_bpe.TrieBpe.from_file(public_tokenizers.path("word_bpe_49k.json"))
    walked, real = [], model.walk
    model.walk = lambda words: real(walked.extend(words) or words)
    words = [f"quomarandeb{a}{b}" for a in "abcdefgh" for b in "stuvwxyz"]
    first = [raw for raw, _ in model.encode_batch([" ".join(words)])]
    assert len(walked) == len(words)
    again = [raw for raw, _ in model.encode_batch([" ".join(w.capitalize() for w in words), " ".join(w.upper() for w in words)])]
    assert again == first * 2 and len(walked) == len(words)
    monkeypatch.setattr(trie_bpe, "CACHED_PIECES", 10)
    for _ in range(3):
        assert [raw for raw, _ in model.encode_batch([" ".join(words)])] == first
    assert len(walked) == len(words) and len(model.known) == len(words)
    for a in "abcdefgh":
        list(model.encode_batch([" ".join(f"virelomp{a}{b}" for b in "stuvwxyzabcdefg")]))
    assert len(model.known) + len(model.older) <= 4 * 15


def test_words_are_held_for_a_few_million_characters_at_most():
    runs = list(trie_bpe._slices(pa.array([None, "a" * 700_000, "b c " * 250_000] * 4)))
    assert [len(t) for run in runs for t in run] == [0, 700_000, 1_000_000] * 4
    assert max(sum(map(len, run)) for run in runs) < 4_000_000
