"""Long roles, every code point, and the pipeline's near-duplicate stage on awkward rows."""

import re
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from emberlake.llm import chat_format, jaccard_join, secret_scan, token_files, trie_bpe

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_roles_and_texts_of_any_length_are_read_back(spark):
    long = "a\\b\n" * 250_000
    turns = spark.createDataFrame([(1, 0, long, "x"), (1, 1, "assistant", long), (2, 0, "\\", "\n"), (2, 1, "\n\\\n", "")], "conv_id long, turn int, role string, text string")
    formatted = chat_format.format_conversations(turns)
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in formatted.select("conv_id", chat_format.parse_turns(formatted["formatted"]).alias("turns")).collect()}
    assert got == {1: [(long, "x"), ("assistant", long)], 2: [("\\", "\n"), ("\n\\\n", "")]}


def test_every_code_point_encodes_as_in_the_library():
    """But for the large blocks that are alike throughout, of which every 97th is taken."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, ours = Tokenizer.from_file(path), trie_bpe.TrieBpe.from_file(path)
    alike = [(0x3400, 0x9FFF), (0xAC00, 0xD7A3), (0xE000, 0xF8FF), (0x14400, 0x16800), (0x17000, 0x18CD5), (0x20000, 0x10FFFF)]
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and (c % 97 == 0 or not any(a <= c <= b for a, b in alike))]
    texts = [f"a{chr(c)}B {chr(c)}{chr(c)}" for c in points]
    wrong = [hex(c) for c, wanted, (raw, _) in zip(points, library.encode_batch(texts, add_special_tokens=False), ours.encode_batch(texts))
             if wanted.ids != [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)]]
    assert not wrong, (len(wrong), wrong[:20], unicodedata.unidata_version)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def test_one_row_of_each_group_stays_and_no_other_goes(spark):
    base = " ".join(f"w{i}" for i in range(40))
    near, other = base + " more", " ".join(f"v{i}" for i in range(30))
    rows = [(7, base), (3, near), (None, base), (None, base), (9, other), (9, base), (9, other), (None, "x y z"), (None, "x y z"), (5, None), (5, ""), (5, None), (6, "x y")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "clash", 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, at int")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(3, near), (9, other), (None, "x y z"), (5, None), (5, ""), (5, None), (6, "x y")], key=repr)
    assert corpus_pipeline.near_duplicates(spark, docs.where("false"), "").isEmpty()


def test_thousands_of_spans_in_one_text(spark):
    pair, n = "user=alice " + "aB3" * 12 + " ", 20_000
    text = "\U0001f600" + pair * n + "password=0123456789abcdef0123456789abcdef" + " " * 300 + "user=bob"
    row = secret_scan.scan(spark.createDataFrame([(1, text), (1, "user=alice"), (1, text)], "doc_id long, text string")).orderBy("n_linked").collect()
    assert [r.n_linked for r in row] == [0, 2 * n, 2 * n] and row[1].spans == row[2].spans
    at = 1 + n * len(pair)
    wanted = [span for i in range(1, at, len(pair)) for span in (f"ident:{i}:{i + 10}", f"blob:{i + 11}:{i + 47}")]
    assert row[1].spans == ",".join([*wanted, f"assign:{at}:{at + 41}", f"hex:{at + 9}:{at + 41}"])


def test_one_token_file_is_searched_by_many_tasks(spark, tmp_path):
    """More blocks than a run of the prefix scan has, documents within blocks and across many, bytes left over."""
    tokens = np.random.default_rng(5).integers(1, 400, 600_000).astype("<u2")
    tokens[::997], tokens[200_000:300_000] = 0, 7
    (tmp_path / "a long name.bin").write_bytes(tokens.tobytes() + b"x")
    (tmp_path / "empty.bin").write_bytes(b"")
    ranges = token_files._ranges(spark, str(tmp_path), 2, 100, 1 << 16)
    assert ranges.count() == 6_000 > token_files.RUN_BLOCKS and ranges.rdd.getNumPartitions() == 19
    found = token_files.separator_scan(spark, str(tmp_path), 0, 2, block_tokens=100, task_bytes=1 << 16).orderBy("doc").collect()
    ends = np.flatnonzero(tokens == 0)
    starts, stops = np.append(0, ends + 1), np.append(ends, len(tokens))
    assert [(r.doc, r.start, r.n_tokens, r.ended) for r in found] == [
        (i, a, b - a, i < len(ends)) for i, (a, b) in enumerate(zip(starts.tolist(), stops.tolist())) if i < len(ends) or a < b]


def clustered(groups, each, seed):
    """Near copies of ``groups`` texts, half of which share a passage, at likenesses around the least one."""
    rng, sets = np.random.default_rng(seed), []
    for g in range(groups):
        base = [g * 1000 + k for k in range(60)] + ([900_000 + k for k in range(25)] if g % 2 else [])
        for _ in range(each):
            gone = rng.permutation(len(base))[:rng.integers(0, 11)]
            sets.append(np.unique([base[k] if k not in gone else rng.integers(1_000_000, 1 << 40) for k in range(len(base))]).astype(np.uint64))
    return [sets[i] for i in rng.permutation(len(sets))]


def linked(a, b):
    shared = len(np.intersect1d(a, b))
    return 100 * shared >= 75 * (len(a) + len(b) - shared)


def test_linked_sets_meet_in_the_home_of_either():
    sets = clustered(8, 12, 1)
    far = np.array([[1 - len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for y in sets[:5]] for x in sets])
    regions = list(jaccard_join._regions(far, np.ones(len(sets), dtype=bool), 0.25 + 1e-9))
    assert (sum(home.astype(int) for _, home in regions) == 1).all() and all((inside | ~home).all() for inside, home in regions)
    assert sum(inside.sum() for inside, _ in regions) < 2 * len(sets)
    assert all(inside[j] for inside, home in regions for i in np.flatnonzero(home) for j in range(len(sets)) if linked(sets[i], sets[j]))


@pytest.mark.parametrize("largest", [24, 60, 100_000])
def test_a_cell_is_divided_and_loses_no_link(monkeypatch, largest):
    sets, divided = clustered(40, 12, 2), []
    monkeypatch.setattr(jaccard_join, "REGION_SETS", largest)
    regions = jaccard_join._regions
    monkeypatch.setattr(jaccard_join, "_regions", lambda far, home, reach: divided.append(len(home)) or regions(far, home, reach))
    n = len(sets)
    cell = pa.table({"set_id": pa.array(range(n), pa.int64()), "label": pa.array(range(n), pa.int64()),
                     "home": pa.array([True] * n), "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})
    found = jaccard_join._join_cell(75)(cell)
    label, wanted = list(range(n)), list(range(n))
    for names, pairs in ((label, zip(*[found.column(c).to_pylist() for c in "ab"])),
                         (wanted, ((i, j) for i in range(n) for j in range(i) if linked(sets[i], sets[j])))):
        for a, b in pairs:
            assert linked(sets[a], sets[b])
            names[:] = [min(names[a], names[b]) if x in (names[a], names[b]) else x for x in names]
    assert label == wanted and 40 <= len(set(label)) < n
    assert len(divided) > 1 if largest < 100 else not divided
