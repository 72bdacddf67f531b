"""Ranked search, spelling groups and sketch-based duplicates against brute-force versions."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from emberlake.llm import minhash_dedup, ranked_search, spelling_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, term string, word string, value long, n long, set_id string, rank int, block int"
LONG = " ".join(f"w{i % 700}x" for i in range(6000))
TEXTS = [None, "", " \t\n", "a", "One two three", "one TWO three", LONG, LONG + " end", "ÉÀ漢字 😀 it's 12 one", "x" * 5000, "one-two one"]


def frame(spark, rows):
    """Rows of (doc_id, text) with further columns named as the operators' own."""
    return spark.createDataFrame([(i, t, "t", "w", 1, 2, "s", 3, 4) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [*enumerate(TEXTS), (4, "One two three"), (6, LONG), (None, "one two three"), (None, "one two three"), (3, "one")]
    return rows, frame(spark, rows)


def rows_of(spark, sf_dir, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()]


# Ranked search ------------------------------------------------------------------------------

def terms_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def ranked_by_hand(rows, items, k=10):
    bags = [(i, collections.Counter(terms_of(t))) for i, t in rows]
    bags = [(i, b) for i, b in bags if b]
    docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            n, score = sum(bag.values()), 0
            for t in set(terms_of(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * (10 + (90 * n * docs) // total)))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("settings", [
    ranked_search.SearchSettings(), ranked_search.SearchSettings(shard_rows=1, shard_bytes=3000, block_postings=2, query_block=3)])
def test_search_gives_what_scoring_every_document_gives(spark, sf_dir, settings):
    rows, items = rows_of(spark, sf_dir, "documents", "doc_id", "text"), rows_of(spark, sf_dir, "benchmark", "item_id", "text")
    assert found(ranked_search.search(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), settings)) == ranked_by_hand(rows, items)


def test_search_on_odd_rows(spark, odd):
    rows, docs = odd
    items = [(1, "One, two!"), (2, None), (3, ""), (4, "nowhere"), (5, "w1x w2x end"), (6, "漢字 漢字 😀"), (7, "x" * 5000 + " it")]
    asked = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    assert found(ranked_search.search(docs, asked)) == ranked_by_hand(rows, items)
    assert ranked_search.search(docs.where("false"), asked).isEmpty()
    assert ranked_search.search(docs, asked.where("false")).isEmpty()


def test_bounds_never_lose_a_document_and_save_blocks():
    draw, opened = np.random.default_rng(5), []
    for trial in range(60):
        m = draw.integers(10, 400, 3000)
        lists, exact = [], np.zeros(3000, dtype=np.int64)
        for size in draw.integers(1, 3000, 6):
            docs, tf = np.sort(draw.choice(3000, size, replace=False)), draw.integers(1, 9, size)
            data, starts = ranked_search.pack(np.column_stack([np.diff(docs, prepend=-1), tf]).reshape(-1))
            impact, cuts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]), np.arange(0, size, 16)
            weight = int(draw.integers(0, 5000 // (1 + size // 200)))
            lists.append(ranked_search.PostingList(
                weight, docs[np.append(cuts[1:], size) - 1], np.maximum.reduceat(impact, cuts), starts[::2][cuts], data))
            exact[docs] += weight * impact
        whole, real = sum(len(x.last) for x in lists), ranked_search.PostingList.read
        read = [0]

        def counting(self, m, blocks=None):
            read[0] += len(self.last) if blocks is None else len(blocks)
            return real(self, m, blocks)

        ranked_search.PostingList.read = counting
        try:
            got, scores = ranked_search.best_of_shard(lists, m, np.zeros(3000, dtype=np.int64), 10)
        finally:
            ranked_search.PostingList.read = real
        best = np.lexsort((np.arange(3000), -exact))[:10]
        best = best[exact[best] > 0]
        assert got.tolist() == best.tolist() and scores.tolist() == exact[best].tolist()
        opened.append(read[0] / whole)
    assert np.mean(opened) < 0.8


def test_packed_numbers_come_back():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**40])
    assert ranked_search.unpack(ranked_search.pack(values)[0]).tolist() == values.tolist()


# Spelling groups ----------------------------------------------------------------------------

def near_by_hand(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def groups_by_hand(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if near_by_hand(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_groups_on_given_documents(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "documents", "doc_id", "text")
    got = found(spelling_groups.spelling_groups(frame(spark, rows)).select(*COLUMNS))
    assert got == groups_by_hand(rows) and sum(r[4] > 0 for r in got) > 5


def test_spelling_groups_follow_chains_and_long_words(spark, odd):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcé") for _ in range(draw.choice([5, 6, 6, 7, 8]))) for _ in range(60)]
    words += ["y" * 3000, "y" * 2999 + "z", "y" * 3001, "ÀÉîôû÷", "àÉîôû÷"]
    counts = {"chains": 700, "chainsa": 140, "chainsab": 28, "chainsabc": 5}
    rows = [(i, " ".join(draw.choice(words) for _ in range(200))) for i in range(40)]
    rows += [(100 + i, " ".join([w] * c)) for i, (w, c) in enumerate(counts.items())] + odd[0] * 2
    got = found(spelling_groups.spelling_groups(frame(spark, rows), spelling_groups.SpellingSettings(held_words=7)).select(*COLUMNS))
    assert got == groups_by_hand(rows)
    assert any(r[0].startswith("chainsab") and r[2] == "chains" for r in got)
    assert spelling_groups.spelling_groups(odd[1].where("false")).isEmpty()
    assert spelling_groups.spelling_groups(frame(spark, [(1, None), (2, "")])).isEmpty()


@pytest.mark.parametrize("symbols", [2, 5, 13])
def test_neighbourhoods_hold_every_near_reduction(symbols):
    reducer = spelling_groups.Reducer(symbols)
    draw = random.Random(symbols)
    words = ["".join(draw.choice("abcdé") for _ in range(6)) for _ in range(30)]
    for word, found_ in zip(words, reducer.neighbours(words)):
        i, c = draw.randrange(6), draw.choice("xyzß")
        for other in (word, word[:i] + word[i + 1:], word[:i] + c + word[i:], word[:i] + c + word[i + 1:]):
            assert reducer.names([other])[0] in found_ or reducer.names([word])[0] in reducer.neighbours([other])[0]


# Near duplicates ----------------------------------------------------------------------------

def duplicates_by_hand(rows, width=4, percent=80):
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        sets.append({tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and label[i] != label[j] and 100 * len(a & b) >= percent * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc_id, _), x, s in zip(rows, label, sets):
        if s and doc_id is not None:
            least[x] = min(doc_id, least.get(x, doc_id))
    return sorted(((i, len(s), least.get(x) if s else i, (least.get(x) if s else i) == i) for (i, _), x, s in zip(rows, label, sets)), key=repr)


def test_duplicates_on_given_and_odd_rows(spark, sf_dir, odd):
    rows = rows_of(spark, sf_dir, "documents", "doc_id", "text")
    got = found(minhash_dedup.near_duplicates(frame(spark, rows)))
    assert got == duplicates_by_hand(rows) and sum(not r[3] for r in got) > 10
    assert found(minhash_dedup.near_duplicates(odd[1])) == duplicates_by_hand(odd[0])
    assert minhash_dedup.near_duplicates(odd[1].where("false")).isEmpty()


def passages(seed, documents, pool, each):
    draw = random.Random(seed)
    parts = [" ".join(f"p{p}v{draw.randrange(999)}" for _ in range(40)) for p in range(pool)]
    return [(i, " ".join([*draw.sample(parts, each), *(f"own{i}x{j}" for j in range(draw.randrange(1, 30)))])) for i in range(documents)]


@pytest.mark.parametrize("settings", [
    minhash_dedup.SketchSettings(), minhash_dedup.SketchSettings(k=64, common_share=0.1, bucket_values=50, block_sets=20, block_shingles=3000)])
def test_duplicates_among_shared_passages_and_many_near_copies(spark, settings):
    """Documents of one pool of passages, most of them apart, and 80 near copies of one; none may get lost in a hot list."""
    rows = passages(7, 90, 9, 4)
    base = rows[0][1].split()
    draw = random.Random(9)
    for i in range(80):
        words = list(base)
        words[draw.randrange(len(words))] = f"edit{i}"
        rows.append((1000 + i, " ".join(words)))
    rows += [(None, rows[3][1]), (2000, rows[3][1]), (2000, rows[5][1] + " more")]
    assert found(minhash_dedup.near_duplicates(frame(spark, rows), settings)) == duplicates_by_hand(rows)


def test_sketches_estimate_and_prefixes_meet():
    settings, draw = minhash_dedup.SketchSettings(), np.random.default_rng(1)
    for n in (3, 40, 100, 103, 150, 400, 3000):
        for _ in range(30):
            pool = draw.integers(0, 2**63, 2 * n).astype(np.uint64)
            shared = -(-80 * n // 100)
            extra = (n - shared) // 2
            a, b = np.unique(pool[:shared + extra]), np.unique(np.append(pool[:shared], pool[n:n + extra]))
            x, y = minhash_dedup.sketch(a, settings.k), minhash_dedup.sketch(b, settings.k)
            got, of = minhash_dedup.estimate(x, y, len(a), len(b), settings.k)
            if 100 * shared >= 80 * (len(a) + len(b) - shared):
                assert got >= settings.least_shared or of < settings.k or max(len(a), len(b)) <= settings.k
                assert len(np.intersect1d(x[:settings.prefix(len(a))], y[:settings.prefix(len(b))])) > 0 or len(a) > settings.k
            if max(len(a), len(b)) > settings.k:
                assert abs(got / of - shared / (len(a) + len(b) - shared)) < 0.25
