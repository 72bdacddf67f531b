"""Ranked lexical search: Block-Max MaxScore over an inverted index that is cut into shards of documents.

A shard is a run of rows of one input partition, so building the index moves nothing. It holds, for each of its terms,
the documents in ascending order with their term frequencies, as gaps in variable-length bytes, in blocks of
``block_postings``; for each block its last document, its largest impact and where its bytes begin. The impact of a
posting is the part of the score that the term's weight multiplies.

A query meets a shard's lists by falling bound (weight times largest impact). Lists are *essential* as long as a document
that has occurred in none before can still get among the best: these are read whole. From the others a document only
gains: it is given up as soon as its score, its block's maximum and the bounds of the lists still to come don't reach the
k-th best score so far, and only blocks that still matter are decompressed. The best of all shards are merged last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import rows_per_partition, store_once
from emberlake.llm.shingles import text_slices, word_hashes

#: ASCII bytes outside digits and letters end a term; all bytes of other characters belong to one.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
#: Hashing takes some 50 bytes of memory for each byte of a slice.
SLICE_BYTES = 1 << 19


@dataclass(frozen=True)
class SearchSettings:
    """``top``: results a query. ``shard_bytes`` and ``shard_rows``: a shard ends with the row that reaches either; building
    one takes some 40 bytes of memory for each of its text. ``block_postings``: postings that are decompressed together.
    ``query_block``: queries that one task runs on a shard. ``batch_terms``: terms that a task hands over together."""

    top: int = 10
    shard_bytes: int = 8_000_000
    shard_rows: int = 65_536
    block_postings: int = 128
    query_block: int = 1_000
    batch_terms: int = 32_768


def _terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the terms, where each row's terms begin) of a slice of rows."""
    for first, data, offsets in text_slices(column, SLICE_BYTES):
        yield first, *word_hashes(data, offsets, BREAKS)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = total = 0
        for _, _, bounds in _terms(batch.column("text")):
            held += int((np.diff(bounds) > 0).sum())
            total += int(bounds[-1] - bounds[0])
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([total], pa.int64())], ["held", "total"])


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as seven bits a byte, lowest first, with the top bit where more follow; and the first byte of each."""
    width, most = np.ones(len(values), dtype=np.int8), int(values.max(initial=0))
    for bits in range(7, 63, 7):
        if most >> bits:
            width += values >= (1 << bits)
    starts = np.cumsum(width, dtype=np.int64) - width
    out = np.zeros(int(width.sum()), dtype=np.uint8)
    for j in range(int(width.max(initial=0))):
        more = width > j
        out[starts[more] + j] = ((values[more] >> (7 * j)) & 127) | np.where(width[more] > j + 1, 128, 0)
    return out, starts


def unpack(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.append(0, ends[:-1] + 1)
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


_INDEX = ("shard string, term long, holders long, bound long, last array<int>, most array<int>, cut array<int>, "
          "postings binary, ids array<long>, m array<long>")
_NAMES = [x.split()[0] for x in _INDEX.split(", ")]


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _shard(name: str, texts: list[pa.Array], ids: pa.Array, held: int, total: int, settings: SearchSettings) -> Iterator[pa.RecordBatch]:
    """One row for the documents of a shard, then a row for each of its terms."""
    hashes, owners, lengths = [], [], []
    row = 0
    for column in texts:
        for _, terms, bounds in _terms(column):
            n = np.diff(bounds)
            hashes.append(terms)
            owners.append(np.repeat(np.arange(row, row + len(n), dtype=np.int32), n))
            lengths.append(n)
            row += len(n)
    lengths = np.concatenate(lengths).astype(np.int64)
    # documents are numbered by ascending id, those without one last, so that ties go by number
    order = np.array(pa.compute.sort_indices(ids, null_placement="at_end"))
    number = np.empty(row, dtype=np.int32)
    number[order] = np.arange(row, dtype=np.int32)
    m = 10 + (90 * lengths[order] * held) // total
    nothing = [pa.array([None], x) for x in (pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 3, pa.binary())]
    whole = lambda x, kind: pa.array([x], pa.list_(kind))
    yield pa.RecordBatch.from_arrays(
        [pa.array([name]), *nothing, whole(ids.take(pa.array(order)).to_pylist(), pa.int64()), whole(m, pa.int64())], _NAMES)

    term, doc = np.concatenate(hashes), np.concatenate(owners)
    hashes.clear()
    owners.clear()
    if not len(term):
        return
    doc = number[doc]
    sort = np.lexsort((doc, term))
    term, doc = term[sort], doc[sort]
    del sort
    first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])))
    tf = np.diff(np.append(first, len(term)))
    term, doc = term[first], doc[first].astype(np.int64)
    del first
    lists = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    holders = np.diff(np.append(lists, len(term)))
    place = np.arange(len(term)) - np.repeat(lists, holders)
    blocks = np.flatnonzero(place % settings.block_postings == 0)
    ends = np.append(blocks[1:], len(term)) - 1
    gap = doc - np.append(-1, doc[:-1])
    gap[lists] = doc[lists] + 1
    data, starts = pack(np.column_stack([gap, tf]).reshape(-1))
    starts = starts[::2].copy()
    most = np.maximum.reduceat(_impact(tf, m[doc]), blocks)
    del gap, tf, place
    of_list = np.searchsorted(blocks, lists)
    begin = starts[lists]
    bounds = pa.array(np.append(of_list, len(blocks)), pa.int32())
    table = lambda x: pa.ListArray.from_arrays(bounds, pa.array(x, pa.int32()))
    n = len(lists)
    rows = pa.RecordBatch.from_arrays([
        pa.array([name] * n), pa.array(term[lists].view(np.int64)), pa.array(holders, pa.int64()),
        pa.array(np.maximum.reduceat(most, of_list), pa.int64()), table(doc[ends]), table(most),
        table(starts[blocks] - np.repeat(begin, np.diff(np.append(of_list, len(blocks))))),
        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]),
        pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], _NAMES)
    del term, doc, data, starts
    for at in range(0, n, settings.batch_terms):
        yield rows.slice(at, settings.batch_terms)


def build_index(docs: DataFrame, held: int, total: int, settings: SearchSettings = SearchSettings()) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text), of which ``held`` have terms, ``total`` in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shards = TaskContext.get().partitionId(), 0
        texts, ids, size, rows = [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                texts.append(piece.column("text"))
                ids.append(piece.column("doc_id"))
                size, rows = size + piece.column("text").nbytes, rows + piece.num_rows
                if size >= settings.shard_bytes or rows >= settings.shard_rows:
                    yield from _shard(f"{part}-{shards}", texts, pa.concat_arrays(ids), held, total, settings)
                    texts, ids, size, rows, shards = [], [], 0, 0, shards + 1
        if rows:
            yield from _shard(f"{part}-{shards}", texts, pa.concat_arrays(ids), held, total, settings)
    return store_once(docs.mapInArrow(run, _INDEX), "search-index")


class PostingList:
    """One term's postings in one shard."""

    def __init__(self, weight: int, last: np.ndarray, most: np.ndarray, cut: np.ndarray, data: np.ndarray):
        self.weight, self.last, self.most, self.data = weight, last, most, data
        self.cut = np.append(cut, len(data))
        self.bound = weight * int(most.max())

    def read(self, m: np.ndarray, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and what they gain, of the given blocks (ascending) or of all."""
        if blocks is None:
            blocks, data = np.arange(len(self.last)), self.data
        else:
            data = np.concatenate([self.data[self.cut[b]:self.cut[b + 1]] for b in blocks])
        values = unpack(data)
        # a block's gaps lead from the last document of the block before it to its own last one
        before = np.where(blocks > 0, self.last[blocks - 1], -1).astype(np.int64)
        reached, far = np.cumsum(values[::2]), np.cumsum(self.last[blocks] - before)
        counts = np.diff(np.searchsorted(reached, far), prepend=-1)
        doc = reached + np.repeat(before - np.append(0, far[:-1]), counts)
        return doc, self.weight * _impact(values[1::2], m[doc])


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_of_shard(lists: list[PostingList], m: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents (numbers and scores above 0) of a shard, equal scores by number; ``score`` is scratch space."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: -x.bound)
    rest = np.append(np.cumsum([x.bound for x in lists][::-1])[::-1], 0).astype(np.int64)
    score[:] = 0
    least, i = 1, 0
    while i < len(lists) and rest[i] >= least:
        docs, gain = lists[i].read(m)
        score[docs] += gain
        least, i = max(least, _kth(score[score > 0], k)), i + 1
    found = np.flatnonzero(score)
    for j in range(i, len(lists)):
        found = found[score[found] + rest[j] >= least]
        block = np.searchsorted(lists[j].last, found)
        inside = block < len(lists[j].last)
        block[~inside] = 0
        there = inside & (score[found] + lists[j].weight * lists[j].most[block] + rest[j + 1] >= least)
        stays = there | (score[found] + rest[j + 1] >= least)
        found, block, there = found[stays], block[stays], there[stays]
        if not there.any():
            continue
        docs, gain = lists[j].read(m, np.unique(block[there]))
        at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
        hit = docs[at] == found
        score[found[hit]] += gain[at[hit]]
        least = max(least, _kth(score[found], k))
    order = np.lexsort((found, -score[found]))[:k]
    return found[order], score[found[order]]


_HITS = "item long, doc_id long, score long"


def _search(k: int) -> Callable:
    """Runs a block of queries on a shard, given the lists of all their terms and the shard's documents."""
    def run(lists: pa.Table, header: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if header.num_rows and lists.num_rows:
            ids = header.column("ids")[0].values
            m = header.column("m")[0].values.to_numpy()
            numbers = lambda name: [x.values.to_numpy() for x in lists.column(name)]
            of_term = {t: PostingList(w, last, most, cut, np.frombuffer(data.as_buffer(), dtype=np.uint8)) for t, w, last, most, cut, data in zip(
                lists.column("term").to_pylist(), lists.column("weight").to_pylist(), numbers("last"), numbers("most"),
                numbers("cut"), lists.column("postings"))}
            score = np.zeros(len(m), dtype=np.int64)
            for query in header.column("queries")[0].as_py():
                docs, scores = best_of_shard([of_term[t] for t in query["terms"] if t in of_term], m, score, k)
                found[0].extend([query["item"]] * len(docs))
                found[1].extend(ids.take(pa.array(docs)).to_pylist())
                found[2].extend(scores.tolist())
        return pa.table([pa.array(x, pa.int64()) for x in found], ["item", "doc_id", "score"])
    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, terms, bounds in _terms(batch.column("text")):
            rows = [np.unique(terms[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").slice(first, len(rows)), pa.array([x.tolist() for x in rows], pa.list_(pa.int64()))], ["item", "terms"])


def search(docs: DataFrame, items: DataFrame, settings: SearchSettings = SearchSettings()) -> DataFrame:
    """(item_id, rank, doc_id, score): for each of ``items`` (item_id, text) the best of ``docs`` (doc_id, text).

    Scores are those of the contract in integers; term weights come from all documents. Documents without a term, null
    texts included, count for nothing and are never found; nor are those that score 0. Each row is a document, so
    repeated rows and rows that share an id take a rank each; a null doc_id ranks behind equal scores. Items that repeat
    both id and text are one item; one id with several texts has a list for each. Items without terms, or whose terms no
    document holds, have no rows; empty tables give none. Texts count whole, whatever their length; other columns are
    ignored.
    """
    k = settings.top
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held, total = texts.select("text").mapInArrow(_measure, "held long, total long").agg(
        F.coalesce(F.sum("held"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).distinct().withColumn(
        "item", F.xxhash64("item_id", "text"))
    queries = store_once(asked.select("item", "text").mapInArrow(_query_terms, "item long, terms array<long>"), "queries")
    index = build_index(texts, held, max(total, 1), settings)

    blocks = rows_per_partition(queries.count(), settings.query_block)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks).cast("long")))
    terms = queries.select("block", F.explode("terms").alias("term")).distinct()
    weight = F.floor(1000 * F.log((2 * F.lit(held) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    weights = (index.where("term IS NOT NULL").select("term", "holders").join(terms.select("term").distinct(), "term")
               .groupBy("term").agg(F.sum("holders").alias("df")).select("term", weight.alias("weight")))
    lists = (index.where("term IS NOT NULL").select("shard", "term", "last", "most", "cut", "postings")
             .join(weights.join(terms, "term"), "term"))
    packed = queries.groupBy("block").agg(F.collect_list(F.struct("item", "terms")).alias("queries"))
    header = (index.where("term IS NULL").select("shard", "ids", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
              .join(packed, "block").select(F.col("shard").alias("of"), F.col("block").alias("run"), "ids", "m", "queries"))
    hits = lists.groupBy("shard", "block").cogroup(header.groupBy("of", "run")).applyInArrow(_search(k), _HITS)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = hits.withColumn("rank", place).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
