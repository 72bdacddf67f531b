"""Order MinHash fingerprints of texts: likeness by edit distance rather than by content alone.

A text's k-mers of code points are numbered by occurrence, so each counts as an element of its own. Under each of many
hash orders the ``picks`` smallest elements are taken, put back in text order, and hashed as a tuple. Two texts agree in
such a sketch only if they share these k-mers *and* have them in the same order, so moving text about is seen.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import store_once
from emberlake.llm.shingles import mix

_U = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Sketching:
    """``k``: code points in a k-mer. ``sketches``: hash orders, a multiple of 8. ``picks``: k-mers per order."""

    k: int = 8
    sketches: int = 64
    picks: int = 2


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def kmer_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """One hash per k-mer; a shorter text is one k-mer as a whole, an empty one has none."""
    if len(points) < k:
        whole = (points.astype(np.uint64) + _U(1)) * mix(np.arange(1, len(points) + 1, dtype=np.uint64))
        return mix(whole.sum(dtype=np.uint64, keepdims=True) + _U(len(points))) if len(points) else np.zeros(0, np.uint64)
    return mix(_spans(points.astype(np.uint64), k))


def _spans(values: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all runs of k values, by halves."""
    if k == 1:
        return values
    half = _spans(values, k // 2)
    count, width = len(values) - k + 1, k // 2
    result = half[:count] * _U(pow(_GOLDEN, width, 1 << 64)) + half[width:width + count]
    return result * _U(_GOLDEN) + values[k - 1:] if k % 2 else result


def number_occurrences(hashes: np.ndarray) -> np.ndarray:
    """Gives the second, third, ... occurrence of a k-mer hashes of their own."""
    ordered = np.sort(hashes)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeated):
        return hashes
    at = np.flatnonzero(np.isin(hashes, repeated))
    at = at[np.argsort(hashes[at], kind="stable")]
    values = hashes[at]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    number = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    numbered = hashes.copy()
    later = number > 0
    numbered[at[later]] = mix(values[later] + number[later].astype(np.uint64) * _U(_GOLDEN))
    return numbered


#: Elements whose keys are worked out at once.
_CHUNK = 4096


@functools.cache
def _order_terms(sketches: int) -> tuple[np.ndarray, np.ndarray]:
    """Per order an odd factor and a shift, so that no element comes first in several orders for its trailing zeros."""
    terms = (mix(np.arange(1, 2 * sketches + 1, dtype=np.uint64)) >> _U(32)).astype(np.uint32)
    return terms[:sketches] | np.uint32(1), terms[sketches:]


def fingerprint(elements: np.ndarray, how: Sketching) -> np.ndarray:
    """``sketches`` 16-bit hashes. Every order ranks elements by a product of its own, high bits first, as the low bits of a
    product depend on the low bits of the element only; and ties by the whole element."""
    n, result = len(elements), np.zeros(how.sketches, dtype=np.uint64)
    if n == 0:
        return result.astype(np.uint16)
    factors, shifts = _order_terms(how.sketches)
    picks, orders = min(how.picks, n), np.arange(how.sketches)
    high = (elements >> _U(32)).astype(np.uint32)
    bound = min(65536, 1 + 65536 * (12 + 2 * picks) // n)
    found = []
    for start in range(0, n, _CHUNK):
        keys = factors[:, None] * high[None, start:start + _CHUNK]
        keys += shifts[:, None]
        small = (keys < np.uint32(bound << 16)) if bound < 65536 else np.ones(keys.shape, dtype=bool)
        eights = np.flatnonzero(small.reshape(-1).view(np.uint64))
        cells = (eights[:, None] * 8 + np.arange(8)[None, :]).reshape(-1)
        order, position = np.divmod(cells[small.reshape(-1)[cells]], keys.shape[1])
        found.append((order, position + start))
    order, position = (np.concatenate(x) for x in zip(*found))
    short = np.flatnonzero(np.bincount(order, minlength=how.sketches) < picks)
    if len(short):  # an order with too few small keys takes part with all
        keep = ~np.isin(order, short)
        position = np.append(position[keep], np.tile(np.arange(n), len(short)))
        order = np.append(order[keep], np.repeat(short, n))
    key = order.astype(np.uint64) << _U(48) | (high[position] * factors[order] + shifts[order]).astype(np.uint64) << _U(16)
    key |= mix(elements[position] + order.astype(np.uint64)) >> _U(48)
    ranked = np.argsort(key, kind="stable")  # positions ascend within an order
    order, position = order[ranked], position[ranked]
    chosen = (np.searchsorted(order, orders)[:, None] + np.arange(picks)[None, :])
    tuples = elements[np.sort(position[chosen], axis=1)]
    for i in range(picks):
        result = mix(result * _U(_GOLDEN) + tuples[:, i] + _U(1))
    return (result >> _U(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean()) if len(a) else 1.0


def fingerprints(docs: DataFrame, how: Sketching = Sketching(), text: str = "text") -> DataFrame:
    """``docs`` with a ``fingerprint`` column (hex) behind its own, replacing one of that name; null texts are empty.

    Equal texts have equal fingerprints. Empty texts share one, which agrees with a text's only by chance of 2^-16.
    """
    kept = [c for c in docs.columns if c != "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sketch(value.as_py() or "", how)[1].astype(">u2").tobytes().hex() for value in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, pa.string())], [*kept, "fingerprint"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, text])]).mapInArrow(run, f"{fields}, fingerprint string")


def _sketch(text: str, how: Sketching) -> tuple[np.ndarray, np.ndarray]:
    hashes = kmer_hashes(code_points(text), how.k)
    return hashes, fingerprint(number_occurrences(hashes), how)


def _edited(points: np.ndarray, hashes: np.ndarray, following: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The text with its last half replaced by the start of the next one, and its k-mer hashes; most are reused."""
    half = len(points) // 2
    head = points[:len(points) - half]
    whole = np.concatenate([head, following[:half]])
    if len(head) < k or len(whole) < k:
        return whole, kmer_hashes(whole, k)
    return whole, np.concatenate([hashes[:len(head) - k + 1], kmer_hashes(whole[len(head) - k + 1:], k)]
                                 if len(whole) > len(head) else [hashes[:len(head) - k + 1]])


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _compare_runs(how: Sketching) -> Callable:
    """Rows of one task are whole runs, each in order; a run's last row only lends its text to the row before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            for doc_id, text, lent in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lent"))):
                points = code_points(text or "")
                hashes = kmer_hashes(points, how.k)
                mine = fingerprint(number_occurrences(hashes), how)
                if held is not None:
                    rows.append(_row(*held, points, mine, how))
                held = None if lent else (doc_id, points, hashes, mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*rows) if rows else [()] * 7, [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])],
                [c.split()[0] for c in _OUT.split(", ")])
    return run


def _row(doc_id, points, hashes, mine, next_points, next_print, how: Sketching) -> tuple:
    whole, whole_hashes = _edited(points, hashes, next_points, how.k)
    theirs = mine if len(whole) == len(points) and np.array_equal(whole, points) else fingerprint(number_occurrences(whole_hashes), how)
    text = whole.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return (doc_id, len(points), hashlib.sha256(text).hexdigest(), mine.astype(">u2").tobytes().hex(),
            theirs.astype(">u2").tobytes().hex(), likeness(mine, theirs), likeness(mine, next_print))


#: Documents in a run, and the most runs (but for rounding, at most twice as many): what is broadcast is 24 bytes a run.
RUN_IDS = 512
MOST_RUNS = 100_000


def edit_sensitivity(docs: DataFrame, how: Sketching = Sketching(), run_ids: int = RUN_IDS) -> DataFrame:
    """Each text's fingerprint beside that of an edited text, whose last half the next document's start replaces.

    "Next" is in descending order of doc_id, from the last back to the first; ties are ordered by text, rows of null
    doc_id come last. A null text is empty; a lone row is next to itself. The order needs no global sort: ids are cut
    into runs, a run is sorted within a task, and the first row of each run is lent to the run before. Texts are
    shuffled once; which rows are lent is found by a broadcast of the runs' first ids, whose number is bounded.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = docs.count()
    if not count:
        return docs.sparkSession.createDataFrame([], _OUT)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    run = _run_of(ids, count, max(1, run_ids, count // MOST_RUNS))
    firsts = store_once(ids.select(run.alias("run"), "doc_id").groupBy("run").agg(F.max("doc_id").alias("first_id")), "runs")
    chained = _previous(firsts, firsts.agg(F.max("run")).first()[0])
    lenders = rows.withColumn("run", run).join(F.broadcast(chained.withColumnRenamed("run", "of")), (F.col("run") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    lent = (lenders.groupBy("of").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"), F.first("before").alias("run"))
            .select("run", "doc_id", "text", F.lit(True).alias("lent")))
    every = rows.select(run.alias("run"), "doc_id", "text", F.lit(False).alias("lent")).unionByName(lent)
    dealt = every.repartition("run").sortWithinPartitions("run", "lent", F.desc_nulls_last("doc_id"), "text")
    return dealt.select("doc_id", "text", "lent").mapInArrow(_compare_runs(how), _OUT)


CUTS = 256
_BLOCK = 1 << 40


def _run_of(ids: DataFrame, count: int, run_ids: int) -> Column:
    """The run of a doc_id, ascending while ids descend: 256 blocks by quantile, runs of equal width within each."""
    least, most, cuts = ids.agg(
        F.coalesce(F.min("doc_id"), F.lit(0)), F.coalesce(F.max("doc_id"), F.lit(0)),
        F.percentile_approx("doc_id", [i / CUTS for i in range(1, CUTS)])).first()
    cuts = sorted(set(cuts or []))
    highs = [*cuts, most]
    widths = [max(1, (high - low) * run_ids * CUTS // count) for low, high in zip([least, *cuts], highs)]
    of = lambda values, at: F.get(F.lit(values), at)
    block = F.array_size(F.filter(F.lit(cuts or [most + 1]), lambda cut: cut <= F.col("doc_id")))
    inner = F.floor((of(highs, block) - F.col("doc_id")) / of(widths, block))
    return F.when(F.col("doc_id").isNull(), F.lit((CUTS + 1) * _BLOCK)).otherwise((CUTS - block) * F.lit(_BLOCK) + inner).cast("long")


def _previous(firsts: DataFrame, last_run: int) -> DataFrame:
    """(run, first_id, before): the run that comes before in the order; before the first run comes the last."""
    blocked = firsts.withColumn("block", F.floor(F.col("run") / _BLOCK))
    within = blocked.withColumn("before", F.lag("run").over(Window.partitionBy("block").orderBy("run")))
    lasts = blocked.groupBy("block").agg(F.max("run").alias("last_run"))
    order = lasts.select(F.col("block").alias("at"), F.lag("last_run").over(Window.orderBy("block")).alias("earlier"))
    return (within.join(order, within["block"] == order["at"]).select(
        "run", "first_id", F.coalesce("before", "earlier", F.lit(last_run)).alias("before")))
