"""Near duplicates from bottom-k sketches of one hash function.

A set's sketch is its ``k`` smallest hashes. Of two sketches the ``k`` smallest hashes of their union are a sample of the
union of the sets, and those in both sketches are a sample of what the sets share. So

* *inverted lists* of retained values bring sets together: linked sets keep, but for a chance below one in ten million,
  at least ``least_shared`` values in common (all that likeness asks for, where sketches are whole sets), hence one among
  the rarest ``size - least_shared + 1`` values of each. Only those lists are made, rarest first;
* *the union's sketch* estimates the likeness, and pairs below the bound that gives the chance above go;
* *exact counting* on the whole sets decides what remains.

No list emits its pairs. Each list has a leader, the member whose values others hold most: the original of many near
copies shares all of its own, a copy lacks what was edited. Leaders meet the members of their lists first, which connects
most of what there is to connect. The lists of one leader then make a cell; cells that still hold several components are
cut into blocks, and each two blocks of a cell meet in one task, which counts overlaps by the inverted lists of its own
members, estimates, verifies, and compares nothing that is already connected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import rows_per_partition, store_once
from emberlake.llm.components import connected_components
from emberlake.llm.shingles import mix, set_digest, shingle_sets


@dataclass(frozen=True)
class SketchSettings:
    """``percent``: least Jaccard likeness of a link. ``words``: words in a shingle. ``k``: values in a sketch.
    ``deviations``: how far below its mean an estimate may fall before its pair goes. ``common_share``: share of all
    texts that makes a value hot. ``bucket_values``: values counted in one task. ``block_sets`` and ``block_shingles``:
    about the most that a block of a cell holds; a task has two."""

    percent: int = 80
    words: int = 4
    k: int = 128
    deviations: float = 6.0
    common_share: float = 0.001
    bucket_values: int = 1_500_000
    block_sets: int = 1_000
    block_shingles: int = 100_000

    @property
    def least_shared(self) -> int:
        """Of ``k`` values of a union's sketch, those that linked sets share but for the chance named above."""
        p = self.percent / 100
        return max(1, math.floor(self.k * p - self.deviations * math.sqrt(self.k * p * (1 - p))))

    def prefix(self, n: int) -> int:
        """How many of the first values of the sketch of a set of ``n``, in any common order, must hold a shared one."""
        if 100 * n <= self.percent * self.k:  # so small that all it can be linked with have whole sketches
            return n - -(-self.percent * n // 100) + 1
        return min(n, self.k) - self.least_shared + 1


_U = np.uint64


def sketch(shingles: np.ndarray, k: int) -> np.ndarray:
    """The k smallest hashes, ascending."""
    hashes = mix(shingles ^ _U(0x5851F42D4C957F2D))
    return np.sort(hashes if len(hashes) <= k else np.partition(hashes, k)[:k])


_SURVEY = "doc_id long, text_key long, set_id long, n_shingles long, sketch binary, value long, texts long"


def _survey(settings: SketchSettings) -> Callable:
    """Rows for documents (the first of each set in a batch with its sketch), and rows for values hot within the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, shown = [], [], []
            distinct: dict[int, np.ndarray] = {}
            for shingles in shingle_sets(batch.column("text"), settings.words):
                names.append(set_digest(shingles))
                sizes.append(len(shingles))
                new = len(shingles) and names[-1] not in distinct
                if new:
                    distinct[names[-1]] = sketch(shingles, settings.k)
                shown.append(distinct[names[-1]].tobytes() if new else None)
            values, counts = np.unique(np.concatenate(list(distinct.values()) or [np.zeros(0, np.uint64)]), return_counts=True)
            common = counts >= max(2, int(settings.common_share * batch.num_rows / 2))
            n, m = batch.num_rows, int(common.sum())
            longs = lambda x: pa.concat_arrays([x.cast(pa.int64()), pa.nulls(m, pa.int64())])
            yield pa.RecordBatch.from_arrays([
                longs(batch.column("doc_id")), longs(batch.column("text_key")), longs(pa.array(names, pa.int64())),
                longs(pa.array(sizes, pa.int64())), pa.array(shown + [None] * m, pa.binary()),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(values[common].view(np.int64))]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(counts[common], pa.int64())]),
            ], [x.split()[0] for x in _SURVEY.split(", ")])
    return run


_DEALT = "bucket long, set_ids binary, lengths binary, vals binary, set_id long, size long, n_hot long, need long, hot array<long>"


def _deal(hot: np.ndarray, buckets: int, settings: SketchSettings) -> Callable:
    """Retained values that are not hot, dealt to buckets by value. For every set a row (in a bucket below zero) says how
    many of its rarest values it needs, less those that no other set can hold, and which hot ones are among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _DEALT.split(", ")]
        for batch in batches:
            ids, sizes = batch.column("set_id").to_numpy(), batch.column("n_shingles").to_numpy()
            sketches = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column("sketch")]
            if not sketches:
                continue
            lengths = np.array([len(x) for x in sketches])
            values, owner = np.concatenate(sketches), np.repeat(np.arange(len(ids)), lengths)
            common = np.isin(values, hot, kind="sort") if len(hot) else np.zeros(len(values), dtype=bool)
            cool = lengths - np.bincount(owner[common], minlength=len(ids))
            need = np.array([settings.prefix(int(n)) for n in sizes])
            taken: list = [[]] * len(ids)
            for i in np.flatnonzero(need > cool):
                taken[i] = values[(owner == i) & common][:need[i] - cool[i]].view(np.int64).tolist()
            nothing = [pa.nulls(len(ids), pa.binary())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(-1 - ids % buckets), *nothing, pa.array(ids), pa.array(lengths), pa.array(lengths - cool),
                                              pa.array(need - cool), pa.array(taken, pa.list_(pa.int64()))], names)
            values, owner = values[~common], owner[~common]
            bucket = (values % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            dealt: list[tuple] = []
            for b in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[b]:cuts[b + 1]]
                owners, counts = np.unique(owner[mine], return_counts=True)
                dealt.append((int(b), ids[owners].tobytes(), counts.astype(np.int32).tobytes(), values[mine].tobytes()))
            k = len(dealt)
            if k:
                columns = list(zip(*dealt))
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int64()), *[pa.array(x, pa.binary()) for x in columns[1:]],
                    *[pa.nulls(k, pa.int64())] * 4, pa.nulls(k, pa.list_(pa.int64()))], names)
    return run


_LISTED = "set_id long, size long, n_hot long, need long, hot array<long>, value long, holders long"


def _list(bucket: pa.Table) -> pa.Table:
    """The inverted lists of one bucket that hold several sets, as rows (set_id, value, holders)."""
    names = [x.split()[0] for x in _LISTED.split(", ")]
    n = bucket.num_rows
    if bucket.column("bucket")[0].as_py() < 0:
        return pa.table([*[bucket.column(x) for x in names[:5]], *[pa.nulls(n, pa.int64())] * 2], names)
    joined = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in bucket.column(name)])
    values, owner = joined("vals", np.uint64), np.repeat(joined("set_ids", np.int64), joined("lengths", np.int32))
    order = np.lexsort((owner, values))
    values, owner = values[order], owner[order]
    start = np.append(True, values[1:] != values[:-1])
    once = start | np.append(True, owner[1:] != owner[:-1])  # a set comes once for each batch that has a copy
    values, owner, start = values[once], owner[once], start[once]
    holders = np.diff(np.append(np.flatnonzero(start), len(values)))
    holders = np.repeat(holders, holders)
    kept = holders > 1
    m = int(kept.sum())
    return pa.table([pa.array(owner[kept]), *[pa.nulls(m, pa.int64())] * 3, pa.nulls(m, pa.list_(pa.int64())),
                     pa.array(values[kept].view(np.int64)), pa.array(holders[kept], pa.int64())], names)


def inverted_lists(sketches: DataFrame, hot: np.ndarray, buckets: int, settings: SketchSettings) -> DataFrame:
    """(value, set_id, standing): of each set the rarest values that a linked set must share, where others hold them too.
    ``standing`` is the share of a set's sketch that others hold."""
    found = store_once(sketches.mapInArrow(_deal(hot, buckets, settings), _DEALT).groupBy("bucket").applyInArrow(_list, _LISTED), "lists")
    listed = found.where("value IS NOT NULL").select("set_id", "value", "holders")
    own = found.where("need IS NOT NULL").groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("size", "n_hot", "need", "hot")])
    # need counts from the sketch's hot values back; with the values that nobody shares first, so many shared ones are needed
    shared = listed.groupBy("set_id").agg(F.count("*").alias("n"))
    held = F.coalesce("n", F.lit(0))
    wanted = (own.join(shared, "set_id", "left").select(
        "set_id", "hot", (F.col("need") + held).alias("take"), ((held + F.col("n_hot")) / F.col("size")).alias("standing")).where("take > 0"))
    rank = F.row_number().over(Window.partitionBy("set_id").orderBy("holders", "value"))
    rare = (listed.join(wanted.select("set_id", "take", "standing"), "set_id").withColumn("rank", rank).where("rank <= take")
            .select("value", "set_id", "standing"))
    return rare.unionByName(wanted.select(F.explode("hot").alias("value"), "set_id", "standing"))


def _whole(width: int) -> Callable:
    """Sets of the rows that were chosen to stand for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [x.tobytes() for x in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(blobs, pa.binary())], ["set_id", "shingles"])
    return run


def estimate(x: np.ndarray, y: np.ndarray, n_x: int, n_y: int, k: int) -> tuple[int, int]:
    """(shared, of): of so many values of the union's sketch so many are in both; whole sets are compared whole."""
    shared = np.intersect1d(x, y, assume_unique=True)
    if n_x <= k and n_y <= k:
        return len(shared), len(x) + len(y) - len(shared)
    union = np.union1d(x, y)[:k]
    return int(np.searchsorted(shared, union[-1], "right")), len(union)


def _promising(settings: SketchSettings) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, n_a, n_b in zip(batch.column("a_sketch"), batch.column("b_sketch"), batch.column("a_n").to_pylist(), batch.column("b_n").to_pylist()):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (a, b))
                shared, of = estimate(x, y, n_a, n_b, settings.k)
                whole = max(n_a, n_b) <= settings.k
                keep.append(100 * shared >= settings.percent * of if whole else shared >= settings.least_shared)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])
    return run


def _linked(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (a, b))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])
    return run


def _both(pairs: DataFrame, of: DataFrame, **columns: str) -> DataFrame:
    """Pairs (a, b) with columns of either side."""
    for side in "ab":
        pairs = pairs.join(of.select(F.col("set_id").alias(side), *[F.col(c).alias(f"{side}_{n}") for n, c in columns.items()]), side)
    return pairs


class _Block:
    """Members of two blocks of a cell (or of one), ready to be compared row by row."""

    def __init__(self, group: pa.Table, settings: SketchSettings):
        unpacked = lambda name: [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group.column(name)]
        self.settings, self.sketches, self.sets = settings, unpacked("sketch"), unpacked("shingles")
        self.sizes = np.array([len(x) for x in self.sets])
        lengths = np.array([len(x) for x in self.sketches])
        owner, rank = np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(1, n + 1) for n in lengths])
        values = np.concatenate(self.sketches)
        order = np.argsort(values, kind="stable")
        self.owner, self.rank, self.values = owner[order], rank[order], values[order]

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` (a mask) that member i has a link with."""
        k, percent, sizes = self.settings.k, self.settings.percent, self.sizes
        mine = self.sketches[i]
        low, high = np.searchsorted(self.values, mine, "left"), np.searchsorted(self.values, mine, "right")
        at = np.repeat(low - np.append(0, np.cumsum(high - low)[:-1]), high - low) + np.arange(int((high - low).sum()))
        member, ranks = self.owner[at], np.repeat(np.arange(1, len(mine) + 1), high - low) + self.rank[at]
        shared = np.bincount(member, minlength=len(sizes))
        whole = np.maximum(sizes, sizes[i]) <= k
        enough = np.where(whole, 100 * shared >= percent * (sizes + sizes[i] - shared), shared >= self.settings.least_shared)
        others = others & enough & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        # a shared value's rank in the union is the sum of its ranks less the number of shared values up to it
        mine_too = others[member]
        member, ranks = member[mine_too], ranks[mine_too]
        order = np.argsort(member, kind="stable")
        member, ranks = member[order], ranks[order]
        first = np.searchsorted(member, member)
        within = np.bincount(member[ranks - (np.arange(len(member)) - first + 1) <= k], minlength=len(sizes))
        who = np.flatnonzero(others & (whole | (within >= self.settings.least_shared)))
        if not len(who):
            return who
        starts = np.append(0, np.cumsum(sizes[who])[:-1])
        values = np.concatenate([self.sets[j] for j in who])
        at = np.minimum(np.searchsorted(self.sets[i], values), sizes[i] - 1)
        both = np.add.reduceat((self.sets[i][at] == values).astype(np.int64), starts)
        return who[100 * both >= percent * (sizes[who] + sizes[i] - both)]


def _meet(settings: SketchSettings) -> Callable:
    """Links that connect, between the two blocks, exactly what all links between them connect."""
    def run(group: pa.Table) -> pa.Table:
        block, ids = _Block(group, settings), group.column("set_id").to_numpy()
        late = group.column("late").to_numpy(zero_copy_only=False)
        apart = bool(late.any())
        _, label = np.unique(group.column("label").to_numpy(), return_inverse=True)
        waiting = np.ones(len(ids), dtype=bool)
        a, b = [], []
        while (np.bincount(label[waiting]) > 0).sum() > 1:
            counts = np.bincount(label[waiting])
            rarest = np.flatnonzero(counts)[np.argmin(counts[counts > 0])]
            i = int(np.flatnonzero(waiting & (label == rarest))[0])
            waiting[i] = False
            others = waiting & (label != label[i])
            found = block.linked(i, others & (late != late[i]) if apart else others)
            a += [ids[i]] * len(found)
            b += ids[found].tolist()
            label[np.isin(label, label[found])] = label[i]
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _links(lists: DataFrame, retained: DataFrame, whole: DataFrame, settings: SketchSettings) -> DataFrame:
    """(a, b): links that connect what all links between members of one list connect."""
    leader = lists.groupBy("value").agg(
        F.min(F.struct((-F.col("standing")).alias("s"), F.xxhash64("set_id").alias("h"), F.col("set_id").alias("cell"))).alias("f"),
        F.count("*").alias("n")).where("n > 1").select("value", "f.cell")
    sizes = retained.select("set_id", F.col("n_shingles").alias("n"))
    cells = store_once(lists.join(leader, "value").where("set_id <> cell").select("cell", "set_id").distinct().join(sizes, "set_id"), "cells")

    near_size = 100 * F.least("n", "m") >= settings.percent * F.greatest("n", "m")
    pairs = (cells.join(sizes.select(F.col("set_id").alias("cell"), F.col("n").alias("m")), "cell").where(near_size)
             .select(F.least("set_id", "cell").alias("a"), F.greatest("set_id", "cell").alias("b")).distinct())
    hopeful = _both(pairs, retained, sketch="sketch", n="n_shingles").mapInArrow(_promising(settings), "a long, b long")
    links = store_once(_both(hopeful, whole, set="shingles").mapInArrow(_linked(settings.percent), "a long, b long"), "links")

    labels = connected_components(links)
    members = (cells.join(labels, cells["set_id"] == labels["node"], "left")
               .select("cell", "set_id", "n", F.coalesce("label", "set_id").alias("label")))
    blocks = F.greatest(F.ceil(F.count("*") / settings.block_sets), F.ceil(F.sum("n") / settings.block_shingles))
    still = members.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high"), blocks.alias("blocks")).where("low < high")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks"))
    dealt = (members.join(still.select("cell", "blocks"), "cell").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("cell", "set_id", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("late")))
    # a block meets itself in a group where none is late
    met = (dealt.join(retained.select("set_id", "sketch"), "set_id").join(whole, "set_id")
           .groupBy("cell", "i", "j").applyInArrow(_meet(settings), "a long, b long"))
    return links.unionByName(met)


def near_duplicates(docs: DataFrame, settings: SketchSettings = SketchSettings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, whatever else).

    ``component_id`` is the smallest doc_id that a document reaches by links of Jaccard likeness >= ``percent`` %, itself
    included; ``kept`` says that it is the document's own (or that neither has one). Every link is confirmed on the full
    sets. Null and empty texts and texts of blanks have no shingles and link with nothing, not with each other either.
    Repeated rows come back as often as they came; rows that share a doc_id are told apart by their texts. A null doc_id
    is never the smallest. An empty table gives an empty table. Texts count whole, whatever their length; other columns
    are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    surveyed = store_once(texts.mapInArrow(_survey(settings), _SURVEY), "survey")
    named = surveyed.where("set_id IS NOT NULL").select("doc_id", "text_key", "set_id", "n_shingles")
    sets = named.where("n_shingles > 0").groupBy("set_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("rep"), F.first("n_shingles").alias("n_shingles"))
    rows, values = surveyed.where("set_id IS NOT NULL").agg(
        F.count("*"), F.coalesce(F.sum(F.when(F.col("sketch").isNotNull(), F.least("n_shingles", F.lit(settings.k)))), F.lit(0))).first()
    hot = (surveyed.where("value IS NOT NULL").groupBy("value").agg(F.sum("texts").alias("texts"))
           .where(F.col("texts") >= max(32, settings.common_share * rows)).select("value").toArrow())
    hot = np.sort(hot.column("value").to_numpy().astype(np.int64).view(np.uint64))
    sketches = surveyed.where("sketch IS NOT NULL").select("set_id", "n_shingles", "sketch")
    lists = store_once(inverted_lists(sketches, hot, rows_per_partition(values, settings.bucket_values), settings), "inverted")

    listed = lists.select("set_id").distinct()
    retained = store_once(sketches.join(listed, "set_id", "left_semi").groupBy("set_id").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "retained")
    chosen = sets.join(listed, "set_id", "left_semi").select("set_id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    whole = store_once(
        texts.join(chosen, (texts["text_key"] == chosen["rep_key"]) & texts["doc_id"].eqNullSafe(chosen["rep_id"])).select("set_id", "text")
        .mapInArrow(_whole(settings.words), "set_id long, shingles binary").groupBy("set_id").agg(F.first("shingles").alias("shingles")), "sets")

    labels = connected_components(_links(lists, retained, whole, settings))
    reached = (sets.select("set_id", F.col("rep.doc_id").alias("doc_id")).join(labels, sets["set_id"] == labels["node"], "left")
               .select("set_id", "doc_id", F.coalesce("label", "set_id").alias("label")))
    least = reached.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    component = reached.join(least, "label").select(F.col("set_id").alias("of"), "component_id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (named.join(component, named["set_id"] == component["of"], "left")
            .select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")))
