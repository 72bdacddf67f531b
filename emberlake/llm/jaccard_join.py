"""Exact Jaccard join of word shingle sets in their metric space.

Jaccard distance is a metric, but almost all documents lie at distance 1 from almost all others, where the triangle
inequality says nothing. So the space is cut in two ways, both exact:

* *Anchors.* All sets share one order of shingles: by the number of sets that hold them, then by hash, with shingles in
  a ``common_share`` of all sets last. Linked sets share a shingle among each one's first ``n - ceil(0.75 n) + 1``. The
  sets with the same such shingle make a region; a set whose first shingles are all its own has no link.
* *Pivots.* Regions with the same pivot (the member that comes first by hash) become one cell. Every cell of more than a
  few hundred sets is divided in the same way, a large one over the cluster, one of bounded size within a task: each set
  belongs to the Voronoi region of its nearest pivot, or to the outside if all are farther than ``BALL``, and is copied
  to any other region where a set within 0.25 of it may be at home, by the triangle inequality. So linked sets meet in
  the home of either. The regions are divided again, without the pivots, which have met everyone, while that divides them.
  What is left meets by its rarest shingles within the region. Sets known to be connected need no further comparison,
  so thousands of near copies cost one comparison each.

Counting is exact and covers every set. Its hot shingles are found first (their number is at most the mean set size over
``common_share``, whatever the input size) and need no gathering; all others are counted in buckets whose number follows
the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import rows_per_partition, store_once
from emberlake.llm.components import connected_components
from emberlake.llm.shingles import prefix_length, set_digest, shingle_sets
from emberlake.session import discarding


@dataclass(frozen=True)
class JoinSettings:
    """``percent``: least Jaccard likeness of a link. ``common_share``: share of all texts that makes a shingle hot.
    ``bucket_shingles``: shingles counted in one task. ``leaf_shingles``: size of a cell that one task divides and joins.
    ``pivots``: per larger cell and round. ``rounds``: after so many, members of such a cell that share one of their
    rarest shingles within it are compared over the cluster, so that the result is exact in any case. ``counts``: passes in
    which shingles are counted, each of which reads the texts and shuffles its share of the buckets."""

    percent: int = 75
    common_share: float = 0.001
    bucket_shingles: int = 1_500_000
    leaf_shingles: int = 4_000_000
    pivots: int = 4
    rounds: int = 6
    counts: int = 1


#: Sets farther than this from all pivots are at home outside of their regions.
BALL = 0.5


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


_SURVEY = "doc_id long, set_id long, n_shingles long, shingle long, texts long"


def _survey(share: float, at: bool = False) -> Callable:
    """Rows for documents (name and size of the set, with ``at`` the number of the row), and rows for shingles that are hot
    within the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, hot = [], [], ([], [])
            distinct: dict[int, np.ndarray] = {}
            for shingles in shingle_sets(batch.column("text")):
                names.append(set_digest(shingles))
                sizes.append(len(shingles))
                distinct.setdefault(names[-1], shingles)
            values, counts = np.unique(np.concatenate(list(distinct.values()) or [np.zeros(0, np.uint64)]),
                                       return_counts=True)
            common = counts >= max(2, int(share * batch.num_rows / 2))
            n, m = batch.num_rows, int(common.sum())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), pa.nulls(m, pa.int64())]),
                pa.array(names + [None] * m, pa.int64()), pa.array(sizes + [None] * m, pa.int64()),
                pa.concat_arrays([pa.nulls(n, pa.int64()), _signed(values[common])]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(counts[common], pa.int64())]),
                *([pa.concat_arrays([batch.column("at"), pa.nulls(m, pa.int64())])] if at else []),
            ], ["doc_id", "set_id", "n_shingles", "shingle", "texts", *(["at"] if at else [])])
    return run


_BUCKETED = "bucket long, set_ids binary, lengths binary, shingles binary, set_id long, n_common long, prefix array<long>"


def _deal(hot: np.ndarray, buckets: int, percent: int, nth: int = 0, passes: int = 1) -> Callable:
    """Shingles that are not hot, dealt to buckets by hash, of which this pass takes every ``passes``-th; and, in the first
    pass, for every set how many of its shingles are hot.

    Rows about sets go to buckets of their own, below zero. A set whose first shingles reach into its hot ones gets
    these as ``prefix`` right here.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct: dict[int, np.ndarray] = {}
            for shingles in shingle_sets(batch.column("text")):
                if len(shingles):
                    distinct.setdefault(set_digest(shingles), shingles)
            if not distinct:
                continue
            names = np.array(list(distinct), dtype=np.int64)
            lengths = np.array([len(x) for x in distinct.values()])
            values, owner = np.concatenate(list(distinct.values())), np.repeat(np.arange(len(names)), lengths)
            if passes > 1 and nth:
                mine = values % np.uint64(buckets) % np.uint64(passes) == nth
                values, owner = values[mine], owner[mine]
            common = np.isin(values, hot, kind="sort") if len(hot) else np.zeros(len(values), dtype=bool)
            if nth == 0:
                n_common = np.bincount(owner[common], minlength=len(names))
                prefixes: list = [None] * len(names)
                for i in np.flatnonzero([prefix_length(int(n), percent) > n - c for n, c in zip(lengths, n_common)]):
                    own = values[(owner == i) & common]
                    need = prefix_length(int(lengths[i]), percent) - (lengths[i] - n_common[i])
                    prefixes[i] = own[:need].view(np.int64).tolist()
                yield _rows(pa.array(-1 - names % buckets), *[pa.nulls(len(names), pa.binary())] * 3, pa.array(names),
                            pa.array(n_common, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())))
            if passes > 1 and not nth:
                common |= values % np.uint64(buckets) % np.uint64(passes) != 0
            values, owner = values[~common], owner[~common]
            bucket = (values % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            dealt: list[list] = [[], [], [], []]
            for b in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[b]:cuts[b + 1]]
                owners, counts = np.unique(owner[mine], return_counts=True)
                for column, value in zip(dealt, (int(b), names[owners].tobytes(), counts.astype(np.int32).tobytes(),
                                                 values[mine].tobytes())):
                    column.append(value)
            k = len(dealt[0])
            if k:
                yield _rows(pa.array(dealt[0], pa.int64()), *[pa.array(x, pa.binary()) for x in dealt[1:]],
                            pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int64())))
    return run


def _rows(*columns: pa.Array) -> pa.RecordBatch:
    names = ["bucket", "set_ids", "lengths", "shingles", "set_id", "n_common", "prefix"]
    return pa.RecordBatch.from_arrays(list(columns), names)


_FOUND = "set_id long, n_common long, common array<long>, region long, holders long"


def _count(bucket: pa.Table) -> pa.Table:
    """Of one bucket: a row for every set and shingle that other sets hold too, and how many hold it."""
    names = ["set_id", "n_common", "common", "region", "holders"]
    n = bucket.num_rows
    if bucket.column("bucket")[0].as_py() < 0:
        return pa.table([bucket.column("set_id"), bucket.column("n_common"), bucket.column("prefix"),
                         pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
    column = lambda name, kind: np.concatenate([np.frombuffer(x.as_py(), dtype=kind) for x in bucket.column(name)])
    values, owner = column("shingles", np.uint64), np.repeat(column("set_ids", np.int64), column("lengths", np.int32))
    order = np.lexsort((owner, values))
    values, owner = values[order], owner[order]
    new_value = np.append(True, values[1:] != values[:-1])
    first = new_value | np.append(True, owner[1:] != owner[:-1])  # a set comes once for each batch that has a copy
    values, owner, new_value = values[first], owner[first], new_value[first]
    holders = np.diff(np.append(np.flatnonzero(new_value), len(values)))
    holders = np.repeat(holders, holders)
    keep = holders > 1
    values, owner, holders = values[keep], owner[keep], holders[keep]
    return pa.table([pa.array(owner, pa.int64()), pa.nulls(len(owner), pa.int64()), pa.nulls(len(owner), pa.list_(pa.int64())),
                     _signed(values), pa.array(holders, pa.int64())], names)


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the rows that really have the set they are asked for; another row may have the same doc_id."""
    for batch in batches:
        blobs = [x.tobytes() if set_digest(x) == wanted else None
                 for x, wanted in zip(shingle_sets(batch.column("text")), batch.column("set_id").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(blobs, pa.binary())], ["set_id", "shingles"])


def _likeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = []
        for a, b in zip(batch.column("a_set"), batch.column("b_set")):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (a, b))
            both.append((len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)))
        shared, total = (np.array(v, dtype=np.int64) for v in zip(*both)) if both else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(shared), pa.array(total - shared)],
            ["a", "b", "shared", "united"])


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, united) with exact counts for each distinct pair."""
    a, b = (sets.select(F.col("set_id").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    return store_once(pairs.distinct().join(a, "a").join(b, "b").select("a", "b", "a_set", "b_set")
                      .mapInArrow(_likeness, "a long, b long, shared long, united long"), "compared")


REGION_SETS = 128
REGION_PIVOTS = 32


def _regions(far: np.ndarray, home: np.ndarray, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Who belongs to each region and who of them is at home there, by the distances to the pivots (a column each).

    A set's home is its nearest pivot's region or, beyond ``BALL`` from all, the outside. Two sets within reach of each
    other are both in the home of either: their distances to a pivot differ by no more than the reach.
    """
    nearest, least = far.argmin(axis=1), far.min(axis=1)
    for j in range(far.shape[1]):
        inside = far[:, j] <= np.minimum(least + 2 * reach, BALL + reach)
        yield inside, home & (nearest == j) & (least <= BALL)
    yield least > BALL - reach, home & (least > BALL)


def _join_cell(percent: int) -> Callable:
    """Links that connect, within one cell, exactly what all its links connect.

    Regions of more than ``REGION_SETS`` sets are divided by pivots and windows, and so on within each, as long as that
    divides them: pairs within the parts must be a fifth fewer, and copies at most half as many as sets. What is left meets by the rarest shingles in the region's own order, so that texts which only share a passage are not compared pair by pair.
    """
    reach = (100 - percent) / 100 + 1e-9

    def run(cell: pa.Table) -> pa.Table:
        ids = cell.column("set_id").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in cell.column("shingles")]
        sizes = np.array([len(x) for x in sets])
        _, first, label = np.unique(cell.column("label").to_numpy(), return_index=True, return_inverse=True)
        parent = first[label]
        links: list[tuple[int, int]] = []

        def roots(who: np.ndarray) -> np.ndarray:
            at = parent[who]
            while (parent[at] != at).any():
                at = parent[at]
            parent[who] = at
            return at

        def meet(pivot: int, who: np.ndarray) -> np.ndarray:
            values = np.concatenate([sets[i] for i in who])
            at = np.minimum(np.searchsorted(sets[pivot], values), sizes[pivot] - 1)
            shared = np.add.reduceat((sets[pivot][at] == values).astype(np.int64), np.append(0, np.cumsum(sizes[who])[:-1]))
            united = sizes[who] + sizes[pivot] - shared
            linked = who[100 * shared >= percent * united]
            mine = roots(np.array([pivot]))[0]
            theirs, which = np.unique(roots(linked), return_index=True)
            links.extend((ids[pivot], ids[i]) for i in linked[which[theirs != mine]])
            parent[theirs] = mine
            return 1 - shared / united

        def meet_by_shingles(who: np.ndarray, home: np.ndarray) -> None:
            owner = np.repeat(np.arange(len(who)), sizes[who])
            _, shingle, holders = np.unique(np.concatenate([sets[i] for i in who]), return_inverse=True, return_counts=True)
            order = np.lexsort((shingle, holders[shingle], owner))
            rank = np.arange(len(order)) - np.append(0, np.cumsum(sizes[who])[:-1])[owner]
            need = np.array([prefix_length(int(n), percent) for n in sizes[who]])
            kept = order[rank < need[owner]]
            shingle, owner = shingle[kept], owner[kept]
            by = np.argsort(shingle, kind="stable")
            cuts = np.searchsorted(shingle[by], np.arange(len(holders) + 1))
            held, held_from = owner[by], np.append(0, np.cumsum(need)[:-1])
            done, known = np.zeros(len(who), dtype=bool), None
            for i in range(len(who)):
                if i == REGION_PIVOTS:  # from here on the most frequent group need not look for others, who look for it
                    known = int(np.bincount(roots(who)).argmax())
                mine = roots(who[i:i + 1])[0]
                if known is not None and mine == roots(np.array([known]))[0]:
                    continue
                done[i] = True
                lists = [held[cuts[x]:cuts[x + 1]] for x in shingle[held_from[i]:held_from[i] + need[i]] if cuts[x + 1] - cuts[x] > 1]
                if not lists:
                    continue
                other = np.unique(np.concatenate(lists))
                other = other[~done[other] & (home[i] | home[other])]
                size, sized = sizes[who[i]], sizes[who[other]]
                other = other[(roots(who[other]) != mine) & (100 * np.minimum(sized, size) >= percent * np.maximum(sized, size))]
                if len(other):
                    meet(int(who[i]), who[other])

        todo = [(np.arange(len(ids)), cell.column("home").to_numpy().astype(bool))]
        while todo:
            who, home = todo.pop()
            if not home.any() or len(np.unique(roots(who))) == 1:
                continue
            if len(who) > REGION_SETS:
                pivots, columns, least = [], [], np.ones(len(who))
                for p in np.argsort(ids[who], kind="stable"):
                    if not columns or least[p] > BALL:  # no pivot in another one's ball
                        pivots.append(p)
                        columns.append(meet(int(who[p]), who))
                        least = np.minimum(least, columns[-1])
                    if len(pivots) == min(REGION_PIVOTS, isqrt(len(who))):
                        break
                far = np.stack(columns, axis=1)
                rest = np.ones(len(who), dtype=bool)
                rest[pivots] = False  # they have met everyone
                who, home, far = who[rest], home[rest], far[rest]
                parts = list(_regions(far, home, reach))
                held = [int(inside.sum()) for inside, _ in parts]
                if sum(held) <= 1.5 * len(who) and sum(x * x for x in held) <= 0.8 * len(who) ** 2:
                    todo += [(who[inside], at_home[inside]) for inside, at_home in parts]
                    continue
            if len(who):
                meet_by_shingles(who, home)
        a, b = zip(*links) if links else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each member."""
    for batch in batches:
        for i, blob in enumerate(batch.column("shingles")):
            values = np.frombuffer(blob.as_buffer(), dtype=np.int64)
            row = batch.slice(i, 1).drop_columns(["shingles"]).take(pa.array(np.zeros(len(values), dtype=np.int64)))
            yield row.append_column("shingle", pa.array(values, pa.int64()))


def _by_rarest(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of unlike labels and like sizes in one cell that share one of each one's rarest shingles there."""
    each = store_once(large.select("cell", "set_id", "label", "home", "n_shingles").join(sets, "set_id")
                      .select("cell", "set_id", "label", "home", "n_shingles", "shingles")
                      .mapInArrow(_one_by_one, "cell long, set_id long, label long, home boolean, n_shingles long, shingle long"), "members")
    holders = each.groupBy("cell", "shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    alone = each.join(holders, ["cell", "shingle"], "left").fillna(1, ["holders"])
    first = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    kept = (alone.withColumn("rank", F.row_number().over(Window.partitionBy("cell", "set_id").orderBy("holders", "shingle")))
            .where((F.col("rank") <= first) & (F.col("holders") > 1)))
    return kept.alias("l").join(kept.alias("r"), F.expr(
        "l.cell = r.cell AND l.shingle = r.shingle AND l.set_id < r.set_id AND l.label <> r.label AND (l.home OR r.home) "
        f"AND 100 * least(l.n_shingles, r.n_shingles) >= {percent} * greatest(l.n_shingles, r.n_shingles)")).select(
        F.col("l.set_id").alias("a"), F.col("r.set_id").alias("b"))


def _open_cells(members: DataFrame, all_home: bool = False) -> DataFrame:
    """Cells that still hold several components, one of each membership; ``size`` is a cell's sum of set sizes.

    Cells with the same members are one cell, the home of every set that has its home in any of them.
    """
    facts = members.groupBy("cell").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.max("home").alias("home"),
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("x"),
        F.bit_xor(F.xxhash64("set_id", F.lit(2))).alias("y"), F.sum("n_shingles").alias("size"))
    alike = facts.where("least < most AND home")
    if all_home:
        kept = alike.groupBy("n", "x", "y").agg(F.min(F.struct("cell", "size")).alias("kept")).select("kept.*")
        return members.join(kept, "cell")
    merged = (alike.withColumn("into", F.min("cell").over(Window.partitionBy("n", "x", "y")))
              .select("cell", "into", "size"))
    return (members.join(merged, "cell").groupBy("into", "set_id")
            .agg(F.first("n_shingles").alias("n_shingles"), F.first("label").alias("label"), F.max("home").alias("home"),
                 F.first("size").alias("size")).withColumnRenamed("into", "cell"))


def shingle_join(docs: DataFrame, settings: JoinSettings = JoinSettings()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text, whatever else).

    ``component_id`` is the smallest doc_id that a document reaches by links of Jaccard likeness >= ``percent`` %, itself
    included. Null and empty texts and texts of blanks have no shingles and link with nothing, not with each other
    either. Repeated rows come back as often as they came. A null doc_id is never the smallest; a component of such
    rows alone has a null id. An empty table gives an empty table. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    surveyed = store_once(texts.mapInArrow(_survey(settings.common_share), _SURVEY), "survey")
    named = surveyed.where("set_id IS NOT NULL").select("doc_id", "set_id", "n_shingles")
    reached = _groups(texts, surveyed, settings)
    least = reached.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    component = reached.join(least, "label").select(F.col("set_id").alias("of"), "component_id")
    return (named.join(component, named["set_id"] == component["of"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def first_of_each_group(docs: DataFrame, settings: JoinSettings = JoinSettings()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, whatever else), unchanged, but one of those that links connect: that with the
    smallest doc_id, nulls last, then the smallest hash of the row. Rows without words link with nothing and all stay.

    Texts are read once more but not shuffled: a row is known by its doc_id and the hash of its text. Equal rows are told
    apart by a number that their task gives them, after the table is stored. What else is stored on the way is deleted.
    """
    held = store_once(docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                                  F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("at")), "grouped")
    with discarding(docs.sparkSession) as written:
        texts = held.select("doc_id", "text", "at")
        surveyed = store_once(texts.select("doc_id", "text", "at").mapInArrow(_survey(settings.common_share, at=True), _SURVEY + ", at long"), "survey")
        reached = _groups(texts.select("doc_id", "text"), surveyed.drop("at"), settings).select(F.col("set_id").alias("of"), "label")
        rows = surveyed.where("set_id IS NOT NULL")
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("set_id", "at").alias("h"), "at")
        grouped = rows.where("n_shingles > 0").join(reached, rows["set_id"] == F.col("of")).groupBy("label").agg(F.min(order).alias("first"))
        kept = grouped.select(F.col("first.at").alias("kept_at")).unionByName(rows.where("n_shingles = 0").select(F.col("at").alias("kept_at")))
        kept = store_once(kept, "kept")
        written.pop()
    return held.join(kept, held["at"] == kept["kept_at"], "left_semi").select("row.*")


def _groups(texts: DataFrame, surveyed: DataFrame, settings: JoinSettings) -> DataFrame:
    """(set_id, doc_id, label) for every set with words: its smallest doc_id, and what all sets it reaches share."""
    percent = settings.percent
    named = surveyed.where("set_id IS NOT NULL").select("doc_id", "set_id", "n_shingles")
    sets = named.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"))
    rows, shingles = named.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    hot = (surveyed.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("texts").alias("texts"))
           .where(F.col("texts") >= max(32, settings.common_share * rows)).select("shingle").toArrow())
    hot = np.sort(hot.column("shingle").to_numpy().astype(np.int64).view(np.uint64))
    buckets = rows_per_partition(shingles, settings.bucket_shingles)
    found = reduce(DataFrame.unionByName, [
        store_once(texts.mapInArrow(_deal(hot, buckets, percent, nth, settings.counts), _BUCKETED).groupBy("bucket")
                   .applyInArrow(_count, _FOUND), "shared") for nth in range(settings.counts)])
    common = found.where("n_common IS NOT NULL").groupBy("set_id").agg(
        F.first("n_common").alias("n_common"), F.first("common").alias("common"))
    shared = found.where("region IS NOT NULL").select("set_id", "region", "holders")
    first = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    own = F.col("n_shingles") - F.col("n_common") - F.coalesce("n_shared", F.lit(0))
    facts = store_once(
        sets.join(common, "set_id").join(shared.groupBy("set_id").agg(F.count("*").alias("n_shared")), "set_id", "left")
        .select("set_id", "doc_id", "common", (first - own).alias("need")).where("need > 0"), "facts")

    ranked = (shared.join(facts.select("set_id", "need"), "set_id")
              .withColumn("rank", F.row_number().over(Window.partitionBy("set_id").orderBy("holders", "region")))
              .where("rank <= need").select("region", "set_id"))
    anchored = ranked.unionByName(facts.select(F.explode("common").alias("region"), "set_id"))
    pivots = anchored.groupBy("region").agg(
        F.min(F.struct(F.xxhash64("set_id"), "set_id")).alias("p"), F.count("*").alias("n")).where("n > 1")
    members = (anchored.join(pivots, "region").select(F.col("p.set_id").alias("cell"), "set_id").distinct()
               .join(sets.select("set_id", "n_shingles"), "set_id")
               .withColumns({"label": F.col("set_id"), "home": F.lit(True)}))
    wanted = facts.select(F.col("doc_id").alias("rep_id"), "set_id")
    whole = store_once(
        texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["rep_id"])).select("set_id", "text")
        .mapInArrow(_whole_sets, "set_id long, shingles binary").where("shingles IS NOT NULL")
        .groupBy("set_id").agg(F.first("shingles").alias("shingles")), "sets")

    labels = connected_components(_join_cells(members, whole, settings))
    return (sets.select("set_id", "doc_id").join(labels, sets["set_id"] == labels["node"], "left")
            .select("set_id", "doc_id", F.coalesce("label", "set_id").alias("label")))


def _join_cells(members: DataFrame, sets: DataFrame, settings: JoinSettings) -> DataFrame:
    """(a, b): links that connect what all links between sets of one cell connect."""
    reach = (100 - settings.percent) / 100 + 1e-9
    members = store_once(_open_cells(members, all_home=True), "cells")
    leaf, large = (members.where(F.col("size") <= settings.leaf_shingles), members.where(F.col("size") > settings.leaf_shingles))
    leaves, links = [leaf], []
    for done in range(settings.rounds + 1):
        if large.isEmpty():
            break
        met = pairs = None
        if done < settings.rounds:
            chosen = (large.groupBy("cell", "label").agg(F.min(F.struct(F.xxhash64("set_id"), "set_id")).alias("p"))
                      .withColumn("rank", F.row_number().over(Window.partitionBy("cell").orderBy("p")))
                      .where(F.col("rank") <= settings.pivots).select("cell", F.col("p.set_id").alias("pivot")))
            met = store_once(large.join(chosen, "cell"), "met")
            pairs = met.where("set_id <> pivot").select(
                F.least("set_id", "pivot").alias("a"), F.greatest("set_id", "pivot").alias("b"))
        else:
            pairs = _by_rarest(large, sets, settings.percent)
        compared = _compare(pairs, sets)
        links.append(compared.where(F.col("shared") * 100 >= F.col("united") * settings.percent).select("a", "b"))
        if done == settings.rounds:
            break
        labels = connected_components(reduce(DataFrame.unionByName, links))
        pivots = met.where("set_id = pivot").select("cell", "set_id")
        far = (met.join(pivots, ["cell", "set_id"], "left_anti")
               .withColumns({"a": F.least("set_id", "pivot"), "b": F.greatest("set_id", "pivot")})
               .join(compared, ["a", "b"]).withColumn("far", 1 - F.col("shared") / F.col("united")))
        nearest = far.groupBy("cell", "set_id").agg(F.min(F.struct("far", "pivot")).alias("near"))
        least = F.col("near.far")
        placed = far.join(nearest, ["cell", "set_id"])
        balls = placed.where(F.col("far") <= F.least(least + 2 * reach, F.lit(BALL + reach))).select(
            F.xxhash64("cell", "pivot").alias("cell"), "set_id", "n_shingles",
            (F.col("home") & (F.col("pivot") == F.col("near.pivot")) & (least <= BALL)).alias("home"))
        outside = placed.where((F.col("pivot") == F.col("near.pivot")) & (least > BALL - reach)).select(
            F.xxhash64("cell", F.lit("outside")).alias("cell"), "set_id", "n_shingles", (F.col("home") & (least > BALL)).alias("home"))
        cells = balls.unionByName(outside)
        members = store_once(_open_cells(
            cells.join(labels, cells["set_id"] == labels["node"], "left")
            .select("cell", "set_id", "n_shingles", F.coalesce("label", "set_id").alias("label"), "home")), "cells")
        leaves.append(members.where(F.col("size") <= settings.leaf_shingles))
        large = members.where(F.col("size") > settings.leaf_shingles)
    within = (reduce(DataFrame.unionByName, leaves).select("cell", "set_id", "label", "home").join(sets, "set_id")
              .groupBy("cell").applyInArrow(_join_cell(settings.percent), "a long, b long"))
    return reduce(DataFrame.unionByName, links, within)
