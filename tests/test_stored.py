"""Figures carried on by batches, compacted stream output, and the board's store by month."""

import datetime
import pathlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from emberlake.operators import board, serving
from emberlake.sinks import compaction, rollup
from emberlake.sinks.streams import parquet_sink
from emberlake.sinks.tables import write_months
from emberlake.streaming.run import drain

EVENT = "event_timestamp timestamp, latitude double, longitude double, frp double, daynight string"
START = datetime.datetime(2024, 1, 5)


def events(seed, n, days=40):
    """Half of them on one day, some without time or strength."""
    draw = random.Random(seed)

    def when():
        chance = draw.random()
        return None if chance < 0.05 else START + datetime.timedelta(days=0 if chance < 0.5 else draw.randrange(days), hours=draw.randrange(24))

    return [(when(), draw.uniform(-80, 80), draw.uniform(-170, 170), None if draw.random() < 0.1 else float(draw.randrange(50)),
             draw.choice(["D", "N", None])) for _ in range(n)]


def by_hand(rows):
    days = defaultdict(list)
    for r in rows:
        days[r[0] and r[0].date()].append(r)
    out = {}
    for day, some in days.items():
        strong = [r[3] for r in some if r[3] is not None]
        out[day] = (len(some), max(strong, default=None), sum(r[4] == "N" for r in some), round(sum(strong) / len(strong), 6) if strong else None)
    return out


def daily():
    return rollup.Rollup(*serving.daily_fire_parts())


def carried(spark, base):
    parts = rollup.read_rollup(spark, base, daily())
    return {r.event_date: (r.fire_count, r.max_frp, r.night_fires, r.frp_sum / r.frp_count if r.frp_count else None) for r in parts.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for day, (n, most, night, mean) in want.items():
        assert got[day][:3] == (n, most, night) and got[day][3] == (mean if mean is None else pytest.approx(mean))


def test_carried_figures_equal_those_of_all_rows(spark, tmp_path):
    base, write = str(tmp_path / "figures"), rollup.carry_on(str(tmp_path / "figures"), daily())
    batches = [events(seed, 200) for seed in range(5)] + [[]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, EVENT)
        write(df, i)
        write(df, i)
        if i in (1, 3):
            assert rollup.fold(spark, base, daily()) == i
            for earlier in range(i + 1):
                write(spark.createDataFrame(batches[earlier], EVENT), earlier)
    same(carried(spark, base), by_hand([r for rows in batches for r in rows]))
    frame = spark.createDataFrame([r for rows in batches for r in rows], EVENT)
    figures = serving.daily_fire_figures(rollup.read_rollup(spark, base, daily())).collect()
    assert figures == serving.daily_fire_kpis(frame).collect()


def test_a_failed_fold_leaves_the_figures(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "figures")
    rows = events(7, 100)
    rollup.carry_on(base, daily())(spark.createDataFrame(rows, EVENT), 0)
    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(rollup, "commit_folder", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        rollup.fold(spark, base, daily())
    same(carried(spark, base), by_hand(rows))
    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(rollup, "remove_folder", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        rollup.fold(spark, base, daily())
    same(carried(spark, base), by_hand(rows))
    rollup.fold(spark, base, daily())
    assert rollup.committed_folders(spark, base) == ["fold=0"]


def test_figures_of_no_batch(spark, tmp_path):
    schema = "event_date date, fire_count long, frp_count long, frp_sum double, max_frp double, night_fires long"
    assert rollup.read_rollup(spark, str(tmp_path / "none"), daily(), schema).count() == 0
    assert rollup.fold(spark, str(tmp_path / "none"), daily()) == -1


OUTPUT = "event_timestamp timestamp, n long, year int, month int"


class Feed:
    """A running output of several small files a batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, path, 0
        self.output = compaction.Output(f"{path}/out", f"{path}/compacted", spark.createDataFrame([], OUTPUT).schema)

    def send(self, *months):
        rows = []
        for year, month in months:
            for _ in range(6):
                rows.append((datetime.datetime(year, month, 3) if year else None, self.sent, year, month))
                self.sent += 1
        self.spark.createDataFrame(rows, OUTPUT).repartition(3).write.mode("append").parquet(f"{self.path}/in")
        live = self.spark.readStream.schema(OUTPUT).parquet(f"{self.path}/in")
        drain(parquet_sink(live, self.output.stream, f"{self.path}/checkpoint"))

    def numbers(self):
        return sorted(r.n for r in compaction.read_compacted(self.spark, self.output).select("n").collect())

    def files(self, year, month):
        """Of the stream, as far as a reader opens them, and of the newest generation."""
        held = compaction._newest(self.spark, self.output)
        live, here = self.output.live(self.spark), f"year = {year} AND month = {month}"
        number = next((n for n, months in held.items() if (year, month) in months), None)
        if number is None:
            return live.where(here).select(compaction.FILE).distinct().count()
        rest = compaction._uncovered(self.spark, self.output, live, [(year, month)]).select(compaction.FILE).distinct().count()
        folder = pathlib.Path(self.output.generation(number, "rows"), f"year={year}", f"month={month}")
        return rest + len(list(folder.glob("*.parquet")))


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    for _ in range(3):
        feed.send((2024, 1), (2024, 2), (None, None))
    before = datetime.date(2024, 2, 10)
    assert feed.files(2024, 1) >= 6
    assert compaction.compact(spark, feed.output, before) == [(2024, 1)]
    assert feed.numbers() == list(range(feed.sent)) and feed.files(2024, 1) == 1 and feed.files(2024, 2) >= 6
    assert compaction.compact(spark, feed.output, before) == []
    feed.send((2024, 1), (2024, 3))
    assert feed.numbers() == list(range(feed.sent)) and feed.files(2024, 1) > 1
    assert compaction.compact(spark, feed.output, datetime.date(2024, 3, 1)) == [(2024, 1), (2024, 2)]
    assert feed.numbers() == list(range(feed.sent)) and (feed.files(2024, 1), feed.files(2024, 2)) == (1, 1)
    assert compaction.drop_superseded(spark, feed.output) == 1
    assert feed.numbers() == list(range(feed.sent)) and feed.files(2024, 1) == 1


def test_what_the_stream_adds_during_a_compaction_is_neither_lost_nor_doubled(spark, tmp_path, monkeypatch):
    feed = Feed(spark, str(tmp_path))
    feed.send((2024, 1))
    feed.send((2024, 1))
    real = compaction.commit_folder

    def late(*args):
        feed.send((2024, 1))
        return real(*args)

    monkeypatch.setattr(compaction, "commit_folder", late)
    assert compaction.compact(spark, feed.output, datetime.date(2024, 5, 1)) == [(2024, 1)]
    assert feed.numbers() == list(range(18))


def test_a_failed_compaction_is_not_seen(spark, tmp_path, monkeypatch):
    feed = Feed(spark, str(tmp_path))
    feed.send((2024, 1))
    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(compaction, "commit_folder", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        compaction.compact(spark, feed.output, datetime.date(2024, 5, 1), least_files=1)
    assert feed.numbers() == list(range(6))
    assert compaction.compact(spark, feed.output, datetime.date(2024, 5, 1), least_files=1) == [(2024, 1)]
    assert feed.numbers() == list(range(6))


@pytest.fixture
def stored(spark, tmp_path):
    rows = spark.createDataFrame(events(3, 500, days=120), EVENT)
    full = {c: F.lit(None).cast("string").alias(c) for c in serving.SERVING_EVENT_COLUMNS if c not in rows.columns}
    frame = rows.select("*", *full.values())
    write_months(frame, str(tmp_path / "store"))
    return frame, spark.read.parquet(str(tmp_path / "store"))


@pytest.mark.parametrize("limit", [1, 40, 300, 490, 1000])
def test_newest_rows_come_from_the_newest_months(stored, limit):
    frame, store = stored
    assert sorted(map(repr, board.recent_events(store, limit).collect())) == sorted(map(repr, serving.recent_events(frame, limit).collect()))


def test_bounds_and_days(stored):
    frame, store = stored
    assert board.event_date_bounds(store).first() == serving.event_date_bounds(frame).first()
    for day in (None, START.date(), datetime.date(2030, 1, 1)):
        got, want = board.on_date(store, day).drop("event_month"), serving.on_date(frame, day)
        assert sorted(map(repr, got.select(*frame.columns).collect())) == sorted(map(repr, want.collect()))


def test_an_empty_store(stored):
    empty = stored[1].where("false")
    assert board.recent_events(empty).count() == 0 and board.on_date(empty).count() == 0
    assert tuple(board.event_date_bounds(empty).first()) == (None, None)


def test_months_and_row_groups_are_skipped(stored):
    _, store = stored
    plan = plan_of(board.on_date(store, START.date()))
    assert "event_month" in plan.split("PartitionFilters: ")[1].split("]")[0] and "GreaterThanOrEqual(event_timestamp" in plan
    assert "event_month" in plan_of(board.recent_events(store, 10)).split("PartitionFilters: ")[1].split("]")[0]
