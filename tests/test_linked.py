"""Joins of two fact tables, streams with state, appends that survive failures, files bound by name."""

import datetime
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from emberlake.operators.enrichment import READING_VALUES, EnrichSettings, nearest_reading
from emberlake.plans import history, live
from emberlake.plans import linked as plans_linked
from emberlake.plans.registry import raw
from emberlake.schemas import RAW_ARCHIVE, SERVING_KEY
from emberlake.sinks import ledger
from emberlake.sinks.jdbc import Store
from emberlake.sinks.tables import write_months
from emberlake.sources.headers import read_by_header, with_year
from emberlake.streaming import linked
from emberlake.streaming.run import drain, state_on_disk

START = datetime.datetime(2024, 5, 1)
FIRE = "event_timestamp timestamp, latitude double, longitude double, frp double"
READING = ("event_timestamp timestamp, latitude double, longitude double, temperature double, humidity double, wind_speed double,"
           " wind_direction double, rainfall double, smoke double, air_quality_index int, source string")


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def reading(seconds, latitude, longitude, temperature=1.0):
    return (at(seconds), latitude, longitude, temperature, *[None] * 7)


def kilometres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return round(2 * 6371.0 * math.asin(math.sqrt(min(h, 1.0))), 3)


def nearest_by_hand(fires, readings, degrees, reach):
    columns, out = math.ceil(360 / degrees), {}
    for t, y, x, _ in fires:
        best = None
        for s, v, u, temperature, *_ in readings:
            gap = int(abs((t - s).total_seconds()))
            far_x = (math.floor(x / degrees) - math.floor(u / degrees)) % columns
            if gap <= reach and abs(math.floor(y / degrees) - math.floor(v / degrees)) <= 1 and far_x in (0, 1, columns - 1):
                found = (gap, kilometres(y, x, v, u), s, v, u, temperature)
                best = min(best, found) if best else found
        out[t, y, x] = best and (best[0], best[1], best[2], best[5])
    return out


def crowd(seed, fires, readings):
    """A third of both sides in one cell and hour, some across the date line."""
    draw = random.Random(seed)
    place = lambda: (40.04, -100.03) if draw.random() < 0.34 else (round(draw.uniform(39.7, 40.3), 3), draw.choice([round(draw.uniform(-100.3, -99.7), 3), 179.99, -179.98]))
    when = lambda: at(draw.randrange(3600) if draw.random() < 0.5 else draw.randrange(20 * 3600))
    return ([(when(), *place(), float(i)) for i in range(fires)],
            [(when(), *place(), float(draw.randrange(50)), *[None] * 7) for _ in range(readings)])


@pytest.mark.parametrize("settings", [EnrichSettings(), EnrichSettings(rows_per_salt=10), EnrichSettings(cell_degrees=0.07, reach_seconds=900)])
def test_nearest_reading_equals_all_pairs(spark, settings):
    fires, readings = crowd(4, 150, 120)
    found = nearest_reading(spark.createDataFrame(fires, FIRE), spark.createDataFrame(readings, READING), settings)
    assert found.columns == ["event_timestamp", "latitude", "longitude", "frp", "reading_time", "gap_seconds", "distance_km", *READING_VALUES]
    wanted, rows = nearest_by_hand(fires, readings, settings.cell_degrees, settings.reach_seconds), found.collect()
    assert len(rows) == len(fires) and any(r.gap_seconds is None for r in rows) and sum(r.gap_seconds is not None for r in rows) > 30
    for r in rows:
        got = None if r.gap_seconds is None else (r.gap_seconds, r.distance_km, r.reading_time, r.temperature)
        assert got == wanted[r.event_timestamp, r.latitude, r.longitude]


def test_nearest_reading_without_a_side_or_a_key(spark):
    fires = spark.createDataFrame([(at(0), None, 1.0, 2.0), (None, 1.0, 1.0, 3.0), (at(0), 1.0, 1.0, 4.0)], FIRE)
    none = spark.createDataFrame([], READING)
    assert [r.gap_seconds for r in nearest_reading(fires, none).collect()] == [None] * 3
    assert nearest_reading(fires.where("false"), none).isEmpty()
    assert "NestedLoop" not in plan_of(nearest_reading(fires, none)) and "Cartesian" not in plan_of(nearest_reading(fires, none))


def test_nearest_reading_copies_no_detection(spark):
    """Copies in the rows of an explode that reads a detection's time or cell would grow the larger side."""
    fires, readings = crowd(5, 20, 20)
    plan = plan_of(nearest_reading(spark.createDataFrame(fires, FIRE), spark.createDataFrame(readings, READING)))
    copying = [line for line in plan.splitlines() if "Generate" in line]
    assert copying and not any(re.search(r"\bat#", line) or re.search(r"[\[ ]latitude#", line) for line in copying)


def test_nearest_reading_divides_many_detections(spark):
    fires, readings = (spark.createDataFrame(rows, kind) for rows, kind in zip(crowd(7, 200, 60), (FIRE, READING)))
    settings = EnrichSettings(rows_per_task=10)
    divided = nearest_reading(fires, readings, settings, detections=200)
    assert "block_y" in plan_of(divided) and re.search(r"hashpartitioning\(block_y#.*, 20\)", plan_of(divided))
    assert sorted(map(str, divided.collect())) == sorted(map(str, nearest_reading(fires, readings, settings).collect()))


def test_nearest_reading_broadcasts_no_table(spark):
    """Rows whose files or shuffles are small once compressed look small enough for the driver, and are not."""
    fires, readings = (spark.createDataFrame(rows, kind) for rows, kind in zip(crowd(8, 40, 40), (FIRE, READING)))
    found = nearest_reading(fires, readings, detections=40)
    found.collect()
    joins = [line for line in plan_of(found).split("Initial Plan")[0].splitlines() if "Join" in line]
    assert sum("SortMergeJoin" in line for line in joins) == 4 and not any("Inner" in line and "Broadcast" in line for line in joins)


def test_nearest_reading_with_repeated_detections(spark):
    fires, readings = crowd(6, 12, 40)
    twice = nearest_reading(spark.createDataFrame(fires * 3, FIRE), spark.createDataFrame(readings + readings[:9], READING))
    once = nearest_reading(spark.createDataFrame(fires, FIRE), spark.createDataFrame(readings, READING))
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect() * 3))


def test_dedup_stream_keeps_its_state_on_disk(spark, tmp_path):
    """Without it the state of every key lies in executors' heaps, as .delta files beside the checkpoint tell."""
    def drained(rows, name):
        spark.createDataFrame(rows, FIRE).write.mode("append").parquet(str(tmp_path / "in"))
        live = spark.readStream.schema(FIRE).parquet(str(tmp_path / "in"))
        drain(linked.distinct_events(live).writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-checkpoint")))
        return {f.suffix for f in (tmp_path / f"{name}-checkpoint" / "state").rglob("*.*") if not f.name.startswith((".", "_"))}

    provider, rows = "spark.sql.streaming.stateStore.providerClass", [(at(i), 1.0, float(i % 7), 2.0) for i in range(20)]
    before = spark.conf.get(provider, None)
    with state_on_disk(spark):
        assert ".delta" not in drained(rows, "out") and ".changelog" in drained(rows[5:], "out")
    assert spark.conf.get(provider, None) == before and ".delta" in drained(rows[:1], "other")
    assert sorted(r.event_timestamp for r in spark.read.schema(FIRE).parquet(str(tmp_path / "out")).collect()) == [r[0] for r in rows]


def test_dedup_query_asks_for_state_on_disk(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(plans_linked, "drain", lambda *w: seen.append(spark.conf.get("spark.sql.streaming.stateStore.providerClass")) or drain(*w))
    assert plans_linked.stream_dedup(spark, sf_dir).count() > 0
    assert len(seen) == plans_linked.SLICES and all("RocksDB" in s for s in seen)


def test_recurrence_pairs_no_days_of_a_cell(spark):
    """One join only, that of the detections with their own cell and day."""
    fires = [(at(86400 * d), 1.01, 2.02, 1.0) for d in range(40)] * 2
    found = linked.recurrence(spark.createDataFrame(fires, FIRE), spark.createDataFrame(fires, FIRE))
    assert sum("Join" in line for line in plan_of(found).splitlines()) == 1 and "Window" in plan_of(found)
    assert sorted(r.earlier_fires for r in found.collect()) == sorted(2 * min(d, 30) for d in range(40) for _ in range(2))


def test_recurrence_counts_earlier_days_and_opens_their_months_only(spark, tmp_path):
    stored = [(at(-86400 * d), 1.01, 2.02, 1.0) for d in (1, 1, 29, 30, 31, 400)] + [(at(0), 1.01, 2.02, 1.0), (at(-86400), 1.2, 2.02, 1.0)]
    write_months(spark.createDataFrame(stored, FIRE), str(tmp_path / "store"))
    fires = spark.createDataFrame([(at(60), 1.05, 2.09, 9.0), (at(60), 5.0, 5.0, 9.0), (None, 1.0, 2.0, 9.0)], FIRE)
    read = linked.with_stored_events(lambda session: session.read.parquet(str(tmp_path / "store")))
    assert sorted(r.earlier_fires for r in read(fires).collect()) == [0, 0, 4]
    assert "event_month" in [line for line in plan_of(read(fires)).splitlines() if "PartitionFilters" in line][0].split("PartitionFilters")[1]


def test_stream_join_drops_state_behind_the_watermark(spark, tmp_path):
    sides = {"fire": FIRE, "reading": READING}
    for i in range(4):
        hours = i * 12
        spark.createDataFrame([(at(3600 * hours), 1.0, 1.0, 1.0)], FIRE).write.mode("append").parquet(str(tmp_path / "fire"))
        spark.createDataFrame([reading(3600 * hours + 60, 1.0, 1.0), reading(3600 * hours + 7200, 1.0, 1.0)], READING).write.mode("append").parquet(str(tmp_path / "reading"))
        fire, env = (spark.readStream.schema(sides[n]).parquet(str(tmp_path / n)) for n in sides)
        writer = (linked.fires_with_readings(fire, env).writeStream.outputMode("append").format("parquet")
                  .option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")))
        progress = drain(writer)[0].recentProgress
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert progress[-1].stateOperators[0].numRowsTotal <= 6 < 12


def test_stream_dedup_holds_only_recent_keys(spark, tmp_path):
    for i in range(4):
        day = [(at(86400 * 3 * i + s), 1.0, float(s), 1.0) for s in range(20)]
        spark.createDataFrame(day + day[:5], FIRE).write.mode("append").parquet(str(tmp_path / "in"))
        rows = linked.distinct_events(spark.readStream.schema(FIRE).parquet(str(tmp_path / "in")))
        writer = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out"))
        progress = drain(writer)[0].recentProgress
    assert spark.read.parquet(str(tmp_path / "out")).count() == 80
    assert progress[-1].stateOperators[0].numRowsTotal <= 40


# Appends and replacements -------------------------------------------------------------------

def test_a_batch_that_failed_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    base, rows = str(tmp_path / "t"), spark.createDataFrame([(at(1), 1.0, 1.0, 1.0), (at(1), 1.0, 1.0, 0.5), (at(2), None, 1.0, 1.0)], FIRE)
    write = ledger.append_once(base, SERVING_KEY)
    with monkeypatch.context() as patched:
        patched.setattr(ledger, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            write(rows, 7)
    assert ledger.read_committed(spark, base, rows.schema).isEmpty() and not ledger.is_committed(spark, base, 7)
    write(rows, 7)
    write(rows, 7)
    write(spark.createDataFrame([(at(1), 1.0, 1.0, 9.0), (at(3), 1.0, 1.0, 9.0)], FIRE), 8)
    write(rows.where("false"), 9)
    assert sorted((r.event_timestamp, r.frp) for r in ledger.read_committed(spark, base, rows.schema).collect()) == [(at(1), 0.5), (at(3), 9.0)]


class Tables:
    """Stands for a database: what is saved is there to be loaded."""

    def __init__(self, spark, **schemas):
        self.spark, self.schemas, self.rows, self.calls, self.fail = spark, schemas, {n: [] for n in schemas}, [], None

    def load(self, spark, store, table):
        return self.spark.createDataFrame(self.rows[table], self.schemas[table])

    def save(self, df, store, table, mode):
        self.calls.append((table, mode))
        if self.fail == table:
            raise OSError("connection lost")
        self.rows[table] += [tuple(r) for r in df.collect()]


STORE = Store("jdbc:x", "u", "p")


def test_table_appends_add_only_what_is_missing(spark):
    tables = Tables(spark, fires=FIRE, stream_batches="table_name string, batch_id long")
    write = ledger.append_once_to_table(STORE, "fires", SERVING_KEY, load=tables.load, save=tables.save)
    rows = spark.createDataFrame([(at(1), 1.0, 1.0, 1.0), (at(2), 1.0, 1.0, 1.0)], FIRE)
    tables.fail = "stream_batches"
    with pytest.raises(OSError):
        write(rows, 0)  # rows are there, the ledger isn't
    tables.fail = None
    write(rows, 0)
    write(rows, 0)
    assert len(tables.rows["fires"]) == 2 and tables.rows["stream_batches"] == [("fires", 0)]
    assert tables.calls == [("fires", "append"), ("stream_batches", "append")] * 2


def test_served_batches_keep_their_refused_rows(spark, tmp_path):
    columns = {"event_timestamp": F.lit(at(5)).cast("timestamp"), "latitude": F.col("id").cast("double"), "longitude": F.lit(1.0), "predicted_frp": F.lit(2.0)}
    rows = spark.range(4).select(*[c.alias(n) for n, c in columns.items()]).withColumn("latitude", F.when(F.col("latitude") < 3, F.col("latitude")))
    rows.write.parquet(str(tmp_path / "in"))
    saved = []
    live_rows = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    drain(live.serve(live_rows, STORE, "fire_size_predictions", str(tmp_path / "c"), save=lambda df, *a: saved.append(df.count()), rejected=str(tmp_path / "no")))
    assert saved == [3] and spark.read.parquet(str(tmp_path / "no")).count() == 1


def test_a_failed_run_leaves_the_years_as_they_were(spark, sf_dir, tmp_path, monkeypatch):
    layout, rows = history.Layout.under(str(tmp_path / "out")), raw(spark, sf_dir).where("source_year IN (1996, 1997)")
    history.process(spark, rows, [1996, 1997], layout)
    before = {b: spark.read.parquet(b).count() for b in (layout.checked, layout.curated, layout.features)}
    for step in ("write_years", "batch_features"):
        with monkeypatch.context() as patched:
            patched.setattr(history, step, lambda *a: (_ for _ in ()).throw(OSError("disk full")))
            with pytest.raises(OSError):
                history.process(spark, rows.limit(5), [1996, 1997], layout)
        assert before == {b: spark.read.parquet(b).count() for b in before}
    history.process(spark, rows.where("source_year = 1996").limit(0), [1996], layout)
    assert [r.year for r in spark.read.parquet(layout.curated).select("year").distinct().collect()] == [1997]


# Files by header ----------------------------------------------------------------------------

def test_files_are_bound_by_name(spark, tmp_path):
    folders = [str(tmp_path / y) for y in ("2023", "2024")]
    for folder in folders:
        (tmp_path / folder).mkdir()
    (tmp_path / "2023" / "a.csv").write_text("Longitude,latitude, frp ,odd\n10.5,1.5,3.5,x\n11.5,2.5,bad,y\n\n")
    (tmp_path / "2024" / "b.csv").write_text('latitude,longitude,confidence,type\n3.5,12.5,"n, really",2\n4.5,13.5, l,\n5.5,14.5,h,1\n')
    (tmp_path / "2024" / "empty.csv").write_text("latitude,longitude\n")
    rows = with_year(read_by_header(spark, folders), "{year}")
    assert rows.columns == [*RAW_ARCHIVE.names, "source_year"]
    got = sorted((r.source_year, r.latitude, r.longitude, r.frp, r.confidence, r.type) for r in rows.collect())
    assert got == [(2023, 1.5, 10.5, 3.5, None, None), (2023, 2.5, 11.5, None, None, None), (2024, 3.5, 12.5, None, "n, really", 2),
                   (2024, 4.5, 13.5, None, " l", None), (2024, 5.5, 14.5, None, "h", 1)]
    first = read_by_header(spark, folders, first_rows=1)
    assert sorted(r.latitude for r in first.collect()) == [1.5, 3.5]
    assert plan_of(rows).count("Scan text") + plan_of(rows).count("FileScan text") >= 1
    (tmp_path / "2024" / "bare.csv").write_text("1.0,2.0\n")
    with pytest.raises(Exception, match="no header"):
        read_by_header(spark, folders).collect()
