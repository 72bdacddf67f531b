"""Queries over what streams leave behind (figures carried on, compacted output) and over the board's store by month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators import anomaly, board, features, serving
from emberlake.operators.alerts import from_messages
from emberlake.plans.linked import SLICES, linked_fire_feed, time_slices
from emberlake.plans.registry import fitted, live_fire, query, served_events
from emberlake.schemas import FIRE_EVENT, SERVING_KEY
from emberlake.session import new_work_dir
from emberlake.sinks.compaction import Output, compact, drop_superseded, read_compacted
from emberlake.sinks.rollup import Rollup, carry_on, fold, read_rollup
from emberlake.sinks.streams import batch_sink, parquet_sink
from emberlake.sinks.tables import write_months
from emberlake.sources.streams import Topic, read_messages, read_messages_once, send
from emberlake.streaming import flows
from emberlake.streaming.run import drain


@query
def stream_daily_kpis(spark, sf_dir):
    """Daily figures carried on over several micro-batches, one of them replayed, folded in between."""
    base, rollup = new_work_dir(spark, "daily-kpis"), Rollup(*serving.daily_fire_parts())
    write = carry_on(f"{base}/figures", rollup, flows.fire_rows)
    slices = time_slices(linked_fire_feed(spark, sf_dir), parts=SLICES)
    for i, part in enumerate(slices):
        send(part, Topic(f"{base}/fire", format="text"), "append")
        drain(batch_sink(read_messages(spark, Topic(f"{base}/fire", format="text")), write, f"{base}/checkpoint"))
        write(part, i)
        if i == 1:
            fold(spark, f"{base}/figures", rollup)
            write(slices[0], 0)
    return serving.daily_fire_figures(read_rollup(spark, f"{base}/figures", rollup))


@query
def stream_anomaly_days(spark, sf_dir):
    """The anomaly summary carried on by the scoring stream."""
    base, rollup, model = new_work_dir(spark, "anomaly-days"), Rollup(*serving.anomaly_parts()), fitted(spark, sf_dir)

    def shape(batch: DataFrame) -> DataFrame:
        return anomaly.score(features.stamp_event(from_messages(batch, FIRE_EVENT)), model)

    rows = read_messages(spark, live_fire(spark, sf_dir, base))
    drain(batch_sink(rows, carry_on(f"{base}/figures", rollup, shape), f"{base}/checkpoint"))
    return serving.anomaly_figures(read_rollup(spark, f"{base}/figures", rollup))


@query
def stream_compacted(spark, sf_dir):
    """The ingest stream's output, compacted twice between batches: before and after a month gets late rows."""
    base = new_work_dir(spark, "compacted")
    topic = Topic(f"{base}/fire", format="text")
    late, *slices = time_slices(linked_fire_feed(spark, sf_dir), parts=SLICES + 1)
    output = None
    for part in (slices[0], slices[1], late, slices[2]):
        send(part, topic, "append")
        output = output or Output(f"{base}/out", f"{base}/compacted", flows.fire_rows(read_messages_once(spark, topic)).schema)
        drain(parquet_sink(flows.fire_rows(read_messages(spark, topic)), output.stream, f"{base}/checkpoint"))
        compact(spark, output, date(2100, 1, 1))
        drop_superseded(spark, output)
    return read_compacted(spark, output).select(*SERVING_KEY, "frp", "bright_t31", "daynight", "year", "month")


def stored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "board")
    write_months(served_events(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def board_recent_events(spark, sf_dir):
    return board.recent_events(stored_months(spark, sf_dir))


@query
def board_map_points(spark, sf_dir):
    return serving.map_points(board.on_date(stored_months(spark, sf_dir)))


@query
def board_date_bounds(spark, sf_dir):
    return board.event_date_bounds(stored_months(spark, sf_dir))


@query
def board_busiest_day(spark, sf_dir):
    """The table of a chosen day: the one with most events, the earliest of several."""
    store = stored_months(spark, sf_dir)
    days = serving.daily_fire_kpis(store).where("event_date IS NOT NULL")
    busiest = days.orderBy(F.col("fire_count").desc(), "event_date").first()
    return serving.recent_table(board.on_date(store, busiest.event_date))
