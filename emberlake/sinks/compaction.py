"""Small files of a stream's output rewritten into few, partition by partition, while the stream goes on.

The stream's own folder is left alone, since its log names the files. Beside it, generations hold the rows of partitions that
time has closed, each with a record of the stream files that its rows come from. A generation appears by one rename, and
readers honour the record: of a compacted partition they take the newest generation and such stream files as it doesn't name.
Rows that come late into a closed partition are thus seen at once, and the next compaction takes them in.
"""

from __future__ import annotations

import datetime
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.sinks.ledger import commit_folder, committed_folders, remove_folder

GENERATION = "generation"
FILE = "stream_file"


@dataclass(frozen=True)
class Output:
    """A stream's Parquet folder by ``year`` and ``month``, its schema, and the folder of its generations."""

    stream: str
    compacted: str
    schema: object

    def live(self, spark: SparkSession) -> DataFrame:
        """What the stream has committed, with the file of each row."""
        return spark.read.schema(self.schema).parquet(self.stream).withColumn(FILE, F.col("_metadata.file_path"))

    def generation(self, number: int, part: str) -> str:
        return f"{self.compacted}/{GENERATION}={number}/{part}"


def _generations(spark: SparkSession, output: Output) -> list[int]:
    found = (re.fullmatch(rf"{GENERATION}=(\d+)", name) for name in committed_folders(spark, output.compacted))
    return sorted(int(m[1]) for m in found if m)


def _months(rows: DataFrame, least_files: int) -> list[tuple[int, int]]:
    """As many as there are months; no column of the files is read for them."""
    files = rows.select("year", "month", FILE).dropna().distinct().groupBy("year", "month").agg(F.count(F.lit(1)).alias("files"))
    return sorted((r.year, r.month) for r in files.where(F.col("files") >= least_files).collect())


def _in(months: list[tuple[int, int]]) -> Column:
    """Literals on partition columns, so that other folders aren't opened."""
    by_year = defaultdict(list)
    for year, month in months:
        by_year[year].append(month)
    terms = [(F.col("year") == y) & F.col("month").isin(m) for y, m in by_year.items()]
    return F.coalesce(reduce(Column.__or__, terms, F.lit(False)), F.lit(False))


def _newest(spark: SparkSession, output: Output) -> dict[int, list[tuple[int, int]]]:
    """Generation by generation, the months of which it is the newest."""
    newest: dict[tuple[int, int], int] = {}
    for number in _generations(spark, output):
        for name in committed_folders(spark, output.generation(number, "rows")):
            year = int(name.removeprefix("year="))
            for inner in committed_folders(spark, f"{output.generation(number, 'rows')}/{name}"):
                newest[year, int(inner.removeprefix("month="))] = number
    held = defaultdict(list)
    for month, number in newest.items():
        held[number].append(month)
    return dict(held)


def _uncovered(spark: SparkSession, output: Output, live: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of compacted months in files that no record names. Records are names of files: the join moves these rows and them."""
    covered = spark.read.schema(f"{FILE} string").parquet(*[output.generation(n, "covered") for n in _generations(spark, output)])
    return live.where(_in(months)).join(covered.distinct(), FILE, "left_anti")


def _compacted(spark: SparkSession, output: Output, held: dict[int, list[tuple[int, int]]]) -> DataFrame:
    rows = [spark.read.schema(output.schema).parquet(output.generation(n, "rows")).where(_in(months)) for n, months in held.items()]
    return reduce(DataFrame.unionByName, rows)


def read_compacted(spark: SparkSession, output: Output) -> DataFrame:
    """All rows of the stream's output, each once."""
    live, held = output.live(spark), _newest(spark, output)
    if not held:
        return live.drop(FILE)
    months = [m for some in held.values() for m in some]
    rest = live.where(~_in(months)).unionByName(_uncovered(spark, output, live, months))
    return rest.drop(FILE).unionByName(_compacted(spark, output, held)).select(*output.schema.names)


def compact(spark: SparkSession, output: Output, before: datetime.date, least_files: int = 2,
            order: str = "event_timestamp") -> list[tuple[int, int]]:
    """Rewrites the months before that of ``before`` that have at least ``least_files`` files of the stream which no
    generation covers; returns these months.

    The list of files is fixed when ``live`` is made, so rows and record agree whatever the stream adds meanwhile.
    Adaptive execution sizes the files: small months become one, a large month is divided over tasks. Of two compactions
    at a time one commits, the other's work is dropped.
    """
    live, held = output.live(spark), _newest(spark, output)
    known = [m for some in held.values() for m in some]
    fresh = live if not known else live.where(~_in(known)).unionByName(_uncovered(spark, output, live, known))
    closed = [m for m in _months(fresh, least_files) if m < (before.year, before.month)]
    if not closed:
        return []
    fresh, again = fresh.where(_in(closed)), {n: [m for m in months if m in closed] for n, months in held.items()}
    again = {n: months for n, months in again.items() if months}
    rows = fresh.drop(FILE)
    if again:
        rows = rows.unionByName(_compacted(spark, output, again))
    staged = f"{output.compacted}/_staged-{uuid.uuid4().hex}"
    arranged = rows.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", order)
    arranged.write.partitionBy("year", "month").parquet(f"{staged}/rows")
    fresh.select(FILE).distinct().write.parquet(f"{staged}/covered")
    number = max(_generations(spark, output), default=-1) + 1
    return closed if commit_folder(spark, staged, f"{output.compacted}/{GENERATION}={number}") else []


def drop_superseded(spark: SparkSession, output: Output) -> int:
    """Removes months of generations that a newer one holds, once no reader of them is left. Records of files stay."""
    held, gone = _newest(spark, output), 0
    for number in _generations(spark, output):
        rows = output.generation(number, "rows")
        for name in committed_folders(spark, rows):
            for inner in committed_folders(spark, f"{rows}/{name}"):
                month = int(name.removeprefix("year=")), int(inner.removeprefix("month="))
                if month not in held.get(number, ()):
                    remove_folder(spark, f"{rows}/{name}/{inner}")
                    gone += 1
    return gone
