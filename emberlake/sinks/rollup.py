"""Figures per key that every micro-batch carries on, instead of being counted anew over all rows.

A batch is reduced to mergeable parts (counts, sums, extremes; an average is a sum and a count), a row a key, and committed
under its number as in :mod:`emberlake.sinks.ledger`, so a replay adds nothing. Readers merge the parts. ``fold`` merges
what has been committed into one folder from time to time, so readers open one folder and the batches since.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.sinks.ledger import BATCH, batch_folder, commit_folder, committed_folders, remove_folder, stage

log = logging.getLogger(__name__)

FOLD = "fold"


@dataclass(frozen=True)
class Rollup:
    """``parts`` are aggregates over rows; ``merge`` names the function (sum, min, max) that joins two of the same name."""

    keys: dict[str, Column]
    parts: dict[str, Column]
    merge: dict[str, str]

    def partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[c.alias(k) for k, c in self.keys.items()]).agg(*[c.alias(p) for p, c in self.parts.items()])

    def merged(self, partials: DataFrame) -> DataFrame:
        joined = {"sum": F.sum, "min": F.min, "max": F.max}
        return partials.groupBy(*self.keys).agg(*[joined[self.merge[p]](p).alias(p) for p in self.parts])


def _numbers(spark: SparkSession, base: str, kind: str) -> list[int]:
    found = (re.fullmatch(rf"{kind}=(\d+)", name) for name in committed_folders(spark, base))
    return sorted(int(m[1]) for m in found if m)


def _current(spark: SparkSession, base: str) -> tuple[int, list[str], list[int]]:
    """The newest fold (-1: none), the folders that hold all figures now, and the batches among them."""
    upto = max(_numbers(spark, base, FOLD), default=-1)
    since = [b for b in _numbers(spark, base, BATCH) if b > upto]
    folders = [f"{base}/{FOLD}={upto}"] * (upto >= 0) + [batch_folder(base, b) for b in since]
    return upto, folders, since


def carry_on(base: str, rollup: Rollup, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """A batch writer; batches come in the order of their numbers, as those of one streaming query do."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        upto, _, since = _current(spark, base)
        if batch_id <= upto or batch_id in since:
            log.info("batch %s is counted already", batch_id)
            return
        # A row a key, so few files; a batch may still have more keys than one task should write.
        small = rollup.partial(shape(batch))
        commit_folder(spark, stage(small, base, batch_id), batch_folder(base, batch_id))

    return write


def read_rollup(spark: SparkSession, base: str, rollup: Rollup, schema=None) -> DataFrame:
    """The merged figures of all committed batches; ``schema`` is needed only where nothing has been committed yet."""
    _, folders, _ = _current(spark, base)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return rollup.merged(reader.parquet(*folders))


def fold(spark: SparkSession, base: str, rollup: Rollup) -> int:
    """Merges all committed batches into one folder and removes what it replaces; returns the last batch in it.

    The new folder appears by one rename and says up to which batch it counts, so a failure before leaves the old
    folders in force, and one after it leaves some that readers pass over and the next fold removes.
    """
    upto, folders, since = _current(spark, base)
    if since:
        last = since[-1]
        merged = rollup.merged(spark.read.parquet(*folders))
        commit_folder(spark, stage(merged, base, last), f"{base}/{FOLD}={last}")
        upto = max(_numbers(spark, base, FOLD))
    for kind in (BATCH, FOLD):
        for number in _numbers(spark, base, kind):
            if number < upto or (number == upto and kind == BATCH):
                remove_folder(spark, f"{base}/{kind}={number}")
    return upto
