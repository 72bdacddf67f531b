"""Headered CSV bound by column name, all files in one scan.

Files are read as lines together with where they come from. A file's header is found among its own lines and joined to
them by file, a row a file; the fields of a line are then taken by the place that the header gives them. So files with
other column orders, without some columns or with further ones go through one plan, without a branch a file or year and
without a list of files on the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from emberlake.schemas import RAW_ARCHIVE

SEPARATOR = ","
#: A header names this column; a row has a number there.
HEADER_COLUMN = "latitude"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.option("pathGlobFilter", "*.csv").text(paths)
    return lines.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth")).where("length(line) > 0")


def _is_header(line: Column) -> Column:
    return F.array_contains(F.transform(F.split(line, SEPARATOR), lambda x: F.lower(F.trim(x))), HEADER_COLUMN)


def read_by_header(spark: SparkSession, paths: list[str], schema: StructType = RAW_ARCHIVE, first_rows: int | None = None) -> DataFrame:
    """The columns of ``schema``, then ``file``: rows of all CSV files in the folders ``paths``.

    A column that a file lacks is NULL, one that the schema lacks is ignored; names are compared without case and outer
    blanks. A field that is not of its column's type is NULL. A file without rows gives none; one without a header is an
    error, since nothing tells what its fields are. ``first_rows`` takes the first so many rows of every file.
    """
    lines = _lines(spark, paths)
    is_header = _is_header(F.col("line"))
    headers = lines.where(is_header).groupBy("file").agg(F.min_by("line", F.struct("block", "nth")).alias("header"))
    # the widest header decides how many fields are parsed; one number, whatever the input
    width = headers.agg(F.max(F.size(F.split("header", SEPARATOR)))).first()[0] or len(schema)
    generic = StructType().add("c0", StringType())
    for i in range(1, width):
        generic = generic.add(f"c{i}", StringType())
    names = F.transform(F.split("header", SEPARATOR), lambda x: F.lower(F.trim(x)))
    places = headers.select(F.col("file").alias("of"), F.struct(*[F.array_position(names, f.name).alias(f.name) for f in schema]).alias("at"))
    rows = lines.where(~is_header)
    if first_rows is not None:
        place = F.row_number().over(Window.partitionBy("file").orderBy("block", "nth"))
        rows = rows.withColumn("place", place).where(F.col("place") <= first_rows)
    known = rows.join(places, rows["file"] == places["of"], "left").withColumn(
        "at", F.when(F.col("of").isNull(), F.raise_error(F.concat(F.lit("no header in "), F.col("file")))).otherwise(F.col("at")))
    parsed = known.select("file", "at", F.from_csv("line", generic.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"sep": SEPARATOR}).alias("c"))
    fields = parsed.select("file", "at", F.array(*[f"c.c{i}" for i in range(width)]).alias("fields"))

    def taken(name: str, kind) -> Column:
        value = F.when(F.col(f"at.{name}") > 0, F.get("fields", (F.col(f"at.{name}") - 1).cast("int")))
        return value.try_cast(kind).alias(name)

    return fields.select(*[taken(f.name, f.dataType) for f in schema], "file")


def with_year(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` with ``source_year`` in place of ``file``: the year that the file's folder is named after."""
    pattern = "/" + re.escape(folder).replace(re.escape("{year}"), "([0-9]+)") + "/[^/]*$"
    return rows.withColumn("source_year", F.regexp_extract("file", pattern, 1).try_cast("int")).drop("file")
