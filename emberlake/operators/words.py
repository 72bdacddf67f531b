"""Word counts over text rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.functions.text import words


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    counted = df.select(words(F.col(column)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.col("count").desc(), "word")
