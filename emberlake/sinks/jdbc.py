"""Relational serving store over JDBC. The driver jar comes from the submit command."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Store:
    url: str
    user: str
    password: str
    schema: str = "public"
    driver: str = "org.postgresql.Driver"
    write_partitions: int | None = None

    def options(self, table: str) -> dict[str, str]:
        options = {
            "url": self.url, "dbtable": f"{self.schema}.{table}",
            "user": self.user, "password": self.password, "driver": self.driver,
        }
        if self.write_partitions:
            options["numPartitions"] = str(self.write_partitions)
        return options


def table_options(store: Store, table: str, mode: str) -> dict[str, str]:
    """``overwrite`` empties the table instead of dropping it, so its keys and views stay."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported mode: {mode}")
    return {**store.options(table), **({"truncate": "true"} if mode == "overwrite" else {})}


def write_table(df: DataFrame, store: Store, table: str, mode: str = "append") -> None:
    df.write.format("jdbc").options(**table_options(store, table, mode)).mode(mode).save()


def read_table(spark: SparkSession, store: Store, table: str) -> DataFrame:
    """Filters and columns asked of the result are pushed into the database."""
    return spark.read.format("jdbc").options(**store.options(table)).load()
