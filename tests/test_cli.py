import pytest

from emberlake import cli
from emberlake.session import new_work_dir, shared_dir, store_once
from emberlake.sources.files import read_anomaly_model
from test_files import data_dir  # noqa: F401


def run(spark, *argv):
    args = cli.parser().parse_args([str(a) for a in argv])
    args.action(spark, args)


def test_history_profile_and_anomaly_jobs(spark, data_dir, tmp_path, capsys):  # noqa: F811
    out = tmp_path / "out"
    run(spark, "history", "--data-dir", data_dir, "--output", out, "--years", 2024, 2026, "--raw-sample", "--raw-sample-rows", 2)
    assert spark.read.option("header", True).csv(f"{out}/raw_sample/year=2024").count() == 2
    assert spark.read.parquet(f"{out}/features").count() == 5
    run(spark, "profile", "--data-dir", data_dir, "--output", tmp_path / "profile", "--year", 2026)
    assert "2026-03-01 to 2026-05-01" in capsys.readouterr().out
    run(spark, "train-anomaly", "--features", f"{out}/features", "--model", tmp_path / "model", "--years", 2024)
    assert read_anomaly_model(spark, str(tmp_path / "model")).training_rows == 3


def test_defaults():
    args = cli.parser().parse_args(["train", "--features", "f", "--models", "m", "--reports", "r"])
    assert (args.rf_num_trees, args.rf_max_depth, args.gbt_max_iter, args.gbt_max_depth, args.seed) == (100, 8, 50, 5, 42)
    assert args.years_train == [2020, 2021, 2022, 2023, 2024] and args.years_test == [2026]
    assert (args.low_quantile, args.high_quantile) == (0.33, 0.66)
    args = cli.parser().parse_args(["history", "--data-dir", "d", "--output", "o"])
    assert cli._years(args) == [2026]
    args = cli.parser().parse_args(["stream", "ingest", "--kafka-bootstrap", "b:1"])
    assert {t.servers for t in vars(cli._topics(args)).values()} == {"b:1"}
    assert cli._topics(args).fire_to_score.per_trigger is None
    args = cli.parser().parse_args(["stream", "risk", "--models", "m", "--rate", "7"])
    assert (cli._topics(args).fire_to_score.per_trigger, cli._topics(args).fire.per_trigger) == (7, None)


def test_compaction_job(spark, tmp_path):
    from emberlake.streaming.run import drain
    from emberlake.sinks.streams import parquet_sink

    rows = spark.range(6).selectExpr("CAST(id AS TIMESTAMP) AS event_timestamp", "1970 AS year", "1 AS month")
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    drain(parquet_sink(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/c"))
    run(spark, "compact", "--stream", tmp_path / "out", "--compacted", tmp_path / "compacted", "--before", "1971-01-01",
        "--least-files", 1, "--drop-superseded")
    assert spark.read.parquet(f"{tmp_path}/compacted/generation=0/rows").count() == 6


class Session:
    """Just enough of a session to ask where shared files go."""

    def __init__(self, master, configured=None):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: configured)})()


def test_shared_folder():
    assert shared_dir(Session("yarn", "hdfs:/shared")) == "hdfs:/shared"
    assert shared_dir(Session("local[2]")).endswith("emberlake-app")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("spark://host:7077"))
    assert new_work_dir(Session("yarn", "s3a://b/x/"), "a") != new_work_dir(Session("yarn", "s3a://b/x/"), "a")


def test_store_once_writes_a_table(spark):
    stored = store_once(spark.range(5), "numbers")
    assert len(stored.inputFiles()) > 0 and stored.count() == 5
