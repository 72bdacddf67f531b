"""The physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from emberlake.operators import dedup, labels, profiling, serving
from emberlake.plans.registry import QUERIES, canonical, raw
from emberlake.sinks.tables import write_years
from emberlake.sources.files import read_partitioned

LAZY = [n for n in QUERIES if not n.startswith(("stream_", "train_", "history_", "csv_", "score_"))
        and n not in ("select_best", "anomaly_model_document", "file_listing", "raw_sample", "text_messages",
                      "word_count_csv")]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_pair_products(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_dedup_reduces_before_it_shuffles(spark, sf_dir):
    plan = plan_of(dedup.drop_duplicate_detections(canonical(spark, sf_dir)))
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2 and limit > exchange


def test_a_key_with_a_third_of_the_rows_shuffles_a_few(spark):
    rows = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("k"), "id")
    kept = dedup.keep_one(rows, ["k"])
    assert kept.where("k = 1").count() == 1 and kept.count() == 60_001 - 1
    kept.collect()
    written = shuffle_records(kept)
    assert written <= 60_000 + 8


def shuffle_records(df):
    """Records the executed plan sent through its exchange."""
    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
        elif "QueryStage" in name:
            yield from walk(node.plan())
        else:
            if name == "Exchange":
                yield node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            for i in range(children.size()):
                yield from walk(children.apply(i))

    return sum(walk(df._jdf.queryExecution().executedPlan()))


def test_year_filter_prunes_folders_and_columns(spark, tmp_path):
    base = str(tmp_path / "t")
    write_years(spark.range(100).selectExpr("id * 1D AS frp", "id AS other", "CAST(2020 + id % 3 AS INT) AS year"), base)
    plan = plan_of(read_partitioned(spark, base, [2021]).where("frp > 5").select("frp"))
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [(year" in plan
    assert "GreaterThan(frp,5.0)" in plan and "ReadSchema: struct<frp:double>" in plan


def test_profile_of_duplicates_reads_key_columns_only(spark, sf_dir):
    plan = plan_of(profiling.duplicate_profile(raw(spark, sf_dir), ["source_year"]))
    schema = plan[plan.index("ReadSchema"):]
    assert "l_extendedprice" not in schema and "l_quantity" not in schema
    assert plan.count("partial_") >= 2


def test_top_lists_keep_a_bounded_heap(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(serving.recent_events(serving.event_rows(canonical(spark, sf_dir))))


def test_scores_need_no_shuffle(spark, sf_dir):
    from emberlake.operators import anomaly

    model = anomaly.ZScoreModel({c: (1.0, 2.0) for c in anomaly.FEATURES})
    plan = plan_of(anomaly.alerts(anomaly.score(canonical(spark, sf_dir), model)))
    assert "Exchange" not in plan and "*(1)" in plan


def test_labels_are_plain_columns(spark, sf_dir):
    assert "Exchange" not in plan_of(labels.risk_label(canonical(spark, sf_dir), 1.0, 2.0))
