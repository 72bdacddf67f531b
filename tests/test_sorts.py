"""What the history job sorts: rows by a number that tells them apart first, and days instead of rows for its report."""

import re

from pyspark.sql import functions as F

from conftest import plan_of
from emberlake.operators import quality
from emberlake.plans import history

SCHEMA = "year int, latitude double, longitude double, acq_date string, brightness double, frp double"
ROWS = [(2020, 1.5, -3.0, "2020-01-02", 300.0, 1.0), (2020, -1.5, 3.0, "2020-01-01", None, 2.5), (2020, 0.0, None, None, 310.0, None),
        (2020, 7.0, 9.0, "2020-01-02", 301.0, 2.0), (2021, -0.0, 1.0, "2021-02-01", 5.0, -5.0), (2021, 0.0, 1.0, "2021-02-03", -5.0, 5.0),
        (None, 2.0, 2.0, "x", None, None)]


def sorts(df):
    """Leading columns of the plan's sorts."""
    return re.findall(r"Sort \[(?:knownfloatingpointnormalized\(normalizenanandzero\()?(\w+)#", plan_of(df))


def test_dedup_within_years_does_not_sort_by_year_first(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    checked = rows.withColumns({"acq_time": F.lit("0000"), "is_valid": F.lit(True)})
    kept = history.curate(checked)
    assert set(sorts(kept)) == {"latitude"}
    assert kept.count() == len(ROWS)
    assert kept.unionByName(kept).count() == history.curate(checked.unionByName(checked)).count() * 2


def test_report_figures_come_from_days(spark):
    figures = quality.output_metrics(spark.createDataFrame(ROWS, SCHEMA), ["year"])
    plan = plan_of(figures)
    # the rows themselves are hashed by day; only days are sorted
    assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate") and "acq_date" in plan[plan.rindex("HashAggregate"):]
    assert {r.year: tuple(r)[1:] for r in figures.collect()} == {
        2020: (4, -1.5, 7.0, -3.0, 9.0, "2020-01-01", "2020-01-02", 300.0, 310.0, 1.0, 2.5, 303.67, 1.83),
        2021: (2, 0.0, 0.0, 1.0, 1.0, "2021-02-01", "2021-02-03", -5.0, 5.0, -5.0, 5.0, None, None),
        None: (1, 2.0, 2.0, 2.0, 2.0, "x", "x", None, None, None, None, None, None)}
