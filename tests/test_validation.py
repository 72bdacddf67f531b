import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from emberlake.operators import dedup, validation
from emberlake.operators.cleaning import clean
from helpers import canonical_frame, raw_frame, raw_row

NOON = datetime.datetime(2024, 9, 22, 9, 51)


def canonical(spark, *changes):
    rows = [{**raw_row(acq_time="09:51"), "event_timestamp": NOON, **c} for c in changes]
    return canonical_frame(spark, *rows)


@pytest.mark.parametrize("change, valid", [
    ({}, True),
    ({"latitude": 90.0}, True), ({"latitude": -90.0}, True), ({"latitude": 90.01}, False),
    ({"latitude": None}, False), ({"latitude": math.nan}, False),
    ({"longitude": 180.0}, True), ({"longitude": -180.01}, False), ({"longitude": None}, False),
    ({"event_timestamp": None}, False), ({"acq_date": "bad-date"}, False), ({"acq_date": None}, False),
    ({"acq_date": "2024-13-01"}, False),
    ({"brightness": 0.0}, False), ({"brightness": None}, True), ({"brightness": math.nan}, True),
    ({"bright_t31": 0.0}, False), ({"bright_t31": None}, True),
    ({"frp": 0.0}, True), ({"frp": -0.1}, False), ({"frp": None}, True),
    ({"scan": 0.0}, True), ({"scan": -1.0}, False), ({"track": -1.0}, False), ({"track": None}, True),
])
def test_boundaries(spark, change, valid):
    df = canonical(spark, change)
    assert validation.valid_rows(df).isEmpty() is not valid
    assert validation.quarantined_rows(df).isEmpty() is valid


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.fixed_dictionaries({
    "latitude": st.sampled_from([None, 10.0, 95.0]), "acq_time": st.sampled_from(["0", "1230", "2460", None]),
    "frp": st.sampled_from([None, -1.0, 2.0]), "brightness": st.sampled_from([0.0, 300.0, 301.0]),
}), min_size=1, max_size=12))
def test_split_and_dedup_keep_everything_accounted_for(spark, rows):
    cleaned = clean(raw_frame(spark, *[raw_row(**r) for r in rows]))
    valid, bad = validation.valid_rows(cleaned), validation.quarantined_rows(cleaned)
    assert valid.count() + bad.count() == len(rows)
    kept = dedup.drop_duplicate_detections(valid)
    keys = ["latitude", "longitude", "acq_date", "acq_time"]
    assert kept.count() == kept.select(keys).distinct().count() == valid.select(keys).distinct().count()


def test_survivor_does_not_depend_on_row_order(spark):
    changes = [{"frp": f} for f in (3.0, None, 1.0, 2.0)]
    for order in (changes, changes[::-1]):
        kept = dedup.drop_duplicate_detections(canonical(spark, *order).repartition(3)).collect()
        assert len(kept) == 1 and kept[0].frp is None


def test_serving_key(spark):
    df = canonical(spark, {"acq_time": "09:51"}, {"acq_time": "x"}, {"latitude": 1.0})
    assert dedup.drop_duplicate_events(df).count() == 2


def test_contract_report(spark):
    df = canonical(spark, {"confidence": "z"}, {"type": 9}, {"daynight": None, "acq_date": "2024-7-1"}, {})
    found = {r.rule: r.violations for r in validation.contract_report(df).collect()}
    assert {k: v for k, v in found.items() if v} == {"confidence": 1, "type": 1, "acq_date": 1}


def test_gates(spark):
    empty = canonical(spark, {}).where("false")
    assert validation.load_gate(empty).first().asDict() == {"row_count": 0, "passed": False}
    with pytest.raises(ValueError, match="no rows"):
        validation.require_rows(empty, "table")
