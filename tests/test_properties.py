"""Property checks: column-selection rules; driver-side and Spark phase rules agree."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import control
from tidemark.plans.sync import _phase_batch_size, _phase_of
from tidemark.plans.specs import TableSpec
from tidemark.sources.tables import ColumnSelectionError, normalize_columns

names = st.text(alphabet="abcdefghij_", min_size=1, max_size=8)


@given(st.lists(names, min_size=0, max_size=6), st.booleans())
@settings(max_examples=200, deadline=None)
def test_normalize_columns_property(cols, with_ts):
    padded = [f" {c} " for c in cols] + ([" ts"] if with_ts else [])
    if not padded:
        try:
            normalize_columns(padded, "ts")
            raise AssertionError("empty list accepted")
        except ColumnSelectionError:
            return
    if with_ts:
        assert normalize_columns(padded, "ts") == [c.strip() for c in padded]
    else:
        try:
            normalize_columns(padded, "ts")
            assert "ts" in cols
        except ColumnSelectionError:
            assert "ts" not in cols


def test_driver_and_spark_phase_rules_agree(spark):
    rng = random.Random(7)
    as_of = dt.datetime(2024, 1, 31)
    lags = [0, 299, 300, 301, 3599, 3600, 3601] + [rng.uniform(0, 10000) for _ in range(300)]
    rows = [(float(x), as_of - dt.timedelta(seconds=x)) for x in lags]
    df = spark.createDataFrame(rows, "lag double, cursor timestamp")
    ph = control.sync_phase(control.lag_seconds(F.col("cursor"), "2024-01-31 00:00:00"))
    got = df.select("cursor", ph.alias("p"), control.batch_size_for(ph).alias("b")).collect()
    spec = TableSpec("t", "t", "ts", "t_copy")
    for r in got:
        assert r["p"] == _phase_of(r["cursor"], as_of)
        assert r["b"] == _phase_batch_size(spec, r["cursor"], as_of)
