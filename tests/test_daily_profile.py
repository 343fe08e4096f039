"""Profiles kept per day: batches, replays, replaced days, retention."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck
from tidemark.catalog import QUERIES, _positions
from tidemark.operators import coverage, profile
from tidemark.operators.daily_profile import DailyProfile
from tidemark.oracle import ORACLE
from tidemark.session import scratch_path

EXACT = ("total_records", "oldest_record", "newest_record")


def near(got, want, share=0.06):
    assert all(got[c] == want[c] for c in EXACT), (got, want)
    for c in ("unique_vessels", "vessel_types", "unique_positions"):
        assert abs(got[c] - want[c]) <= max(1, share * want[c]), (c, got, want)


def test_batches_replays_and_compaction_equal_one_profile(spark):
    pos = _positions(spark, SF_ORACLE).withColumn("b", F.pmod(F.col("event_id"), F.lit(5)))
    daily = DailyProfile(spark, scratch_path(spark, "daily"))
    daily.table.compact_every = 2
    for i in range(5):
        daily.add(pos.where(F.col("b") == i), i + 1)
        daily.add(pos.where(F.col("b") == i), i + 1)  # a retry of the same batch
    near(daily.profile().first(), profile.table_profile(pos, exact=True).first())
    want = {r["day"]: r["count"] for r in pos.groupBy(F.to_date("ts").alias("day")).count().collect()}
    assert {r["day"]: r["rows"] for r in daily.days().collect()} == want


def test_retention_drops_days_and_takes_the_boundary_day_again(spark):
    pos, daily = _positions(spark, SF_ORACLE), DailyProfile(spark, scratch_path(spark, "daily"))
    daily.table.compact_every = 1
    daily.add(pos, 1)
    as_of = "2024-01-31 06:30:00"
    kept = coverage.retained(pos, "ts", as_of, 10)
    daily.retain(kept, as_of, 10, 2)
    daily.retain(kept, as_of, 10, 2)
    near(daily.profile().first(), profile.table_profile(kept, exact=True).first())
    early = pos.where(F.col("ts") < "2024-01-03")  # rows that come after their days were dropped
    daily.add(early, 3)
    daily.add(pos.limit(0), 4)
    near(daily.profile().first(), profile.table_profile(kept.unionAll(early), exact=True).first())


@pytest.fixture
def odd(spark):
    t = [dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2), None]
    return spark.createDataFrame([(t[0], 1, "a", 1.0, 2.0), (t[1], 1, "a", 1.0, 2.0), (t[2], 2, None, None, 2.0), (t[3], None, "b", 1.0, 12.0)],
                                 "ts timestamp, mmsi long, vessel_type string, latitude double, longitude double")


def test_nulls_replaced_days_and_an_empty_table(spark, odd):
    daily = DailyProfile(spark, scratch_path(spark, "daily"))
    assert tuple(daily.profile().first()) == (0, None, None, 0, 0, 0)
    daily.add(odd, 1)
    assert tuple(daily.profile().first())[0] == 4 and tuple(daily.profile().first())[3:] == (2, 2, 2)
    daily.replace(odd.where("ts = '2024-01-01 05:00:00'").limit(1), 2)
    assert {(str(r["day"]), r["rows"]) for r in daily.days().collect()} == {("2024-01-01", 1), ("2024-01-02", 1), ("None", 1)}
    daily.retain(odd.limit(0), "2024-01-12 00:00:00", 10, 3)
    assert {str(r["day"]) for r in daily.days().collect()} == {"None"}


def test_query_against_sql(spark):
    n, problems = compare(QUERIES["daily_profile"](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE["daily_profile"])
    assert n == 1 and not problems
