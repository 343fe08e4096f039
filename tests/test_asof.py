"""The linear as-of match equals brute force, on hot keys, bursts, ties and repeated ids."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, tracks

BASE = 1_704_067_200


def _brute(events, fixes, tol):
    out = {}
    for eid, k, t in events:
        near = [(abs(ft - t), fid, v) for fid, fk, ft, v in fixes
                if k is not None and t is not None and None not in (fid, ft) and fk == k and (eid is None or fid != eid) and abs(ft - t) <= tol]
        out[(eid, k, t)] = min(near, default=None)
    return out


def _frames(spark, events, fixes):
    at = lambda c: F.timestamp_seconds(F.lit(BASE) + F.col(c))
    ev = spark.createDataFrame(events, "eid long, ek string, et long").withColumn("ets", at("et"))
    fx = spark.createDataFrame(fixes, "fid long, fk string, ft long, v long").withColumn("fts", at("ft"))
    return ev, fx


def _got(spark, events, fixes, tol):
    ev, fx = _frames(spark, events, fixes)
    r = asof.nearest_other(ev, fx, ("ek", "fk"), ("ets", "fts"), ("eid", "fid"), ["v"], tol).collect()
    return {(x["eid"], x["ek"], x["et"]): x["nearest"] and (x["nearest"]["dt"] // 1_000_000, x["nearest"]["id"], x["nearest"]["v"]) for x in r}


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("span", [12, 4000])
def test_equals_brute_force(spark, seed, span):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 3 + ["a", "b", "c", "d", "e"])
    # few instants: ties and bursts; few ids: own records at several instants
    fixes = [(rng.randrange(40 if seed % 2 else 1000), key(), rng.randrange(span), rng.randrange(5)) for _ in range(400)]
    fixes += [(None, "hot", 3, 1), (5, None, 3, 1), (6, "hot", None, 1), *fixes[:20]]
    events = {(rng.randrange(60), key(), rng.randrange(span)) for _ in range(200)} | {(7, "nobody", 5), (8, None, 5), (9, "hot", None), (None, "hot", 6)}
    for tol in (0, 3) if seed else (10**6,):
        assert _got(spark, list(events), fixes, tol) == _brute(events, fixes, tol)


def test_runs_of_one_id_and_empty_sides(spark):
    # the event's own record at many instants around it: the nearest other one lies beyond the whole run
    fixes = [(1, "a", t, t) for t in range(100, 200)] + [(2, "a", 50, 0), (3, "a", 260, 0)]
    events = [(1, "a", 150), (4, "a", 150), (1, "a", 40), (1, "a", 300)]
    assert _got(spark, events, fixes, 10**6) == _brute(events, fixes, 10**6)
    assert _got(spark, events, [], 10) == dict.fromkeys(events)
    assert _got(spark, [], fixes, 10) == {}


def test_a_burst_does_not_multiply_rows(spark):
    """A vessel with all rows in six hours: no join of the plan emits more rows than both tables hold."""
    n = 30_000
    pos = spark.range(n).select(F.col("id").alias("event_id"), F.when(F.col("id") % 50 == 0, F.lit(2)).otherwise(F.lit(1)).alias("mmsi"),
                                F.timestamp_seconds(F.lit(BASE) + F.col("id") % 20_000).alias("ts"),
                                F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))
    ev = pos.where("event_id % 3 = 0").select("event_id", F.col("mmsi").alias("vessel_mmsi"), F.col("ts").alias("event_time"),
                                              F.lit("SIN").alias("port_id"), F.lit("ARRIVAL").alias("event_type"))
    got = tracks.event_position_match(ev, pos)
    assert got.count() == n // 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    # every equi-join of the match is on (key, instant) or (key, bucket): never on the key alone
    joins = re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)\S* \[([^\]]*)\]", plan)
    assert joins and all("," in j for j in joins)
