import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from tidemark.llm import hard_negatives as hn
from tidemark.llm.queries import LLM_ORACLE, LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    part = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for n, (a, v, label) in enumerate(part):
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for m, (i, w, other) in enumerate(part) if m != n and len(w) == len(v))
        for s, i, _ in [x for x in scored if x[2] == label][:5]:
            near = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(near)]
    return sorted(out)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "label as dim", "vec_id as block", "vec_id as uid", "label as n")
    return sorted(tuple(r) for r in hn.hard_negatives(df.repartition(3)).collect())


def vectors(n, dim, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(int(i), [float(np.float32(v)) for v in r], int(rng.integers(0, 4))) for i, r in enumerate(x)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(0, 10**6), st.sampled_from([1, 300, 2**20, 2**30]))
def test_intervals_always_hold(dim, seed, top):
    rng = np.random.default_rng(seed)
    rows, q = rng.integers(-top, top + 1, (20, dim)), rng.integers(-top, top + 1, dim)
    rows[0], rows[1], rows[2] = 0, q, -q
    low, high = hn.Anchor(q).bounds(*hn.encode(rows))
    exact = [sum(int(a) * int(b) for a, b in zip(r, q)) for r in rows]
    if max(map(abs, exact)) < 2**63:
        assert hn.scores(rows, q).tolist() == exact
    assert all(lo <= s <= hi for lo, s, hi in zip(low, exact, high))


def test_codes_narrow_the_search():
    rows = np.array([[math.floor(256 * x) for x in v] for _, v, _ in vectors(2000, 64, 4)])
    low, high = hn.Anchor(rows[0]).bounds(*hn.encode(rows))
    exact = hn.scores(rows, rows[0])
    assert (high - low).mean() < 0.6 * 256 * 256  # of a range of 2 * 256 * 256
    assert (high < np.sort(exact)[-5]).mean() > 0.3  # many rows cannot be among the best five


def test_against_brute_force_with_a_hot_label_and_copies(spark):
    rows = vectors(420, 64, 1)
    rows += [(1000 + i, rows[100][1], 0) for i in range(60)]  # copies of an anchor
    rows = [(i, v, 0 if i % 3 == 0 else label) for i, v, label in rows]  # a label with a third of the rows
    want = brute(rows)
    assert len(want) > 20 and got(spark, rows) == want


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 2)
    rows = [(i, [v[0], -v[1], *v[2:]], label) for i, v, label in vectors(120, 5, 2)]
    rows += [(None, rows[0][1], 1), (200, None, 1), (300, [], 1), (400, [1.0, None, 1.0, 1.0, 1.0], 1), (500, rows[3][1], None),
             (600, [float("nan")] * 5, 1), (700, [float("inf")] * 5, 1), (100, rows[100][1], 2), (100, rows[7][1], rows[100][2]),
             (800, [0.5, 0.5], 1), (801, [0.5, 0.5], 1), (802, [0.5, 0.45], 2), (-100, rows[5][1], 9), (900, [0.0] * 5, 3), (901, [0.0] * 5, 3),
             (902, [0.0] * 5, 4)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(1, [1.0], 1)]) == [] and got(spark, [(100, [1.0], 1)]) == []


@pytest.mark.parametrize("check", ["sql"])
def test_query_against_sql(spark, check):
    df = LLM_QUERIES["op13_hard_negatives"](spark, SF_SMALL)
    n, problems = compare(df, duck(SF_SMALL), LLM_ORACLE["op13_hard_negatives"])
    assert not problems, problems
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert n == len(brute(rows))


def test_no_growing_table_is_broadcast(spark, monkeypatch):
    """Anchors were copied to every lane and broadcast: with few distinct vectors their files look small whatever their rows take."""
    plans = []

    def plan_of(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(hn, "staged", lambda df, name, own=hn.staged: own(plan_of(df), name))
    rows = vectors(300, 16, 3)
    df = spark.createDataFrame([(i + 1000 * k, v, label) for k in range(3) for i, v, label in rows], SCHEMA)
    plan_of(hn.hard_negatives(df))
    assert len(plans) == 4 and not [p for p in plans if "Broadcast" in p or "Cartesian" in p]


@pytest.mark.parametrize("cells, anchors, piece", [(64 * 40, 3, 64 * 7), (1 << 24, 512, 1 << 17)])
def test_lanes_give_the_same_rows(spark, monkeypatch, cells, anchors, piece):
    monkeypatch.setattr(hn, "LANE_CELLS", cells)
    monkeypatch.setattr(hn, "ANCHORS", anchors)
    monkeypatch.setattr(hn, "BLOCK_CELLS", piece)
    rows = [(i, v, i % 3) for i, v, _ in vectors(330, 64, 5)] + [(100 * i, [200.0 * x for x in v], 1) for i, v, _ in vectors(6, 64, 6)]
    rows += [(100, rows[100][1], 1), (200, rows[200][1], 2)]
    want = brute(rows)
    assert len(want) > 20 and got(spark, rows) == want
