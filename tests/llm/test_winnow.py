import hashlib
import random
from collections import deque
from functools import cache

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.fixtures import empty_documents, odd_documents, prose
from tidemark.llm import winnow
from tidemark.llm.queries import LLM_QUERIES

K, W = winnow.K, winnow.W


def chosen(text):
    """[(hash, position)] by the definition."""
    if not text:
        return []
    grams = [text[i: i + K] for i in range(max(1, len(text) - K + 1))]
    keys = []
    for i, g in enumerate(grams):
        # the engine hashes the UTF-32 bytes with seed 42 and keeps bits 31 to 62
        h = xxhash.xxh64_intdigest(g.encode("utf-32-be"), seed=42)
        keys.append(((h & winnow._HASH_MASK) >> 31, i))
    out = []
    for s in range(max(1, len(keys) - W + 1)):
        window = keys[s: s + W]
        best = min(h for h, _ in window)
        pick = max(x for x in window if x[0] == best)
        if pick not in out[-1:]:
            out.append(pick)
    return out


def shown(text):
    return " ".join(f"{h:X}@{p}" for h, p in chosen(text))


def like(a, b):
    x, y = {h for h, _ in chosen(a)}, {h for h, _ in chosen(b)}
    return 1.0 if not x | y else len(x & y) / len(x | y)


def brute(rows):
    """rows: (doc_id, text)"""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    out = []
    for at, (i, t) in enumerate(rows):
        nxt = rows[(at + 1) % len(rows)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(t), shown(edited),
                    round(like(t, edited), 9), round(like(t, nxt), 9)))
    return sorted(out, key=str)


def result(df):
    return sorted(((*tuple(r)[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in df.collect()), key=str)


def test_query_against_the_definition(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    small = [r for r in docs if len(r[1] or "") < 4000]
    df = spark.createDataFrame(small, "doc_id long, text string")
    assert result(winnow.fingerprints_with_next(df)) == brute(small)
    got = LLM_QUERIES["op1_winnowing"](spark, SF_SMALL).collect()
    assert len(got) == len(docs) and {r["doc_id"]: r["n_chars"] for r in got} == {i: len(t or "") for i, t in docs}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"] if len(r["text"] or "") < 9000 else r["text"][:9000]) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as part", "text as guest")
    assert result(winnow.fingerprints_with_next(df)) == brute(rows)
    assert winnow.fingerprints_with_next(empty_documents(spark)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_few_rows_with_edge_lengths(spark, n):
    rng = random.Random(n)
    lengths = [0, 1, K - 1, K, K + 1, K + W - 2, K + W - 1, K + W, 41, 60, 80, 200]
    rows = [(rng.randrange(10 ** 12), "".join(rng.choice("ab é日🙂") for _ in range(rng.choice(lengths)))) for _ in range(n)]
    assert result(winnow.fingerprints_with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_shared_passage_is_always_found(spark):
    passage = prose(40, 5)[: K + W - 1]
    rows = [(i, prose(5 + i, i + 1) + passage + prose(9, 90 + i)) for i in range(20)]
    df = winnow.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"))
    sets = [set(r[0]) for r in df.select(winnow.hashes(F.col("fingerprint_keys"))).collect()]
    assert all(a & b for a in sets for b in sets)


def test_plan_is_native(spark):
    plan = winnow.fingerprints_with_next(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@cache
def chosen_linear(text):
    """``chosen`` in linear time: a queue of keys that only grow."""
    if not text:
        return []
    wide = text.encode("utf-32-be")
    keys = [(xxhash.xxh64_intdigest(wide[4 * i: 4 * (i + K)], seed=42) & winnow._HASH_MASK) >> 31 for i in range(max(1, len(text) - K + 1))]
    out, queue = [], deque()
    for i, h in enumerate(keys):
        while queue and keys[queue[-1]] >= h:  # of equals the rightmost one stays
            queue.pop()
        queue.append(i)
        if queue[0] <= i - W:
            queue.popleft()
        if i >= min(W, len(keys)) - 1 and (keys[queue[0]], queue[0]) not in out[-1:]:
            out.append((keys[queue[0]], queue[0]))
    return out


def test_registered_query_against_the_definition_with_long_texts(spark, monkeypatch):
    """Every column of every row of a whole table, whatever the texts' lengths."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    short = [t or "" for _, t in docs if len(t or "") < 1000][:60] + ["", "a", "ab" * 100, "a" * 50, "日é🙂" * 9]
    assert [chosen_linear(t) for t in short] == [chosen(t) for t in short]
    assert max(len(t or "") for _, t in docs) >= 4000
    got = result(LLM_QUERIES["op1_winnowing"](spark, SF_SMALL))
    monkeypatch.setitem(globals(), "chosen", chosen_linear)
    assert got == brute(docs)
