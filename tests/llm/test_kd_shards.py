import random
import zlib
from collections import defaultdict

from tests.conftest import SF_ORACLE
from tests.llm.fixtures import empty_documents, odd_documents
from tidemark.llm import kd_shards
from tidemark.llm.queries import LLM_QUERIES


def check(rows, docs, key=("doc_id", "size", "text_crc32")):
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs), key=str)
    assert sorted((tuple(r[k] for k in key) for r in rows), key=str) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_is_balanced_and_whole(spark):
    rows = LLM_QUERIES["op6_kd_shards"](spark, SF_ORACLE).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, docs)
    total = defaultdict(int)
    for r in rows:
        total[r["shard"]] += r["size"]
    mean, largest = sum(total.values()) / 40, max(r["size"] for r in rows)
    assert sorted(total) == list(range(40)) and all(abs(t - mean) <= largest for t in total.values())
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_hot_values_split(spark):
    """One source and one size hold nearly all rows: shards stay even."""
    rows = [(i, "x" * 50, "hot" if i % 9 else f"s{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    total = defaultdict(int)
    for r in kd_shards.kd_shards(df, 7, dims=("source", "size")).collect():
        total[r["shard"]] += r["size"]
    assert len(total) == 7 and max(total.values()) - min(total.values()) <= 8 * 66


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    for n in (1, 2, 5, 40):
        check(kd_shards.kd_shards(docs, n).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert kd_shards.kd_shards(empty_documents(spark), 4).collect() == []


def test_box_tree_is_deterministic(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    place = lambda df: sorted((r["doc_id"], r["shard"], r["slot"]) for r in kd_shards.kd_shards(df, 12).collect())
    assert place(docs) == place(docs.repartition(7))


def test_the_least_and_the_largest_ids(spark):
    ids = [-(1 << 63), -(1 << 63) + 1, (1 << 63) - 1, (1 << 63) - 2, 0, 7, None] + [(i * 0x9E3779B97F4A7C15) % (1 << 64) - (1 << 63) for i in range(200)]
    df = spark.createDataFrame([(i, "x" * 100, "s", "en") for i in ids], "doc_id long, text string, source string, lang string")
    got = kd_shards.kd_shards(df, 8).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i in ids)
    counts = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert max(counts) - min(counts) <= 2


def tree(rows, spans, leaves, first, out):
    """The k-d tree by its definition; rows: (codes, tie-break, size)."""
    if leaves == 1:
        out.update({r[1]: first for r in rows})
        return
    half = leaves // 2
    low, high = rows, []
    if len(rows) > 1:
        widths = [(max(r[0][i] for r in rows) - min(r[0][i] for r in rows)) / max(1, s) for i, s in enumerate(spans)]
        dim = widths.index(max(widths))
        want, below = sum(r[2] for r in rows) * half / leaves, 0
        for at in sorted({r[0][dim] for r in rows}):
            here = [r for r in rows if r[0][dim] == at]
            if below + sum(r[2] for r in here) >= want:
                break
            below += sum(r[2] for r in here)
        for r in sorted(here, key=lambda r: r[1]):
            if below + r[2] >= want:
                edge = r[1] - 1 if abs(below - want) <= abs(below + r[2] - want) else r[1]
                break
            below += r[2]
        goes_left = lambda r: r[0][dim] < at or (r[0][dim] == at and r[1] <= edge)
        low, high = [r for r in rows if goes_left(r)], [r for r in rows if not goes_left(r)]
    tree(low, spans, half, first, out)
    tree(high, spans, leaves - half, first + half, out)


def test_splits_against_a_tree_by_its_definition(spark):
    """Weighted medians on the widest dimension; strings equal in their first bytes and fractions count by rank."""
    rng = random.Random(3)
    docs = [(i, "x" * rng.choice((3, 40, 41, 300)), None if i % 17 == 0 else f"https://example-{rng.randrange(30):03d}",
             rng.randrange(40) / 97) for i in range(240)]
    names = sorted({d[2] for d in docs if d[2]})
    quality = sorted({d[3] for d in docs})
    rows = [((names.index(s) if s else -1, quality.index(q), len(t) + 16), i, len(t) + 16) for i, t, s, q in docs]
    spans = [max(r[0][i] for r in rows) - min(r[0][i] for r in rows) for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, quality double").repartition(5)
    for shards in (2, 7, 16):
        want: dict = {}
        tree(rows, spans, shards, 0, want)
        got = kd_shards.kd_shards(df, shards, dims=("source", "quality", "size")).collect()
        assert {r["doc_id"]: r["shard"] for r in got} == want


def test_value_ranks(spark):
    values = [None, "", "a", "aaaaaaaa1", "aaaaaaaa2", "é", "aaaaaaaa1"]
    got = kd_shards.value_ranks(spark.createDataFrame([(v,) for v in values], "rank string"), "rank").collect()
    assert sorted((r["rank"], r["value"]) for r in got) == list(enumerate(["", "a", "aaaaaaaa1", "aaaaaaaa2", "é"]))
