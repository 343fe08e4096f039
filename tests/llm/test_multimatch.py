import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tests.llm.fixtures import empty_documents, odd_documents, prose
from tidemark.llm import multimatch
from tidemark.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i: i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """{(doc_id, n, component)} over (doc_id, text) rows with distinct ids."""
    sets = {i: sets_of(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = result(LLM_QUERIES["op10_multimatch_jaccard"](spark, SF_SMALL))
    assert got == brute([tuple(r) for r in docs])


def chains(n, step):
    """Documents that drift: neighbours link, far ones do not; plus copies and a shared line."""
    base = prose(400, 5).split()
    rows = []
    for i in range(n):
        words = base[i * step: i * step + 60]
        rows.append((1000 - i, " ".join(words)))
        if i % 3 == 0:
            rows.append((2000 + i, " ".join(words).upper()))
    line = prose(30, 9)
    rows += [(3000 + i, line + " " + prose(8 + i, 50 + i)) for i in range(25)]
    rows += [(4000, "a b c"), (4001, "A  b\tc"), (4002, "a b"), (4003, ""), (4004, None), (4005, " \n ")]
    return rows


@pytest.mark.parametrize("step", [3, 5, 9])
def test_chains_copies_and_shared_lines(spark, step):
    rows = chains(30, step)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(multimatch.jaccard_components(df)) == brute(rows)


@pytest.mark.parametrize("rounds", [1, 3])
def test_pairs_missed_by_the_pivots_are_found(spark, monkeypatch, rounds):
    """Near copies of several bases that share a passage: pivots of the passage belong to other groups."""
    monkeypatch.setattr(multimatch, "ROUNDS", rounds)
    shared, rows = prose(24, 77), []
    for g in range(6):
        body = prose(30, 100 + g).split()
        for k in range(5):
            words = list(body)
            words[(7 * k) % 30] = f"edit{k}"
            rows.append((g * 10 + k, shared + " " + " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(multimatch.jaccard_components(df)) == brute(rows)


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    got = multimatch.jaccard_components(docs).collect()
    assert len(got) == docs.count()
    want = {i: (n, c) for i, n, c in brute([(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None])}
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["n_shingles"] == 1
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert multimatch.jaccard_components(empty_documents(spark)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1, max_size=40), st.sets(st.integers(0, 60), min_size=1, max_size=40), st.integers(0, 5))
def test_linked_sets_share_enough_prefix_tokens(a, b, seed):
    x, y = (np.array(sorted(s), np.uint64) << np.uint64(50) for s in (a, b))
    counters = np.random.default_rng(seed).integers(0, 9, 1 << multimatch.COUNTER_BITS)
    if len(x) > len(y):
        x, y = y, x
    (lx, ix, px), (ly, _, py) = multimatch.prefix(x, counters, 1.0), multimatch.prefix(y, counters, 1.0)
    assert ix <= len(px)
    if multimatch.links(x, y):
        assert len(set(px[:ix].tolist()) & set(py.tolist())) >= min(lx, ly)


def test_words_and_short_texts():
    assert len(multimatch.shingles("a b c")) == 1 and len(multimatch.shingles(" \t")) == 0
    assert (multimatch.shingles("A b C") == multimatch.shingles("a  b\nc")).all()
    assert len(multimatch.shingles("one two three four five six")) == 1


def test_one_id_with_two_texts(spark):
    a, b = prose(40, 3), prose(40, 4)
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " x"), (5, prose(40, 6)), (5, ""), (6, prose(40, 6)), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r[0], r[2]) for r in multimatch.jaccard_components(df).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (6, 6)}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 1 << 40), max_size=300), st.sets(st.integers(0, 1 << 40), max_size=40), st.sets(st.integers(0, 1 << 40), max_size=40))
def test_parities_differ_in_no_more_bits_than_the_sets(common, a, b):
    x, y = (np.array(sorted(common | s), np.uint64) for s in (a, b))
    bits = sum(int(v).bit_count() for v in (multimatch.parities(x) ^ multimatch.parities(y)).view(np.uint64))
    assert bits <= len((common | a) ^ (common | b))


def test_parities_keep_pairs_at_the_threshold(spark):
    """Sets of 100 shingles in a union of 100 + k: similarity crosses 75 % inside the range."""
    base = prose(104, 8)
    rows = [(1, base)] + [(2 + k, base + " " + prose(k, 300 + k)) for k in range(20, 45)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(multimatch.jaccard_components(df)) == brute(rows)


def test_word_hashes_depend_on_the_word_alone_and_keep_nothing(monkeypatch):
    """Equal words have equal hashes wherever they stand; words of all lengths differ; no table of words grows in a worker."""
    import tracemalloc

    words = [b"a" * i for i in range(1, 80)] + [b"b", b"ab", b"ba", "ä日".encode(), b"\x00", b"\x00\x00"]
    raw = b"\x0b" + b" \t".join(words) + b"\n\r\x0c " + b" ".join(reversed(words))
    for chunk in (1 << 15, 3):
        monkeypatch.setattr(multimatch, "CHUNK", chunk)
        h = multimatch.word_hashes(raw)
        assert len(h) == 2 * len(words) and len(set(h.tolist())) == len(words) and (h == h[::-1]).all()
        assert multimatch.word_hashes(words[40]) == h[40] and len(multimatch.word_hashes(b"")) == len(multimatch.word_hashes(b" \n")) == 0
    monkeypatch.undo()
    text = " ".join(f"word{i}" for i in range(100_000))
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    assert len(multimatch.shingles(text)) == 99_996
    left = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert left < 1 << 20


@pytest.mark.parametrize("name", ["stars", "path", "random", "none"])
def test_components_of_graphs(spark, monkeypatch, name):
    """Each step writes one table; stars need no step."""
    rng = np.random.default_rng(4)
    edges = {"stars": [(c, c + i) for c in (10, 100) for i in range(1, 40)] * 2 + [(5, 5)],
             "path": [(int(a), int(b)) for p in [rng.permutation(200)] for a, b in zip(p, p[1:])],
             "random": [(int(a), int(b)) for a, b in rng.integers(-300, 300, (350, 2))], "none": []}[name]
    written, keep = [], multimatch.staged
    monkeypatch.setattr(multimatch, "staged", lambda df, n: written.append(n) or keep(df, n))
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        lo, hi = sorted((top(a), top(b)))
        root[hi] = lo
    found = {r["node"]: r["root"] for r in multimatch.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: top(x) for x in root if top(x) != x}
    assert len(written) == {"stars": 0, "none": 0}.get(name, len(set(written))) and len(written) <= 8
