import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.fixtures import empty_documents, odd_documents, prose
from tidemark.llm import chosen_path as cp
from tidemark.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def set_of(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 2:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(words, words[1:]))


def brute(rows):
    """All pairs of texts, on the sets themselves; rows with one doc_id are one document."""
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders, sets = {}, [(i, set_of(t)) for i, t in rows]
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            holders.setdefault(x, []).append(k)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        (i, s), (j, t) = sets[a], sets[b]
        if find(i) != find(j) and 5 * len(s & t) >= 4 * len(s | t):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    out = []
    for i, s in sets:
        component = None if i is None else find(i) if s else i
        out.append((i, len(s), component, i == component))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_group(n, words=120, seed=3, first=1000):
    """Near copies, many of them close to the threshold: 1 to 9 words changed."""
    rng, base, rows = random.Random(seed), prose(words, seed).split(), []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(1, 10)):
            w[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        rows.append((first + i, " ".join(w)))
    return rows


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got(LLM_QUERIES["op11_chosen_path"](spark, SF_SMALL)) == brute(docs)


def documents():
    rows = near_group(90) + near_group(40, 60, 8, 3000)
    rows += [(5000 + i, prose(30 + i, i)) for i in range(60)] + [(6000 + i, prose(200, 5) + " tail" * (i % 3)) for i in range(30)]
    rows += [(7000 + i, "one two" if i % 2 else "One  TWO") for i in range(6)] + [(7100, "one"), (7101, "ONE"), (7102, "two")]
    # one id with two texts: what both link with is connected
    rows += [(8001, prose(80, 21)), (8002, prose(80, 22)), (8000, prose(80, 21) + " x"), (8000, prose(80, 22) + " y")]
    return rows


@pytest.mark.parametrize("limit", [1024, 8])
def test_near_copies_near_the_threshold(spark, monkeypatch, limit):
    """With a small limit nodes stay large at the last level and are split into pairs of chunks."""
    monkeypatch.setattr(cp, "LIMIT", limit)
    monkeypatch.setattr(cp, "LEVELS", 6 if limit > 8 else 2)
    monkeypatch.setattr(cp, "VERIFY_BLOCK", 16)
    rows = documents()
    want = brute(rows)
    sizes = {c: sum(1 for r in want if r[2] == c) for c in {r[2] for r in want}}
    assert max(sizes.values()) > 30 and len(sizes) > 20
    assert got(cp.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == want


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(cp.near_components(df)) == brute(rows)
    assert got(cp.near_components(empty_documents(spark))) == []
    lonely = spark.createDataFrame([(1, None), (2, " \t\n"), (None, "a b"), (3, "a b")], "doc_id long, text string")
    assert got(cp.near_components(lonely)) == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (None, 1, None, True)]


def test_intersections_by_pair_and_for_all():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(70)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    x, y = np.nonzero(np.triu(np.ones((70, 70), bool), 1))
    assert (cp._common_of_pairs(sets, x, y) == want[x, y]).all() and (cp._common_of_pairs(sets, x[:9], y[:9]) == want[x[:9], y[:9]]).all()
    both = cp._common_of_all(sets, 32)
    assert (both[x, y] == want[x, y]).all()


def test_recall_of_trees_and_sketch():
    """Pairs at the threshold: each level of a tree keeps them with 0.96, all trees and the sketch with almost 1."""
    rng, kept, passed, n = np.random.default_rng(1), 0, 0, 1500
    assert cp.TREES * cp.LEVELS * cp.BRANCH <= cp.MINS
    trees = np.arange(cp.TREES)
    for _ in range(n):
        pool = rng.integers(0, 1 << 63, 180, dtype=np.uint64)  # 160 of 200 in common
        both = np.stack([cp.minima(np.unique(pool[:180])), cp.minima(np.unique(np.concatenate([pool[:160], rng.integers(0, 1 << 63, 20, dtype=np.uint64)])))])
        nodes = [cp.children(trees.astype(np.uint64), trees, np.repeat(m[None, :], cp.TREES, 0), 0) for m in both]
        kept += (nodes[0] == nodes[1]).any(1).mean()
        passed += (both[0].astype(np.uint8) == both[1].astype(np.uint8)).sum() >= cp.LEAST_EQUAL
    assert abs(kept / n - 0.96) < 0.01 and passed == n


def test_few_bytes_are_kept_and_moved(spark, monkeypatch):
    """Per class: its minima once, the sketch twice, half sketches to the nodes of the first level, and texts instead of sets."""
    rows = near_group(30) + [(5000 + i, prose(60, i)) for i in range(70)]
    data = lambda df: df.select([F.octet_length(c).alias(c) for c, t in df.dtypes if t in ("binary", "string")])
    total = lambda df: sum(x or 0 for r in data(df).collect() for x in r)
    kept, nodes, verified = [], [], []
    staged, partners, confirm = cp.staged, cp._partners, cp._verified

    def keep(df, name):
        out = staged(df, name)
        kept.append(total(out))
        return out

    def meet(members):
        nodes.append(max(x for r in data(members).collect() for x in r))
        return partners(members)

    def check(pairs, whole):
        verified.append(total(whole))
        return confirm(pairs, whole)

    monkeypatch.setattr(cp, "staged", keep)
    monkeypatch.setattr(cp, "_partners", meet)
    monkeypatch.setattr(cp, "_verified", check)
    assert got(cp.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows)
    assert max(nodes) <= cp.MINS // 2
    assert sum(kept) <= len(rows) * (2 * cp.MINS + 4 * cp.WIDTH * (cp.LEVELS + 1))
    assert 0 < max(verified) <= sum(len(t.encode()) for _, t in rows)


def test_low_halves_lose_no_equal_byte():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 256, (2, 50, cp.MINS)).astype(np.uint8)
    b[rng.random(b.shape) < 0.6] = 7
    a[rng.random(a.shape) < 0.6] = 7
    x, y = (cp._unpacked(cp._halves(s)) for s in (a, b))
    assert (x == a & 15).all() and ((a == b).sum(1) <= (x == y).sum(1)).all()


def test_the_smallest_id_of_a_batch_stands_for_its_class(spark):
    """Its text is fetched, also when other rows of the class come first and other texts share the id."""
    same = prose(80, 31)
    rows = [(900, same), (40, same.upper()), (500, same), (40, prose(50, 32)), (7, same + " x"), (3, "  " + same + " y")]
    assert got(cp.near_components(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))) == brute(rows)


def test_candidates_and_close_pairs_of_a_node():
    """By blocks of rows and the upper half only; parities drop no pair that links, and many that do not."""
    rng, sets = np.random.default_rng(9), []
    for _ in range(300):
        base = sets[rng.integers(len(sets))] if len(sets) > 20 else rng.integers(0, 1 << 63, 150, dtype=np.uint64) * np.uint64(2)
        keep = base[rng.random(len(base)) > rng.random() * 0.3]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, rng.integers(1, 40), dtype=np.uint64)])))
    sizes, label = np.array([len(s) for s in sets]), rng.integers(0, 200, len(sets))
    sketches = np.stack([cp.minima(s).astype(np.uint8) for s in sets])
    some = [(i, j) for i in range(300) for j in range(i + 1, 300) if label[i] != label[j] and cp.fits(sizes[i], sizes[j])]
    want = [(i, j) for i, j in some if (sketches[i] == sketches[j]).sum() >= cp.LEAST_EQUAL]
    x, y = cp._candidate_pairs(sketches, sizes, label)
    assert list(zip(x.tolist(), y.tolist())) == want and len(want) > 50
    x, y = (np.array(c) for c in zip(*some))
    near = set(zip(*(c.tolist() for c in cp._close(sets, sizes, x, y))))
    linked = {p for p in some if cp.links(sets[p[0]], sets[p[1]])}
    assert linked and linked <= near and len(near) < len(want)


def test_last_components_are_found_between_the_first_ones(spark, monkeypatch):
    """The second time only links between components of the first time are left, and no class is connected again."""
    seen, find = [], cp.components

    def count(edges):
        seen.append([(r["a"], r["b"]) for r in edges.collect()])
        return find(edges)

    monkeypatch.setattr(cp, "components", count)
    rows = documents()
    assert got(cp.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows)
    first, last = seen
    root = {x: x for e in first + last for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in first:
        root[top(a)] = top(b)
    assert last and all(top(a) != top(b) for a, b in last)
    inner = {x for e in first for x in e}
    assert all(x == min(y for y in inner if top(y) == top(x)) for x in {x for e in last for x in e} & inner)


def test_links_of_a_dense_node_are_a_forest(spark):
    """40 near copies, each a component of its own, all linked with each other: 39 links, not 780."""
    base = prose(120, 3).split()
    texts = [" ".join(base[:i] + ["other"] + base[i + 1:]) for i in range(40)] + [prose(90, 77)]
    sets = [cp.shingles(t) for t in texts]
    rows = [(1, i + 100, len(s), i, cp.minima(s).astype(np.uint8).tobytes(), t) for i, (s, t) in enumerate(zip(sets, texts))]
    df = spark.createDataFrame([tuple(bytearray(x) if isinstance(x, bytes) else x for x in r) for r in rows],
                               "key long, cls long, n long, label long, sketch binary, text string")
    links = [(r["a"], r["b"]) for r in cp._rest(df).collect()]
    joined = {100}
    for _ in links:
        joined |= {x for e in links for x in e if joined & set(e)}
    assert len(links) == 39 and joined == set(range(100, 140))
