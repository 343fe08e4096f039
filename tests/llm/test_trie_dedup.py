import hashlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from tests.conftest import SF_ORACLE
from tests.llm.fixtures import empty_documents, odd_documents
from tests.oracle_check import compare, duck
from tidemark.llm import trie_dedup
from tidemark.llm.queries import LLM_ORACLE, LLM_QUERIES


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    out = []
    for raw, ids in groups.items():
        own = max((i for i in ids if i is not None), default=None)
        out += [(i, own, len(ids), i == own, hashlib.sha256(raw).hexdigest()) for i in ids]
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_query_matches_sql(spark):
    n, problems = compare(LLM_QUERIES["op5_patricia_dedup"](spark, SF_ORACLE), duck(SF_ORACLE), LLM_ORACLE["op5_patricia_dedup"])
    assert n == 1000 and not problems


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert result(trie_dedup.trie_dedup(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert trie_dedup.trie_dedup(empty_documents(spark)).collect() == []


def test_spill_by_subtree_keeps_results(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert result(trie_dedup.trie_dedup(docs, budget_bytes=100_000)) == want


@given(st.lists(st.binary(max_size=40), max_size=60))
def test_trie_holds_each_string_once(keys):
    trie = trie_dedup.PatriciaTrie()
    for i, k in enumerate(keys):
        trie.insert(k, lambda: []).append(i)
    got = dict(trie.walk())
    want = defaultdict(list)
    for i, k in enumerate(keys):
        want[k].append(i)
    assert got == want and list(got) == sorted(got)


@given(st.lists(st.binary(min_size=1, max_size=12), min_size=2, max_size=40, unique=True))
def test_cut_subtree_takes_what_its_path_leads_to(keys):
    trie = trie_dedup.PatriciaTrie()
    for k in keys:
        trie.insert(k, list)
    path, strings = trie.cut_heaviest()
    left = [k for k, _ in trie.walk()]
    assert sorted(left + [k for k, _ in strings]) == sorted(keys)
    assert all(k.startswith(path) for k, _ in strings) and not any(k.startswith(path) for k in left)
