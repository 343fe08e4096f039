import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tests.llm.fixtures import empty_documents, odd_documents
from tidemark.llm import spm_backtrack
from tidemark.llm.queries import LLM_QUERIES, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    import sentencepiece

    return spm_backtrack.BacktrackingEncoder(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeinrstho▁ .,'\n-!?0123éß日🙂_/\\\t\x00the"), max_size=60))
def test_any_text_encodes_and_decodes_like_the_library(both, text):
    enc, lib = both
    want = lib.encode(text)
    assert enc.encode(text) == want
    ids, decoded = enc.encode_text(text)
    assert ids == " ".join(map(str, want + [2])) and decoded == lib.decode(want)
    assert enc.decode(want) == lib.decode(want)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 1000, "ab" * 2000 + "日" * 500, "\n" * 300, "x" + " " * 17 + "y"])
def test_long_stretches(both, text):
    enc, lib = both
    assert enc.encode(text) == lib.encode(text)


def test_cut_stretches_equal_one_stretch(both):
    enc, lib = both
    text = "".join(c for c in open(spm_backtrack.__file__, encoding="utf-8").read())[:4000]
    whole = [i for t in enc.tokens(enc.normalise(text)) for i in enc.token_ids(t)]
    assert whole == lib.encode(text)


def want(lib, doc_id, text):
    ids = lib.encode(text or "") + [2]
    return (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(lib.decode(ids).encode()).hexdigest())


def test_query_against_the_library(spark, both):
    rows = [tuple(r) for r in LLM_QUERIES["op4_spm_backtracking"](spark, SF_SMALL).collect()]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(rows) == sorted(want(both[1], *r) for r in docs)


def test_odd_rows_and_empty_table(spark, both):
    docs = odd_documents(spark)
    got = {(r["doc_id"], r["n_tokens"], r["ids"]) for r in spm_backtrack.encode_documents(docs, PATH).collect()}
    assert got == {(r["doc_id"], len(i), " ".join(map(str, i))) for r in docs.collect()
                   for i in [both[1].encode(r["text"] or "") + [2]]}
    assert spm_backtrack.encode_documents(empty_documents(spark), PATH).collect() == []


def test_a_text_with_a_new_stretch_is_looked_up_once(both):
    """One unknown stretch must not send all stretches of its text through the cache again."""
    enc, lib = both

    class Counting(dict):
        asked = 0

        def get(self, k):
            self.asked += 1
            return super().get(k)

        def __getitem__(self, k):
            self.asked += 1
            return super().__getitem__(k)

        def __contains__(self, k):
            self.asked += 1
            return super().__contains__(k)

    text = " ".join(["known"] * 1000)
    enc.encode_text(text)
    kept, enc.young = enc.young, Counting(enc.young)
    try:
        ids, decoded = enc.encode_text(text + " qqzzkvx")
        assert enc.young.asked < 1100
    finally:
        enc.young = kept
    assert decoded == text + " qqzzkvx" and list(map(int, ids.split())) == lib.encode(decoded) + [lib.eos_id()]
