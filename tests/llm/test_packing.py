import random
import re
import struct
import zlib
from array import array
from collections import defaultdict

import pytest

from tests.conftest import SF_SMALL
from tests.llm.fixtures import empty_documents, odd_documents
from tidemark.llm import harmonic
from tidemark.llm.queries import LLM_QUERIES, tokenizer_path


def check(rows, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = defaultdict(list)
    for doc_id, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        want[doc_id].append(ids)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for doc_id, pieces in by_doc.items():
        ids = want[doc_id][0]
        copies = len(want[doc_id])
        pieces.sort(key=lambda r: r["start"])
        at = 0
        for r in pieces[::copies]:
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] >= 1
            part = ids[at: at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids) and len(pieces) % copies == 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for r in pieces:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    return sum(r["length"] for r in rows) / (1024 * len(by_seq))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = harmonic.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert harmonic.pack_documents(empty_documents(spark), tokenizer_path("byte_bpe_50k.json")).collect() == []


def test_query_against_brute_force(spark):
    rows = LLM_QUERIES["op7_harmonic_packing"](spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert check(rows, [tuple(r) for r in docs]) > 0.97


def test_many_workers_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(harmonic, "FAN_IN", 4)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(23)
    rows = harmonic.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    assert check(rows, [tuple(r) for r in docs.collect()]) > 0.97


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 511, 512, 700, 1023, 1024, 1025, 5000])
def test_cut_lengths(n):
    cut = harmonic.cut_lengths(n)
    assert sum(cut) == n and all(0 < x <= 1024 for x in cut)
    assert len(cut) <= n // 1024 + 4


def test_word_store_overflow_keeps_ids():
    path = tokenizer_path("byte_bpe_50k.json")
    enc = harmonic.WordEncoder(path, cache_words=3)
    texts = ["alpha beta gamma delta\nepsilon zeta", "beta beta\nbeta eta theta", "a"]
    assert [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in enc.encode_batch(texts)] == [
        enc.tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_cut_where_the_library_cuts():
    """Marks, white space and letters of several scripts in any order, by brute force."""
    enc, rng = harmonic.WordEncoder(tokenizer_path("byte_bpe_50k.json")), random.Random(11)
    alphabet = list("aZé日9٣ ,.\n'_)\"ś- \t½Ⅷ🙂 , . a b")
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(20_000)]
    assert enc.by_word
    for text, got in zip(texts, enc.encode_batch(texts)):
        assert got == array("I", enc._library(text)).tobytes(), text
    for text in texts:
        runs = re.search(r"[^\S \n]|[ \n][ \n]|^[ \n]|[ \n]\Z", text)
        assert harmonic.odd_space(text) == bool(runs), text
