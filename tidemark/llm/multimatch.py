"""Exact Jaccard join on word shingles with adaptive multi-match prefixes (operator 10).

A document is the set of its distinct five-word shingles (64-bit hashes).
Two sets link when 100 * |intersection| >= 75 * |union|.  Linked sets share
at least t = ceil(0.75 n) shingles, n the size of either, so under any common
order of shingles they share at least l of their first n - t + l ones.

The shorter one of two linked sets needs less: for it the overlap is at least
2 * 0.75 / 1.75 of its size, so its first n - that + l shingles (its index
prefix) share l with the longer one's prefix.

1. A counter array of fixed size, filled from all documents, estimates how
   many documents hold a shingle.  Shingles are ordered by (estimate, hash):
   the rare ones come first, frequent lines and passages last.
2. Each document chooses its own l: a longer prefix costs more rows, but a
   pair has to share l prefix shingles before it is verified.  The estimated
   cost of both decides.  Two documents must share min(l, l') prefix shingles.
3. Documents with equal sets form one class, which takes part once.  Prefix
   rows are reduced to shingles that at least two classes hold, one of them
   in its index prefix.
4. Each class has ``PARITY_BITS`` parities: bit i is the number of its
   shingles that fall into cell i, modulo 2.  Two sets whose parities differ
   in d bits differ in at least d shingles, so a pair with more than the
   difference that its sizes allow cannot link.  That is certain: it drops no link.
5. In a few rounds, each shared shingle's pivots (by another hash in each
   round) are verified against its other classes, linear in the classes that
   hold it, as far as the parities allow a link.  What links is connected and
   needs no more verification.
6. Of all pairs that are not connected then, those are verified whose
   parities allow a link, that share min(l, l') prefix shingles, and whose
   common shingles leave enough room for the overlap.  So a large group of
   near copies costs a few verifications per document, and no link between
   documents of different components is lost.
7. Components are found by alternating large-star and small-star steps over
   the links, as joins with partial minima.

Verification computes both sets from the whole texts.  Texts are fetched for
candidate classes only, through a bit array of fixed size and a join.

Equal 64-bit hashes of different shingles or sets are taken as equal (N
different ones have about N^2 / 2^65 such pairs).

Defined results: a null or empty text, or one of white space, has no
shingles and is a component of its own; rows with the same doc_id are one
document for linking (their texts are connected); a null doc_id links with
nothing and has a null component; an empty table gives no rows; columns of
other names are not read; long texts are read whole, batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import counter_slices, small_batches, staged, worker_caches

WORDS_PER_SHINGLE = 5
MIN_PERCENT = 75
COUNTER_BITS = 20
FILTER_BITS = 21
MAX_LEVEL = 8
ROUNDS = 3
PARITY_BITS = 1024
VERIFY_COST = 40.0  # of one candidate, in prefix rows
SHORT = 32  # bytes of a word that is hashed by tables
CHUNK = 1 << 15  # words hashed at once

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: a random long for each byte at each place of a short word
_TABLE = _mix(np.arange(1, SHORT * 256 + 1, dtype=np.uint64) * _MUL)
_SPACE = np.array([i in b" \t\n\r\x0b\x0c" for i in range(256)])


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each word, in the order of the text.  Words end at the six ASCII white-space characters.

    A short word's hash is the sum of its bytes' longs (tabulation), found for
    many words at once and without a table of words; long words, which are few, are hashed one by one."""
    b = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[b], prepend=True, append=True))
    first, size = edges[::2], edges[1::2] - edges[::2]
    out = np.empty(len(first), np.uint64)
    long = np.flatnonzero(size > SHORT)
    short = np.flatnonzero(size <= SHORT) if len(long) else np.arange(len(first))
    for i in range(0, len(short), CHUNK):
        now = short[i: i + CHUNK]
        n = size[now]
        at = np.cumsum(n) - n
        place = np.arange(at[-1] + n[-1]) - np.repeat(at, n)
        out[now] = np.add.reduceat(_TABLE[(place << 8) | b[place + np.repeat(first[now], n)]], at)
    for i in long.tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[first[i]: first[i] + size[i]])
    return out


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    h = word_hashes((text or "").encode("utf-8").lower())
    k = min(WORDS_PER_SHINGLE, len(h))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out *= _MUL
        out += h[i: i + n]
    out = _mix(out)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def links(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= MIN_PERCENT * (len(a) + len(b) - common)


def least_overlap(n: int) -> int:
    return -(-MIN_PERCENT * n // 100)


def pair_overlap(total: int) -> int:
    """Least overlap of two linked sets with ``total`` shingles together."""
    return -(-MIN_PERCENT * total // (100 + MIN_PERCENT))


def _cells(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def prefix(s: np.ndarray, counters: np.ndarray, noise: float) -> tuple[int, int, np.ndarray]:
    """(l, length of the index prefix, the prefix for l) of a set: the l with the least estimated cost.

    Documents that share l of the prefix's shingles number at most the sum of
    the shingles' estimates over l; each costs a verification."""
    n = len(s)
    counts = counters[_cells(s)]
    order = np.lexsort((s, counts))
    t = least_overlap(n)
    level = np.arange(1, min(MAX_LEVEL, t) + 1)
    length = n - t + level
    met = np.cumsum(np.maximum(counts[order] - noise, 0.0))[length - 1]
    cost = length + met + VERIFY_COST * met / level
    best = int(np.argmin(cost))
    return int(level[best]), n - pair_overlap(2 * n) + int(level[best]), s[order[: length[best]]]


def parities(s: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits of a set as longs: how many shingles fall into each cell, modulo 2."""
    counts = np.bincount((s & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits(counts & 1).view(np.int64)


def _alike(a: str, b: str, n_a: str, n_b: str) -> Column:
    """Whether parities and sizes allow a link: sets of n and m shingles that link differ in at most
    (n + m) (100 - p) / (100 + p) of them, p the least per cent, and in no more bits."""
    differ = F.lit(0)
    for i in range(PARITY_BITS // 64):
        differ = differ + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return differ * (100 + MIN_PERCENT) <= (F.col(n_a) + F.col(n_b)) * (100 - MIN_PERCENT)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


_DOC = "doc_id long, n long, cls long, text_hash long, lvl int, idx_len int, tokens array<long>, bits array<long>"


def _profiles(docs: DataFrame, counters_broadcast) -> DataFrame:
    """Per document: set size, class, level and prefix (the prefix once per class and task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_caches("links")
        counters, noise = counters_broadcast.value
        seen: set[int] = set()
        for b in batches:
            ns, classes, levels, indexed, tokens, bits = [], [], [], [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingles(text)
                cls = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else 0
                lvl, idx_len, head = prefix(s, counters, noise) if len(s) else (0, 0, s)
                if doc_id is None or cls in seen or not len(s):
                    head = head[:0]
                    bits.append(None)
                else:
                    seen.add(cls)
                    bits.append(parities(s))
                ns.append(len(s))
                classes.append(cls)
                levels.append(lvl)
                indexed.append(idx_len)
                tokens.append(_signed(head))
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in tokens]))).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ns, pa.int64()), pa.array(classes, pa.int64()), b.column(2), pa.array(levels, pa.int32()),
                 pa.array(indexed, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64())),
                 pa.array(bits, pa.list_(pa.int64()))],
                names=["doc_id", "n", "cls", "text_hash", "lvl", "idx_len", "tokens", "bits"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, _DOC)


def _count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    worker_caches("links")
    cells = np.zeros(1 << COUNTER_BITS, np.int64)
    for b in batches:
        found = [_cells(shingles(t)) for t in b.column(0).to_pylist()]
        if found:
            cells += np.bincount(np.concatenate(found), minlength=1 << COUNTER_BITS)
    return cells


def _id_cells(ids: np.ndarray) -> np.ndarray:
    return (_mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    cells = np.zeros(1 << FILTER_BITS, np.int64)
    for b in batches:
        cells[_id_cells(b.column(0).to_numpy(zero_copy_only=False))] = 1
    return cells


def _texts(docs: DataFrame, candidates: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, text) of the candidate classes, one document for each: of several texts
    with that document's id the one of the class.  A bit array lets few other
    documents into the join."""
    wanted = staged(candidates.join(classes, "cls").select("cls", F.col("rep").alias("rep_id"), "text_hash"), "wanted")
    bits = np.packbits(counter_slices(wanted, ["rep_id"], _mark, 1 << FILTER_BITS) > 0)
    bits = docs.sparkSession.sparkContext.broadcast(bits)  # 2**FILTER_BITS bits

    @F.pandas_udf(T.BooleanType())
    def maybe(ids: pd.Series) -> pd.Series:
        at = _id_cells(ids.fillna(0).to_numpy())
        return pd.Series((bits.value[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    near = docs.where(F.col("doc_id").isNotNull() & maybe("doc_id"))
    found = near.join(wanted, (near["doc_id"] == wanted["rep_id"]) & (F.xxhash64(near["text"]) == wanted["text_hash"]))
    return staged(found.groupBy("cls").agg(F.max("text").alias("text")), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of classes that link, by their whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_caches("links")
        last, last_set = None, None
        for b in batches:
            ok = []
            for a, ta, tb in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if a != last:
                    last, last_set = a, shingles(ta)
                ok.append(links(last_set, shingles(tb)))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["a", "b"])

    tb = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    ta = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    both = pairs.select("a", "b").join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
    return staged(both.mapInArrow(run, "a long, b long"), f"{name}-links")


def _fits() -> Column:
    """Set sizes that allow a link."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * MIN_PERCENT


def _possible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) whose parities allow a link."""
    side = lambda x: bits.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.where(_alike("bits_a", "bits_b", "n_a", "n_b")).select("a", "b")


def _against(met: DataFrame, pivot: str) -> DataFrame:
    """Pairs of a shingle's pivot with its other classes that are not connected yet and whose sizes allow a link."""
    pairs = met.select("cls", "n", "label", F.col(f"{pivot}.cls").alias("with"), F.col(f"{pivot}.n").alias("n_with"),
                       F.col(f"{pivot}.label").alias("l_with"))
    fits = F.least("n", "n_with") * 100 >= F.greatest("n", "n_with") * MIN_PERCENT
    pairs = pairs.where((F.col("label") != F.col("l_with")) & fits)
    return pairs.select(F.least("cls", "with").alias("a"), F.greatest("cls", "with").alias("b"))


def _nearby_labels(nodes: DataFrame, edges: DataFrame, rounds: int = 2) -> DataFrame:
    """A label per class such that equal labels are connected: minima over neighbourhoods, a few rounds."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = nodes.select(F.col("cls"), F.col("cls").alias("label"))
    for i in range(rounds):
        heard = both.join(label, both["b"] == label["cls"]).select(F.col("a").alias("cls"), "label")
        label = staged(label.unionAll(heard).groupBy("cls").agg(F.min("label").alias("label")), f"labels-{i}")
    return label


def _neighbours(edges: DataFrame) -> DataFrame:
    """(c, lo, hi): the least and the largest neighbour of every node."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))


def _alternated(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, after one large-star and one small-star step."""
    large = edges.join(_neighbours(edges), F.col("v") == F.col("c")).select("u", F.least("lo", "c").alias("v"))
    low = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    end = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return large.join(low, F.col("u") == F.col("c")).select(end.alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, by alternating large-star and
    small-star until all that is left are stars around their least nodes.
    Minima are partial aggregates and the rest are joins, so a node with very
    many links is never gathered.  ``edges`` (a, b) are read several times; each
    step writes once."""
    now, step = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v"), 0
    while True:
        near = _neighbours(now)
        # stars: no node has several neighbours, unless it lies below all of them
        if not near.agg(F.bool_or((F.col("lo") < F.col("c")) & (F.col("lo") < F.col("hi")))).first()[0]:
            return near.where("lo < c").select(F.col("c").alias("node"), F.col("lo").alias("root"))
        step += 1
        now = staged(_alternated(now), f"cc-{step}")


def _same_id(known: DataFrame) -> DataFrame:
    """Links between the classes of one doc_id, each with the least of them."""
    several = known.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a < z").select("doc_id", "a")
    return known.join(several, "doc_id").where("cls != a").select("a", F.col("cls").alias("b")).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    counters = counter_slices(docs, ["text"], _count, 1 << COUNTER_BITS)
    base = float(np.median(counters))
    counters = spark.sparkContext.broadcast((counters.astype(np.int32 if counters.max(initial=0) < 1 << 31 else np.int64),
                                             base + 3 * base ** 0.5 + 1))  # 2**COUNTER_BITS counters
    profiles = staged(_profiles(docs, counters), "profiles")
    slim = profiles.select("doc_id", "n", "cls", "lvl")
    known = profiles.where("n > 0 and doc_id is not null")
    classes = known.groupBy("cls").agg(F.max("n").alias("n"), F.max("lvl").alias("lvl"), F.min(F.struct("doc_id", "text_hash")).alias("r"))
    classes = staged(classes.select("cls", "n", "lvl", F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("text_hash")), "classes")

    rows = profiles.select("cls", "idx_len", F.posexplode("tokens").alias("pos", "token"))
    rows = rows.select("token", "cls", "pos", (F.col("pos") < F.col("idx_len")).alias("idx"))
    held = rows.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.max("idx").alias("any"))
    held = held.where("lo < hi and any").select("token")
    shared = staged(rows.join(held, "token").distinct().join(classes.select("cls", "n", "lvl"), "cls"), "shared")
    candidates = staged(shared.select("cls").distinct(), "candidates")
    bits = profiles.where("bits is not null").select("cls", "n", "bits").join(candidates, "cls")
    bits = staged(bits.dropDuplicates(["cls"]), "parities")
    texts = _texts(docs, candidates, classes)

    found, tried, mixed = None, None, shared.withColumn("label", F.col("cls"))
    for i in range(ROUNDS):
        rank = F.struct(F.xxhash64(F.lit(i), "cls").alias("h"), F.col("cls"), F.col("n"), F.col("label"))
        pivots = mixed.where("idx").groupBy("token").agg(F.min(rank).alias("p"), F.max(rank).alias("q"))
        met = mixed.select("token", "cls", "n", "label").join(pivots, "token")
        pairs = _against(met, "p").unionAll(_against(met, "q")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, f"star-{i}")
        tried = pairs if tried is None else tried.unionAll(pairs)
        links_now = _verified(staged(_possible(pairs, bits), f"possible-{i}"), texts, f"star-{i}")
        found = links_now if found is None else found.unionAll(links_now)
        label = _nearby_labels(classes, found)
        tagged = mixed.drop("label").join(label, "cls")
        apart = tagged.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("idx").alias("any"))
        mixed = staged(tagged.join(apart.where("x < y and any").select("token"), "token"), f"mixed-{i}")

    open_ = mixed.join(bits.select("cls", "bits"), "cls")
    side = lambda df, x: df.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("cls", "label", "n", "lvl", "pos", "bits")])
    shorter = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("cls_a") < F.col("cls_b")))
    # the first min(l, l') common shingles: from each of them on there must be room for the rest of the overlap
    need = F.least("lvl_a", "lvl_b")
    room = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) + need - 1
    fits = _fits() & (room * (100 + MIN_PERCENT) >= (F.col("n_a") + F.col("n_b")) * MIN_PERCENT)
    met = side(open_.where("idx"), "a").join(side(open_, "b"), "token").where(
        shorter & (F.col("label_a") != F.col("label_b")) & fits & _alike("bits_a", "bits_b", "n_a", "n_b"))
    rest = met.groupBy("cls_a", "cls_b").agg(F.count(F.lit(1)).alias("met"), F.min(need).alias("need")).where("met >= need")
    rest = rest.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b"))
    rest = staged(rest.join(tried, ["a", "b"], "left_anti"), "rest")
    found = found.unionAll(_verified(rest, texts, "rest")).unionAll(_same_id(known))
    found = staged(found, "links")

    roots = components(found)
    placed = classes.join(roots, classes["cls"] == roots["node"], "left").select(
        "cls", "rep", F.coalesce("root", "cls").alias("root"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = placed.join(least, "root").select(F.col("cls").alias("of"), "component_id")
    linked = (F.col("cls") == F.col("of")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return slim.join(named, linked, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
