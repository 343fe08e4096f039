"""Chosen-path set similarity join on two-word shingles (operator 11).

A document is the set of its distinct two-word shingles (64-bit hashes).  Two
sets link when 100 * |intersection| >= 80 * |union|.

Trees.  In each of ``TREES`` independent trees a document starts at the root and
branches: at every level it picks ``BRANCH`` tokens, the minima of its set under
hash functions of that tree, level and branch, and goes on to the child that each
of them names, up to ``LEVELS`` levels.  Two sets of similarity J pick the same token with probability J.
A node with at most ``LIMIT`` members is small: its members are compared
exhaustively.

Recall.  Of a pair with J = 0.8 a level fails with probability 0.2**2 = 0.04, so
that a tree keeps it to depth d with 0.96**d, and all six trees miss it with
probability 4e-9 at depth 1, 5e-7 at depth 2 and 1e-4 at depth 6; more similar
pairs are missed far less.  Exhaustive comparison first looks at ``MINS`` sketch
bytes: a pair passes with at least ``LEAST_EQUAL`` equal ones, which one with
J = 0.8 misses with probability 2e-7.  To the nodes of the first level, where every
class goes ``TREES * BRANCH`` times, only the low half of each byte travels: equal
bytes have equal halves, so that no pair is missed that the bytes let pass.

Work per group of copies.  Documents with equal sets are one class.

1. In each node of the first level (in chunks, if it is large) every class names
   its most similar partner; the best one over all nodes is verified on the full
   sets.  That is linear in the members, and what links is connected.
2. Only pairs between different components are left.  A large node whose members
   are one component but for at most ``OTHERS * LIMIT`` others is compared in chunks, with
   the others in every chunk: linear again, and no pair is lost, so a group of
   near copies of any size needs no deeper levels.  Other large nodes branch; one
   that is large after ``LEVELS`` levels is split into pairs of chunks.
3. In all these nodes the candidates in different components are found by their
   sketches, and every such pair is verified on the full sets: once, as a pair,
   or where a node has very many, in the node: pairs whose parities (operator 10)
   exclude a link are dropped, which is certain, and the rest are counted by pair
   or at once as a product of matrices.
4. What these links connect are the components of step 1: the last components are
   found between those, not between classes again.

Full sets come from whole texts, where they are compared: a text takes less room
than its set, so texts travel.  Minima stay with the profiles; each level takes its own
few from there.  Equal 64-bit hashes are taken as equal.

Defined results: a null or empty text, or one of white space, has no shingles and
is a component of its own; a text of one word is the set of that word; rows with
the same doc_id are one document for linking (their texts are connected); a null
doc_id links with nothing, has a null component and is kept; an empty table gives
no rows; columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_parts, small_batches, staged
from tidemark.llm.multimatch import _mix, _texts, components, parities, word_hashes

WORDS_PER_SHINGLE = 2
MIN_PERCENT = 80
TREES, LEVELS, BRANCH = 6, 6, 2
WIDTH = TREES * BRANCH  # minima that all trees pick from at one level
MINS = 128
LEAST_EQUAL = 80
LIMIT = 1024
OTHERS = 2  # x LIMIT: members outside a large node's main component that still join each of its chunks
VERIFY_BLOCK = 4096  # partners of one class in a task
_MUL = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(911)
_A = _rng.integers(1 << 62, 1 << 63, MINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, MINS, dtype=np.uint64)


# ------------------------------------------------------------------- sets and sketches

def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text.  Words end at the six ASCII white-space characters."""
    h = word_hashes((text or "").encode("utf-8").lower())
    k = min(WORDS_PER_SHINGLE, len(h))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out *= _MUL
        out += h[i: i + n]
    return np.unique(_mix(out))


def class_of(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else 0


def links(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or not fits(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= MIN_PERCENT * (len(a) + len(b) - common)


def fits(n, m):
    return 100 * np.minimum(n, m) >= MIN_PERCENT * np.maximum(n, m)


def minima(s: np.ndarray) -> np.ndarray:
    """The set's minimum under each hash function (32 bits)."""
    out = np.full(MINS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 1024):
        out = np.minimum(out, (s[i: i + 1024][:, None] * _A + _B).min(0))
    return (out >> np.uint64(32)).astype(np.uint32)


def children(keys: np.ndarray, trees: np.ndarray, mins: np.ndarray, level: int) -> np.ndarray:
    """(rows, BRANCH) names of the nodes that follow ``keys`` at ``level`` (from 0);
    ``mins``: a set's minima in each row, all or the ``WIDTH`` ones of the level."""
    out = []
    for j in range(BRANCH):
        f = level * WIDTH + trees * BRANCH + j
        picked = mins[np.arange(len(mins)), f % mins.shape[1]].astype(np.uint64)
        out.append(_mix((keys * _MUL + f.astype(np.uint64)) * _MUL + picked))
    return np.stack(out, 1)


# ------------------------------------------------------------------- stages

_DOC = "doc_id long, n long, cls long, text_hash long, sketch binary, mins binary"


def _profiles(docs: DataFrame) -> DataFrame:
    """Per document: set size and class; once per class and batch, with its
    smallest doc_id there: the sketch and the minima by level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ns, classes, held, found = b.column(0).to_pylist(), [], [], {}, {}
            for k, (doc_id, text) in enumerate(zip(ids, b.column(1).to_pylist())):
                s = shingles(text)
                c = class_of(s)
                ns.append(len(s))
                classes.append(c)
                if not len(s) or doc_id is None:
                    continue
                if c not in held:
                    m = minima(s)
                    found[c] = m.astype(np.uint8).tobytes(), m[: LEVELS * WIDTH].tobytes()
                if c not in held or doc_id < ids[held[c]]:
                    held[c] = k
            sketches, mins = [None] * len(ids), [None] * len(ids)
            for c, k in held.items():
                sketches[k], mins[k] = found[c]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ns, pa.int64()), pa.array(classes, pa.int64()), b.column(2), pa.array(sketches, pa.binary()),
                 pa.array(mins, pa.binary())], names=["doc_id", "n", "cls", "text_hash", "sketch", "mins"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, _DOC)


def _of_level(level: int):
    """The minima that the trees pick from at one level."""
    return F.expr(f"substring(mins, {1 + 4 * WIDTH * level}, {4 * WIDTH})")


_NODE = "tree int, key long, cls long"


def _branch(rows: DataFrame, level: int) -> DataFrame:
    """Children of (tree, key, cls, label, mins), the minima of that level; at level 0 of the roots: (cls, mins), without labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cls = b.column("cls").to_numpy()
            mins = np.frombuffer(b"".join(b.column("mins").to_pylist()), np.uint32).reshape(-1, WIDTH)
            if level:
                trees, keys = b.column("tree").to_numpy().astype(np.int64), b.column("key").to_numpy().view(np.uint64)
            else:
                trees = np.tile(np.arange(TREES), len(cls))
                keys, cls, mins = trees.astype(np.uint64), np.repeat(cls, TREES), np.repeat(mins, TREES, axis=0)
            found = children(keys, trees, mins, level)
            cols = {"tree": np.repeat(trees, BRANCH).astype(np.int32), "key": found.reshape(-1).view(np.int64), "cls": np.repeat(cls, BRANCH)}
            if level:
                cols["label"] = np.repeat(b.column("label").to_numpy(), BRANCH)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols.values()], names=list(cols))

    return rows.mapInArrow(run, _NODE + ", label long" if level else _NODE)


def _sized(rows: DataFrame, name: str) -> DataFrame:
    """Rows of the nodes with two members or more, with the node's size."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return staged(rows.join(sizes, "key"), name)


def _chunk(size, of):
    """A member's chunk (of about LIMIT members) of a node, and the number of chunks."""
    count = F.greatest(F.ceil(size / F.lit(LIMIT)).cast("int"), F.lit(1))
    return F.pmod(F.xxhash64(F.lit("chunk"), of), count).cast("int"), count


def _chunked(large: DataFrame) -> DataFrame:
    return large.select(F.xxhash64("key", F.lit("part"), _chunk(F.col("size"), F.col("cls"))[0]).alias("key"), "cls")


def _deeper(large: DataFrame, profiles: DataFrame, label: DataFrame) -> DataFrame:
    """(key, cls, label): small nodes that hold every pair between different
    components of large first-level nodes (tree, key, cls): see steps 2 and 3."""
    out, rows = [], large.select("tree", "key", "cls").join(label, "cls")
    for level in range(LEVELS):
        counts = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
        main = counts.groupBy("key").agg(F.max(F.struct("c", "label")).alias("m"), F.sum("c").alias("size"))
        main = main.where("size > m.c").select("key", "size", F.col("m.c").alias("most"), F.col("m.label").alias("main"))
        tagged = staged(rows.join(main, "key"), f"large-{level}")  # the nodes of one component are done
        out.append(tagged.where(F.col("size") <= LIMIT).select("key", "cls", "label"))
        tagged = tagged.where(F.col("size") > LIMIT)
        near = tagged.where(F.col("size") - F.col("most") <= OTHERS * LIMIT)
        mine, count = _chunk(F.col("most"), F.col("cls"))
        every = F.sequence(F.lit(0), count - 1)
        near = near.withColumn("chunk", F.explode(F.when(F.col("label") == F.col("main"), F.array(mine)).otherwise(every)))
        out.append(near.select(F.xxhash64("key", F.lit("star"), "chunk").alias("key"), "cls", "label"))
        far = tagged.where(F.col("size") - F.col("most") > OTHERS * LIMIT)
        if far.isEmpty():
            break
        if level == LEVELS - 1:
            out.append(_split(far))
            break
        mins = profiles.where("mins is not null").groupBy("cls").agg(F.max(_of_level(level + 1)).alias("mins"))
        rows = staged(_branch(far.select("tree", "key", "cls", "label").join(mins, "cls"), level + 1), f"paths-{level + 1}")
    return reduce(DataFrame.unionAll, out)


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, dict]]:
    """Runs of equal ``key`` in batches that are sorted by it, each whole (nodes are small)."""
    now, held = None, {c: [] for c in names}
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("key").to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        cols = {c: b.column(c).to_pylist() for c in names}
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(key)]):
            if key[i] != now:
                if now is not None:
                    yield now, held
                now, held = int(key[i]), {c: [] for c in names}
            for c in names:
                held[c].extend(cols[c][i:j])
    if now is not None:
        yield now, held


def _alike(planes: np.ndarray, sizes: np.ndarray, label: np.ndarray, rows: slice, first: int = 0) -> np.ndarray:
    """Equal sketch bytes (``planes``: a row for each byte, a column for each member) of
    some members with all members from the ``first`` on; 0 where the sizes allow no link,
    and between members that are connected."""
    equal = np.zeros((len(sizes[rows]), len(sizes) - first), np.uint8)  # MINS fits
    hit = np.empty(equal.shape, bool)
    for plane in planes:
        np.equal(plane[rows][:, None], plane[None, first:], out=hit)
        np.add(equal, hit.view(np.uint8), out=equal)
    equal[~fits(sizes[rows][:, None], sizes[None, first:]) | (label[rows][:, None] == label[None, first:])] = 0
    return equal


def _planes(sketches: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(sketches.T)


def _candidate_pairs(sketches: np.ndarray, sizes: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates x < y of a node with different labels, in order."""
    planes, found = _planes(sketches), []
    for i in range(0, len(sizes), 128):
        x, y = np.nonzero(np.triu(_alike(planes, sizes, label, slice(i, i + 128), i) >= LEAST_EQUAL))
        found.append((x + i, y + i))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _halves(sketches: np.ndarray) -> np.ndarray:
    """The low halves of sketch bytes, two to a byte."""
    return (sketches[:, ::2] & 15) | (sketches[:, 1::2] << 4)


def _unpacked(halves: np.ndarray) -> np.ndarray:
    return np.stack([halves & 15, halves >> 4], 2).reshape(len(halves), -1)


_PARTNER = "key long, cls long, other long, equal int"


def _partners(members: DataFrame) -> DataFrame:
    """In each small node (key, cls, n, half): the classes that have a candidate
    there, by the low halves of their sketches, each with its most similar one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def batch():
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
                                              names=["key", "cls", "other", "equal"])

        for key, g in _grouped(batches, ["cls", "n", "half"]):
            if len(g["cls"]) < 2:
                continue
            order = np.argsort(g["cls"], kind="stable")  # ties: the smallest class
            cls, sizes = np.array(g["cls"], np.int64)[order], np.array(g["n"], np.int64)[order]
            planes = _planes(_unpacked(np.frombuffer(b"".join(g["half"]), np.uint8).reshape(-1, MINS // 2)[order]))
            for i in range(0, len(cls), 128):
                equal = _alike(planes, sizes, cls, slice(i, i + 128))
                best = equal.argmax(1)
                top = equal[np.arange(len(equal)), best]
                for k in np.flatnonzero(top >= LEAST_EQUAL):
                    out.append((key, int(cls[i + k]), int(cls[best[k]]), int(top[k])))
            if len(out) >= 8192:
                yield batch()
                out.clear()
        if out:
            yield batch()

    parts = shuffle_parts(members.sparkSession)
    return members.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, _PARTNER)


_CANDIDATE = "key long, cls long, other long"
DENSE = 4  # candidate pairs per member from which a node is verified as a whole


def _candidates(members: DataFrame) -> DataFrame:
    """In each small node (key, cls, n, label, sketch) the candidates with
    different labels: as pairs, which meet their like from other nodes, where
    they are few for each member; else as members of the node (``other`` null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, g in _grouped(batches, ["cls", "n", "label", "sketch"]):
            cls, sizes, label = (np.array(g[c], np.int64) for c in ("cls", "n", "label"))
            x, y = _candidate_pairs(np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(-1, MINS), sizes, label)
            if len(x) <= DENSE * len(cls):
                a, b = np.minimum(cls[x], cls[y]), pa.array(np.maximum(cls[x], cls[y]))
            else:
                a = cls[np.union1d(x, y)]
                b = pa.nulls(len(a), pa.int64())
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), key, np.int64)), pa.array(a), b], names=["key", "cls", "other"])

    parts = shuffle_parts(members.sparkSession)
    return members.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, _CANDIDATE)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by the full sets of their texts.  A text ``a`` travels
    once per ``VERIFY_BLOCK`` partners, and a class with very many partners is spread over tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None
        for b in batches:
            out = []
            for a, other, lane, text in zip(*[b.column(c).to_pylist() for c in ("a", "b", "lane", "text")]):
                if other is None:
                    now, own = (a, lane), shingles(text)
                elif (a, lane) == now and links(own, shingles(text)):
                    out.append((a, other))
            cols = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

    spark = pairs.sparkSession
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(VERIFY_BLOCK)).cast("int").alias("lanes"))
    laned = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("lanes")).cast("int").alias("lane"))
    theirs = laned.join(texts.select(F.col("cls").alias("b"), "text"), "b").select("a", "b", "lane", "text")
    own = many.join(texts.select(F.col("cls").alias("a"), "text"), "a").select(
        "a", F.lit(None).cast("long").alias("b"), F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), "text")
    rows = theirs.unionByName(own).repartition(shuffle_parts(spark), "a", "lane")
    return rows.sortWithinPartitions("a", "lane", F.col("b").asc_nulls_first()).mapInArrow(run, "a long, b long")


def _rest(members: DataFrame) -> DataFrame:
    """Links between the components of each node, exhaustively: (key, cls, n, label, sketch, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, g in _grouped(batches, ["cls", "n", "label", "sketch", "text"]):
            sizes, label = np.array(g["n"], np.int64), np.array(g["label"], np.int64)
            x, y = _candidate_pairs(np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(-1, MINS), sizes, label)
            sets = [shingles(t) for t in g["text"]]
            x, y = _close(sets, sizes, x, y)
            # two ways to the same counts: by pair, or for all pairs at once where most of them are candidates
            common = _common_of_all(sets)[x, y] if len(x) > 8 * len(sets) else _common_of_pairs(sets, x, y)
            linked = 100 * common >= MIN_PERCENT * (sizes[x] + sizes[y] - common)
            x, y = x[linked], y[linked]
            names, at = np.unique(label, return_inverse=True)
            pairs, one = np.unique(np.minimum(at[x], at[y]) * len(names) + np.maximum(at[x], at[y]), return_index=True)
            one = one[_forest(pairs // len(names), pairs % len(names), len(names))]
            if len(one):
                cls = np.array(g["cls"], np.int64)
                a, b = cls[x[one]], cls[y[one]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    parts = shuffle_parts(members.sparkSession)
    return members.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Places of links a[i], b[i] between ``n`` components of a node that connect
    what all of them connect, fewer than ``n``."""
    root, out = list(range(n)), []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[y] = x
            out.append(i)
            if len(out) == n - 1:
                break
    return out


def _close(sets: list[np.ndarray], sizes: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose parities (see operator 10) allow a link.  Certain: sets differ in no fewer shingles than bits."""
    bits, possible = np.stack([parities(s) for s in sets]).view(np.uint64), np.zeros(len(x), bool)
    for i in range(0, len(x), 1 << 15):
        a, b = x[i: i + (1 << 15)], y[i: i + (1 << 15)]
        differ = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64)
        possible[i: i + (1 << 15)] = differ * (100 + MIN_PERCENT) <= (sizes[a] + sizes[b]) * (100 - MIN_PERCENT)
    return x[possible], y[possible]


def _common_of_pairs(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets x[i] and y[i], pairs in order of x."""
    out = np.zeros(len(x), np.int64)
    for i in np.unique(x).tolist():
        mine = np.flatnonzero(x == i) if len(x) < 64 else np.arange(*np.searchsorted(x, [i, i + 1]))
        for k in range(0, len(mine), 256):
            part = mine[k: k + 256]
            others = [sets[j] for j in y[part]]
            flat, starts = np.concatenate(others), np.concatenate(([0], np.cumsum([len(o) for o in others])[:-1]))
            at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            out[part] = np.add.reduceat((sets[i][at] == flat).astype(np.int64), starts)
    return out


def _common_of_all(sets: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all pairs: products of 0/1 matrices of
    members and shared tokens, ``width`` tokens at a time (exact in float32:
    counts stay below 2**24)."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    place = np.full(len(tokens), -1)
    place[shared] = np.arange(len(shared))
    at = place[at]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for i in range(0, len(shared), width):
        lo, hi = np.searchsorted(at, [i, i + width])
        x = np.zeros((len(sets), width), np.float32)
        x[owner[lo:hi], at[lo:hi] - i] = 1
        out += np.rint(x @ x.T).astype(np.int64)
    return out


def _split(rows: DataFrame) -> DataFrame:
    """A large node (key, cls, label, size) as pairs of chunks: two members meet in one of the new nodes."""
    chunks = F.ceil(F.col("size") * 2 / F.lit(LIMIT)).cast("int")
    r = rows.withColumn("chunks", chunks).withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    r = r.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return r.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "cls", "label")


def _mixed(tagged: DataFrame) -> DataFrame:
    """Members (key, cls, label) of the nodes that hold more than one component."""
    apart = tagged.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    return tagged.join(apart, "key")


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    profiles = staged(_profiles(docs), "profiles")
    slim = profiles.select("doc_id", "n", "cls")
    known = slim.where("n > 0 and doc_id is not null")
    classes = profiles.where("mins is not null").groupBy("cls").agg(
        F.max("n").alias("n"), F.min(F.struct("doc_id", "text_hash")).alias("r"), F.max("sketch").alias("sketch"), F.max(_of_level(0)).alias("mins"))
    classes = staged(classes.select("cls", "n", F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("text_hash"), "sketch", "mins"), "classes")
    sketches, reps = classes.select("cls", "n", "sketch"), classes.select("cls", "rep", "text_hash")

    @F.pandas_udf("binary")
    def half(sketch: pd.Series) -> pd.Series:
        rows = np.frombuffer(b"".join(sketch), np.uint8).reshape(-1, MINS)
        return pd.Series([x.tobytes() for x in _halves(rows)], sketch.index, object)

    paths = _sized(_branch(classes.select("cls", "mins"), 0), "paths-0")
    small, large = paths.where(F.col("size") <= LIMIT).select("key", "cls"), paths.where(F.col("size") > LIMIT)

    # 1. every class and its best partner
    first = small.unionAll(_chunked(large)).join(classes.select("cls", "n", half("sketch").alias("half")), "cls")
    partners = staged(_partners(first), "partners")
    best = partners.groupBy("cls").agg(F.max(F.struct("equal", (-F.col("other")).alias("o"))).alias("b"))
    pairs = best.select("cls", (-F.col("b.o")).alias("other"))
    pairs = staged(pairs.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct(), "best")
    paired = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select("b")).distinct()
    texts = _texts(docs, paired, reps)
    found = staged(_verified(pairs, texts), "best-links")

    # 2., 3. what the first links leave in different components
    firsts = components(found)
    now = reps.select("cls").join(firsts, F.col("cls") == F.col("node"), "left").select("cls", F.coalesce("root", "cls").alias("label"))
    now = staged(now, "labels")
    open_ = partners.select("key", "cls").join(now, "cls").select("key", "cls", "label")
    if not large.isEmpty():
        open_ = open_.unionAll(_deeper(large, profiles, now))
    open_ = _mixed(staged(open_, "open"))
    cross = staged(_candidates(open_.join(sketches, "cls")), "cross")
    rest = cross.where("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")).distinct()
    rest = staged(rest.join(pairs, ["a", "b"], "left_anti"), "rest")  # a pair counts once, however many nodes it meets in
    more = cross.select("cls").unionAll(rest.select("b")).distinct().join(paired, "cls", "left_anti")
    texts = texts.unionAll(_texts(docs, more, reps))
    found = staged(_verified(rest, texts), "pair-links")
    dense = cross.where("other is null").select("key", "cls")
    found = found.unionAll(staged(_rest(dense.join(now, "cls").join(sketches, "cls").join(texts, "cls")), "rest-links"))

    same_id = known.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a < z").select("doc_id", "a")
    same_id = known.join(same_id, "doc_id").where("cls != a").select("a", F.col("cls").alias("b")).distinct()
    # what is left to connect are the components of the first links
    at = lambda x: now.select(F.col("cls").alias(x), F.col("label").alias(f"at_{x}"))
    between = found.unionAll(same_id).join(at("a"), "a").join(at("b"), "b").where("at_a != at_b")
    between = between.select(F.least("at_a", "at_b").alias("a"), F.greatest("at_a", "at_b").alias("b"))
    lasts = components(staged(between.distinct(), "links"))
    roots = now.join(lasts, F.col("label") == F.col("node"), "left").select("cls", F.coalesce("root", "label").alias("label"))
    placed = reps.select("cls", "rep").join(roots, "cls")
    least = placed.groupBy("label").agg(F.min("rep").alias("component"))
    named = placed.join(least, "label").select(F.col("cls").alias("of"), "component")
    linked = (F.col("cls") == F.col("of")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    out = slim.join(named, linked, "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                  F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
