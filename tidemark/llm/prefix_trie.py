"""Trie of rebuilt conversations by composable fingerprints (operator 12).

A conversation c is rebuilt from the head of another one, the first h turns of
c - c % 100, and its own turns after its first h.  No rebuilt text is made.  A
turn is a SHA-256 digest of its role and text, and a sequence of turns x_0,
x_1, ... has the fingerprint sum(x_i B**i) modulo each of three primes.
Fingerprints form a monoid with the lengths: that of a concatenation is
f(s) + B**len(s) f(t), that of a suffix is a difference shifted back.  So

1. every original conversation gets the running fingerprints and lengths of
   its prefixes, once.  Rows are cut into buckets by ranges, so that a
   conversation with a third of all turns spreads over many tasks; a bucket's
   product is one row, and products combine across buckets;
2. a rebuilt prefix of depth d is a base prefix (d <= h), or the base head's
   fingerprint combined with the difference of two own prefixes: arithmetic on
   the stored products;
3. prefixes with equal (depth, fingerprint) are a node.  A node keeps the least
   and greatest digest of its members' last turn (references to stored turns).
   If these agree in every node, then by induction from the root the members of
   a node have equal turns throughout; if they differ anywhere, two sequences
   have met in one fingerprint and all is done again with another base B;
4. sums over subtrees are sums over members: a conversation is the smallest
   member of its nodes from some depth on, and what it adds to an ancestor is
   a difference of its own suffix lengths.  No pass per level is needed, and a
   node with all conversations is a partial aggregate;
5. the digest of a node's ends is sequential by its definition: ids are sorted by
   ranges and joined to chunks of text in parallel, and one task per node
   streams the chunks.

Defined results: null role or text is empty; turns are ordered by turn (null
first) and, where turns tie, by the digest of role and text; repeated rows are
turns of their own; rows without a conv_id belong to no conversation; a base
that is absent has no turns, and h counts as the number it has; an empty table
gives no rows.  Texts of any length are hashed and counted whole; columns of
other names are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_parts, small_batches, staged

HEAD = 6  # h = crc32(conv_id) % HEAD
GROUP = 100
PRIMES = (2147483647, 2147483629, 2147483587)  # the largest below 2**31: products fit a long
FP = ("f0", "f1", "f2")
CHUNK_IDS = 4096


def bases(seed: int) -> list[int]:
    draw = lambda i: int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8], "big")
    return [2**16 + draw(i) % (p - 2**17) for i, p in enumerate(PRIMES)]


def turn_digest() -> Column:
    """Identity of a turn: the length of the role keeps role and text apart."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def _power(i: int, base: int):
    """B**k modulo the i-th prime, for a column of exponents >= 0."""
    p = np.uint64(PRIMES[i])

    @F.pandas_udf("long")
    def power(k: pd.Series) -> pd.Series:
        e = k.to_numpy().astype(np.uint64)
        out, square = np.ones(len(e), np.uint64), np.uint64(base)
        while e.any():
            out = np.where(e & np.uint64(1), out * square % p, out)
            square = square * square % p
            e = e >> np.uint64(1)
        return pd.Series(out.astype(np.int64))

    return power


def _letter(i: int) -> Column:
    """A turn's value modulo the i-th prime, from its own part of the digest."""
    return F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("long") % F.lit(PRIMES[i])


def prefix_products(turns: DataFrame, powers) -> DataFrame:
    """``conv_id, k, digest, chars, f0.., upto``: of every prefix of k turns its
    last turn, fingerprint and code points (``upto``).

    ``turns``: conv_id, turn, digest, chars, bucket; within a bucket of a
    conversation a window, across its buckets a window over one row for each."""
    inside = Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "digest")
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = turns.withColumn("k", F.row_number().over(inside).cast("long")).withColumn("upto", F.sum("chars").over(run))
    for i, p in enumerate(PRIMES):
        t = t.withColumn(f"w{i}", _letter(i) * powers[i](F.col("k") - 1) % F.lit(p))
    for i, p in enumerate(PRIMES):
        t = t.withColumn(FP[i], F.sum(f"w{i}").over(run) % F.lit(p))
    t = staged(t.drop("turn", *[f"w{i}" for i in range(3)]), "trie-local")
    ends = t.groupBy("conv_id", "bucket").agg(F.max(F.struct("k", "upto", *FP)).alias("e"))
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    off = ends.select("conv_id", "bucket", "e.*").withColumn("ok", F.coalesce(F.sum("k").over(before), F.lit(0)))
    for i, p in enumerate(PRIMES):
        off = off.withColumn(f"p{i}", powers[i]("ok")).withColumn(f"g{i}", F.col(FP[i]) * F.col(f"p{i}") % F.lit(p))
    off = off.select("conv_id", "bucket", "ok", F.coalesce(F.sum("upto").over(before), F.lit(0)).alias("ou"),
                     *[f"p{i}" for i in range(3)],
                     *[(F.coalesce(F.sum(f"g{i}").over(before), F.lit(0)) % F.lit(p)).alias(f"o{i}") for i, p in enumerate(PRIMES)])
    j = t.join(off, ["conv_id", "bucket"])
    return j.select("conv_id", (F.col("k") + F.col("ok")).alias("k"), "digest", "chars",
                    *[((F.col(f"o{i}") + F.col(f"p{i}") * F.col(FP[i])) % F.lit(p)).alias(FP[i]) for i, p in enumerate(PRIMES)],
                    (F.col("upto") + F.col("ou")).alias("upto"))


def _memberships(prefixes: DataFrame, base: list[int]) -> DataFrame:
    """``conv_id, depth, f0.., digest, chars, rest, last``: every prefix of every
    rebuilt conversation (``rest``: code points from its last turn on)."""
    entry = F.struct("k", *FP, "upto", "digest", "chars")
    heads = prefixes.groupBy("conv_id").agg(
        F.max("k").alias("n"), F.max("upto").alias("total"),
        F.sort_array(F.collect_list(F.when(F.col("k") < HEAD, entry))).alias("head"))  # at most HEAD - 1 entries
    heads = staged(heads, "trie-heads")
    h = (F.crc32(F.col("conv_id").cast("string")) % HEAD).cast("int")
    own = heads.select("conv_id", h.alias("h"), "n", "total", F.col("head").alias("own"),
                       (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base_id"))
    other = heads.select(F.col("conv_id").alias("base_id"), F.col("head").alias("base"), F.col("n").alias("base_n"))
    c = own.join(other, "base_id", "left")
    at = lambda entries, k, f: F.when(k > 0, F.element_at(entries, F.greatest(k, F.lit(1)))[f]).otherwise(F.lit(0))
    c = c.withColumn("hb", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int")).withColumn("ho", F.least("h", "n").cast("int"))
    c = c.select("conv_id", "h", "hb", F.slice("base", 1, F.greatest("hb", F.lit(0))).alias("base"),
                 F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("tail"), F.col("total"),
                 at("base", F.col("hb"), "upto").alias("bu"), at("own", F.col("ho"), "upto").alias("ou"),
                 *[at("base", F.col("hb"), f).alias(f"b{f}") for f in FP], *[at("own", F.col("ho"), f).alias(f"o{f}") for f in FP])
    c = staged(c.withColumn("last", F.col("hb") + F.col("tail")).withColumn("all", F.col("bu") + F.col("total") - F.col("ou")), "trie-parts")

    zero = [F.lit(0).cast("long").alias(f) for f in FP]
    root = c.select("conv_id", F.lit(0).cast("long").alias("depth"), *zero, F.lit("").alias("digest"),
                    F.lit(0).cast("long").alias("chars"), F.col("all").alias("rest"), "last")
    head = c.select("conv_id", "all", "last", F.explode("base").alias("e")).select(
        "conv_id", F.col("e.k").alias("depth"), *[F.col(f"e.{f}").alias(f) for f in FP], F.col("e.digest").alias("digest"),
        F.col("e.chars").alias("chars"), (F.col("all") - F.col("e.upto") + F.col("e.chars")).alias("rest"), "last")
    tail = prefixes.join(c.where("tail > 0").drop("base", "total"), "conv_id").where("k > h")
    fps = []
    for i, (f, p) in enumerate(zip(FP, PRIMES)):
        back = F.array(*[F.lit(pow(base[i], -s, p)) for s in range(HEAD)])  # B**(hb - h)
        diff = F.pmod(F.col(f) - F.col(f"o{f}"), F.lit(p))
        fps.append(((F.col(f"b{f}") + F.element_at(back, F.col("h") - F.col("hb") + 1) * diff) % F.lit(p)).alias(f))
    tail = tail.select("conv_id", (F.col("hb") + F.col("k") - F.col("h")).alias("depth"), *fps, "digest", "chars",
                       (F.col("all") - F.col("bu") - F.col("upto") + F.col("ou") + F.col("chars")).alias("rest"), "last")
    return root.unionByName(head).unionByName(tail)


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``depth, f0.., sha``: digest of the ascending ids of each node, joined by commas."""
    parts = shuffle_parts(ends.sparkSession)
    key = ["depth", *FP]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            ids = b.column(4).to_pylist()
            new = np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in cols], axis=0))))
            stops = [*new[1:].tolist(), b.num_rows]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c[new]) for c in cols], pa.array([ids[i] for i in new], pa.int64()),
                 pa.array([",".join(map(str, ids[i:j])) for i, j in zip(new, stops)], pa.string())], names=[*key, "first", "chunk"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done(k, s):
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in k], pa.array([s.hexdigest()], pa.string())],
                                              names=[*key, "sha"])

        for b in batches:
            out = []
            for *k, _, chunk in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if k != now:
                    if now is not None:
                        out.append(done(now, state))
                    now, state = k, hashlib.sha256(chunk.encode())
                else:
                    state.update(b"," + chunk.encode())
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if now is not None:
            yield done(now, state)

    longs = ", ".join(f"{c} long" for c in key)
    order = [*key, "conv_id"]
    joined = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .mapInArrow(chunks, f"{longs}, first long, chunk string")
    return joined.repartition(parts, *key).sortWithinPartitions(*key, "first").mapInArrow(digest, f"{longs}, sha string")


def conversation_trie(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    small_batches(spark, CHUNK_IDS)
    parts = shuffle_parts(spark)
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_digest().alias("digest"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    turns = staged(slim.repartitionByRange(parts, "conv_id", F.col("turn").asc_nulls_first(), "digest")
                   .withColumn("bucket", F.spark_partition_id()), "trie-turns")
    while True:
        base = bases(seed)
        powers = [_power(i, b) for i, b in enumerate(base)]
        prefixes = staged(prefix_products(turns, powers), "trie-prefixes")
        members = staged(_memberships(prefixes, base), "trie-members")
        key = ["depth", *FP]
        nodes = staged(members.groupBy(*key).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("rep"), F.max("chars").alias("chars"),
            F.min("digest").alias("digest"), F.max("digest").alias("other")), "trie-nodes")
        if nodes.where("digest != other").isEmpty():
            break
        seed += 1  # two sequences met in one fingerprint
    up = [((F.col(f) - _letter(i) * powers[i](F.greatest(F.col("depth") - 1, F.lit(0)))) % F.lit(p)) for i, (f, p) in enumerate(zip(FP, PRIMES))]
    parent = [F.when(F.col("depth") > 0, F.pmod(u, F.lit(p))).alias(f"u{i}") for i, (u, p) in enumerate(zip(up, PRIMES))]
    nodes = nodes.select(*key, "n_convs", "rep", "digest", *parent)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(f"u{i}").alias(FP[i]) for i in range(3)]) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-tree")

    # from which depth on a conversation is its nodes' smallest member, and whether it stands for a leaf
    met = members.join(nodes.select(*key, "rep", "n_children"), key).where(F.col("conv_id") == F.col("rep"))
    stands = met.groupBy("conv_id").agg(F.min(F.struct("depth", "rest")).alias("s"), F.max(
        F.when((F.col("depth") == F.col("last")) & (F.col("n_children") == 0), 1).otherwise(0)).alias("leaf"))
    stands = stands.select("conv_id", F.col("s.depth").alias("since"), F.col("s.rest").alias("since_rest"), "leaf")
    shares = members.join(stands, "conv_id", "left").select(
        *key, F.coalesce("leaf", F.lit(0)).alias("leaf"),
        (F.col("rest") - F.when(F.col("since").isNull(), 0).when(F.col("depth") >= F.col("since"), F.col("rest"))
         .otherwise(F.col("since_rest"))).alias("saved"))
    sums = shares.groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = _ends_digests(members.where("depth = last"))
    above = nodes.select(*[F.col(c).alias(f"a_{c}") for c in key], F.col("rep").alias("parent_conv_id"))
    joined = nodes.join(sums, key).join(ends, key, "left").join(
        above, (F.col("a_depth") == F.col("depth") - 1) & (F.col("a_f0") == F.col("u0")) & (F.col("a_f1") == F.col("u1"))
        & (F.col("a_f2") == F.col("u2")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return joined.select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                         F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
                         F.coalesce("sha", F.lit(none)).alias("ends_sha256"))
