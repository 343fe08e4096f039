"""Exact duplicates owned by Patricia tries (operator 5).

Texts are compared as whole byte strings, lower-cased A-Z only.

1. Every task reads its documents in Arrow batches and inserts the strings
   of a batch into a compressed radix trie: rows with equal text meet in one
   terminal node.  A document row gets the key of its terminal; the text is
   kept once per terminal.  So a text that holds a third of all rows leaves
   a task once per batch, not once per row.
2. The distinct texts are shuffled by (length, content hash); each partition
   inserts them into one trie, whose terminals keep the owner (the largest
   doc_id; ``owner="smallest"`` keeps the smallest) and the group's size.
   When the strings in a trie exceed ``budget_bytes``, its heaviest subtree
   is cut off: its strings, and all later ones that lead there, are passed
   on to another round, shuffled anew over more partitions.
3. Documents are joined to their terminal's owner on the terminal key.  The
   rows of one key all come from one batch, so no key is hot.

Defined results: a null text counts as empty; rows repeating the owner's
doc_id and text are kept each; a null doc_id never owns a group that has
another row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_parts, small_batches, staged, worker_caches

BUDGET_BYTES = 96 << 20
BATCH_ROWS = 1024


class Node:
    __slots__ = ("edge", "kids", "terminal")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.kids: dict[int, Node] = {}
        self.terminal = None


class PatriciaTrie:
    """Compressed radix trie over byte strings; terminals are made by the caller."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def insert(self, key: bytes, make):
        """The terminal of ``key``; ``make()`` supplies it when the key is new."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                if node.terminal is None:
                    node.terminal = make()
                return node.terminal
            kid = node.kids.get(key[at])
            if kid is None:
                leaf = Node(key[at:])
                leaf.terminal = make()
                node.kids[key[at]] = leaf
                self.bytes += len(key) - at
                return leaf.terminal
            edge = kid.edge
            if key.startswith(edge, at):
                node, at = kid, at + len(edge)
                continue
            same = _common(edge, key[at: at + len(edge)])
            upper = Node(edge[:same])
            kid.edge = edge[same:]
            upper.kids[kid.edge[0]] = kid
            node.kids[key[at]] = upper
            node, at = upper, at + same

    def walk(self, node: Node | None = None, prefix: bytes = b""):
        """(string, terminal) below ``node``, in byte order."""
        stack = [(node or self.root, prefix)]
        while stack:
            n, p = stack.pop()
            p += n.edge
            if n.terminal is not None:
                yield p, n.terminal
            for b in sorted(n.kids, reverse=True):
                stack.append((n.kids[b], p))

    def weight(self, node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            n = stack.pop()
            total += len(n.edge)
            stack.extend(n.kids.values())
        return total

    def cut_heaviest(self) -> tuple[bytes, list[tuple[bytes, object]]]:
        """Take the heaviest subtree off the trie: its path and its strings.
        The cut goes below long shared stems, where the trie first branches."""
        parent, prefix = self.root, b""
        while True:
            heavy = max(parent.kids.values(), key=self.weight)
            if len(parent.kids) > 1 or heavy.terminal is not None or parent.terminal is not None or not heavy.kids:
                break
            parent, prefix = heavy, prefix + heavy.edge
        strings = list(self.walk(heavy, prefix))
        self.bytes -= self.weight(heavy)
        del parent.kids[heavy.edge[0]]
        return prefix + heavy.edge[:1], strings


def _common(a: bytes, b: bytes) -> int:
    """Length of the shared prefix: halving, then byte by byte."""
    lo, hi = 0, min(len(a), len(b))
    while hi - lo > 16:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo + len(os.path.commonprefix([a[lo:hi], b[lo:hi]]))


def _better(a, b, largest: bool):
    """Owner of two ids; an id beats null."""
    if a is None or b is None:
        return b if a is None else a
    return max(a, b) if largest else min(a, b)


_ROW = "doc_id long, term long, text_sha256 string, folded binary, len long, ids_owner long, ids_n long"


def trie_dedup(docs: DataFrame, owner: str = "largest", budget_bytes: int = BUDGET_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs`` (doc_id, text)."""
    spark, largest = docs.sparkSession, owner == "largest"
    small_batches(spark, BATCH_ROWS)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        worker_caches("trie")
        base = TaskContext.get().partitionId() << 38
        for b in batches:
            trie, rows = PatriciaTrie(), []

            def fresh():
                nonlocal base
                base += 1
                return [base, None, 0, None]  # key, owner, rows, position of the row that carries the text

            for i, (doc_id, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                raw = (text or "").encode("utf-8").lower()
                t = trie.insert(raw, fresh)
                if t[3] is None:
                    t[3] = i
                    sha = hashlib.sha256(raw).hexdigest()
                    t.append(sha)
                t[1] = _better(t[1], doc_id, largest)
                t[2] += 1
                rows.append((doc_id, t, raw if t[3] == i else None))
            first = [raw is not None for _, _, raw in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1][0] for r in rows], pa.int64()),
                pa.array([r[1][4] for r in rows], pa.string()),
                pa.array([r[2] for r in rows], pa.binary()),
                pa.array([len(r[2]) if f else None for r, f in zip(rows, first)], pa.int64()),
                pa.array([r[1][1] if f else None for r, f in zip(rows, first)], pa.int64()),
                pa.array([r[1][2] if f else None for r, f in zip(rows, first)], pa.int64())],
                names=["doc_id", "term", "text_sha256", "folded", "len", "ids_owner", "ids_n"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = staged(source.mapInArrow(local, _ROW), "trie-rows")
    waiting = rows.where("folded is not null").select(F.array("term").alias("terms"), "folded", "len", "ids_owner", "ids_n")
    owners, level = None, 0
    parts = shuffle_parts(spark)
    while True:
        level += 1
        spread = waiting.repartition(parts, F.col("len"), F.xxhash64(F.lit(level), F.col("folded")))
        solved = staged(spread.mapInArrow(_owners(largest, budget_bytes), _SOLVED), f"trie-owners-{level}")
        found = solved.where("folded is null").select("term", "keep_id", "group_size")
        owners = found if owners is None else owners.unionAll(found)
        cut = solved.where("folded is not null")
        left = cut.agg(F.sum("len").alias("b"), F.count(F.lit(1)).alias("n")).first()
        if not left["n"]:
            break
        waiting = cut.select("terms", "folded", "len", F.col("keep_id").alias("ids_owner"), F.col("group_size").alias("ids_n"))
        parts = max(parts, 2 * -(-int(left["b"]) // budget_bytes))
    slim = rows.select("doc_id", "term", "text_sha256")
    return slim.join(owners, "term").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


_SOLVED = "term long, keep_id long, group_size long, terms array<long>, folded binary, len long"


def _owners(largest: bool, budget: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_caches("trie")
        trie, cut = PatriciaTrie(), []
        for b in batches:
            out: list[tuple] = []
            for terms, raw, n, own, size in zip(*(b.column(i).to_pylist() for i in range(5))):
                if any(raw.startswith(p) for p in cut):
                    out.append((None, own, size, terms, raw, n))
                    continue
                t = trie.insert(raw, lambda: [None, 0, []])
                t[0] = _better(t[0], own, largest)
                t[1] += size
                t[2] += terms
                while trie.bytes > budget and sum(1 for _, _ in zip(range(2), trie.walk())) > 1:
                    path, strings = trie.cut_heaviest()
                    cut.append(path)
                    out += [(None, x[0], x[1], x[2], s, len(s)) for s, x in strings]
            if out:
                yield _solved(out)
        out = []
        for _, (own, size, terms) in trie.walk():
            out += [(t, own, size, None, None, None) for t in terms]
            if len(out) > 4096:
                yield _solved(out)
                out = []
        yield _solved(out)

    return solve


def _solved(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64()]
    cols = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["term", "keep_id", "group_size", "terms", "folded", "len"])
