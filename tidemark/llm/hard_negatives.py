"""Hard-negative mining with rotated one-bit codes and exact residual intervals (operator 13).

Vectors become integers, x_i = floor(256 v_i).  Scores are integer inner
products, and every score that decides is computed exactly; codes only say
which pairs cannot matter.

Codes.  A vector is padded to P = 2**k components, its signs are flipped by a
fixed random pattern and it is rotated by a Hadamard transform: integers again,
and <x', y'> = P <x, y>.  Its one-bit code s holds the signs of x'; stored with
it is the alignment a = <x', s> / P, the length of x' along the code vector, and
what is left, r = x' - a s, is coded the same way ``STAGES`` times.  What is left
at last has the stored norm rho.

Estimates.  An anchor's rotated vector q is cut into bit planes; <q, s> is a sum
of popcounts of planes and code.  With e, the part of q below the planes,

    |<q', x'> - sum_j a_j <q, s_j>|  <=  |e| |x' - r| + sqrt(|q'|^2 - <q', s>^2 / P) rho,

where s is the last code: what is left is orthogonal to it (Cauchy-Schwarz).
This is an interval for each score, not a probable one.

Search.  Rows are packed into blocks, anchors too.  Rows are dealt over lanes of
at most about ``LANE_CELLS`` components, every anchor block goes to all lanes.
A task holds its lane's rows, ordered by label, reads anchor blocks one after
another, and gives out no more than the best five of each anchor.  No pair of
blocks is ever a row, and no table that grows with the input is broadcast: the
driver holds counts only, an executor a lane and an anchor block.

1. Positives: of the rows with the anchor's label, those whose upper bound
   reaches the fifth best score so far (and the fifth greatest lower bound of the
   block) are scored.
2. Negatives: for each positive score p the five best rows with another label in
   80 p <= 100 score <= 100 p; rows whose interval misses that range, or lies below
   the fifth best so far, are not scored.

Defined results: rows with a null id, a null label, a null vector, a null or
non-finite component, no component at all, or one beyond 2**30 after scaling
take no part; vectors of different lengths have no inner product, they are
searched among their own; rows with the same id are rows of their own, also
for the anchor with that id; ties by smaller id; an anchor without positives, a
positive without negatives and an empty table give no rows.  Scores beyond a
long raise an error.  Columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_parts, small_batches, staged

SCALE = 256
STAGES = 3  # one-bit codes per vector
PLANES = 8  # bits of an anchor's component that are used, the sign included
TOP = 5
LOW_PERCENT = 80
BLOCK_CELLS = 1 << 17  # rows x components of a block
ANCHORS = 512  # per block
LANE_CELLS = 1 << 24  # rows x components of a lane, which a task holds: 262,144 rows of 64
LIMIT = 1 << 30
SEED = 20240131
SLACK = 1e-9  # relative; more than the rounding of the bounds

_ROWS = "dim int, block long, n int, ids binary, labels binary, ints binary, codes binary, aligns binary, norms binary"
_ANCHORS = "dim int, block long, n int, labels binary, uids binary, ints binary, limits binary"


# ------------------------------------------------------------------- codes

def rotate(ints: np.ndarray) -> np.ndarray:
    """Rows (n, dim) -> (n, P) integers, P a power of two: random signs, then a Hadamard transform (exact in float64)."""
    n, dim = ints.shape
    p = max(64, 1 << (dim - 1).bit_length())
    signs = np.random.default_rng(SEED).integers(0, 2, p)[:dim] * 2 - 1
    out = np.zeros((n, p))
    out[:, :dim] = ints * signs
    step = 1
    while step < p:
        v = out.reshape(n, p // (2 * step), 2, step)
        a, b = v[:, :, 0].copy(), v[:, :, 1].copy()
        v[:, :, 0], v[:, :, 1] = a + b, a - b
        step *= 2
    return out


def _pack_bits(bits: np.ndarray) -> np.ndarray:
    """(n, P) booleans -> (n, P / 64) words."""
    return np.packbits(bits, axis=1).view(np.uint64)


def encode(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (n, STAGES, words), alignments (n, STAGES) and norms (n, 2): of what is left, and of what the codes tell."""
    left = rotate(ints)
    whole = left.copy()
    n, p = left.shape
    codes, aligns = np.zeros((n, STAGES, p // 64), np.uint64), np.zeros((n, STAGES))
    for j in range(STAGES):
        positive = left >= 0
        s = np.where(positive, 1.0, -1.0)
        aligns[:, j] = (left * s).sum(1) / p
        codes[:, j] = _pack_bits(positive)
        left -= aligns[:, j: j + 1] * s
    return codes, aligns, np.stack([np.linalg.norm(left, axis=1), np.linalg.norm(whole - left, axis=1)], 1)


_WEIGHTS = 2.0 ** np.arange(PLANES, dtype=np.float32)


class Anchor:
    """An anchor's bit planes and the norms of its bounds."""

    def __init__(self, ints: np.ndarray, q: np.ndarray | None = None):
        """``q``: the rotated vector, if it is known."""
        q = rotate(ints[None, :])[0] if q is None else q
        self.p = len(q)
        top = max(1.0, float(np.abs(q).max()))
        self.unit = 2.0 ** max(0, int(np.ceil(np.log2(top + 1))) - (PLANES - 1))
        self.offset = 1 << (PLANES - 1)
        kept = np.floor(q / self.unit)  # -offset .. offset - 1
        u = (kept + self.offset).astype(np.uint64)
        self.planes = np.stack([_pack_bits(((u >> np.uint64(j)) & np.uint64(1)).astype(bool)[None, :])[0] for j in range(PLANES)])
        counts = np.bitwise_count(self.planes).sum(1, dtype=np.int64)
        self.count = int((counts << np.arange(PLANES)).sum())
        self.below = float(np.linalg.norm(q - kept * self.unit))
        self.square = float((q * q).sum())

    def _dots(self, s: np.ndarray) -> np.ndarray:
        """<q, s> without what lies below the planes, for codes s (n, words)."""
        under, ones = np.zeros(len(s)), np.zeros(len(s))
        for w in range(s.shape[1]):
            word = np.ascontiguousarray(s[:, w])
            under += _WEIGHTS @ np.bitwise_count(word & self.planes[:, w: w + 1]).astype(np.float32)  # of a word less than 2**14: exact
            ones += np.bitwise_count(word)
        # <u, s> = sum 2**b (2 |plane & s| - |plane|); <1, s> = 2 |s| - P
        return self.unit * (2 * under - self.count - self.offset * (2 * ones - self.p))

    def bounds(self, codes: np.ndarray, aligns: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score with every row of a block, from popcounts."""
        estimate, last = np.zeros(len(codes)), np.zeros(len(codes))
        for j in range(STAGES):
            last = self._dots(codes[:, j])
            estimate += aligns[:, j] * last
        # |<q', s>| is at least |last| less what lies below the planes
        along = np.maximum(0.0, np.abs(last) - self.below * self.p ** 0.5)
        across = np.sqrt(np.maximum(0.0, self.square - along * along / self.p))
        wide = self.below * norms[:, 1] + across * norms[:, 0]
        wide += SLACK * (np.abs(estimate) + wide + self.square ** 0.5 * (norms[:, 0] + norms[:, 1]) + 1)
        return (estimate - wide) / self.p, (estimate + wide) / self.p


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact integer inner products, in the narrowest arithmetic that holds them."""
    if not len(rows):
        return np.zeros(0, np.int64)
    most = rows.shape[1] * float(np.abs(rows).max(initial=0)) * float(np.abs(anchor).max(initial=0))
    if most < 2.0 ** 52:
        return np.rint(rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    if most < 2.0 ** 62:
        return rows @ anchor
    return np.array([sum(int(a) * int(b) for a, b in zip(r, anchor)) for r in rows], np.int64)  # raises beyond a long


# ------------------------------------------------------------------- blocks

def _bytes(ints: np.ndarray) -> bytes:
    """Components (at most ``LIMIT``) in two bytes each, or in four."""
    return ints.astype("<i2" if np.abs(ints).max(initial=0) < 1 << 15 else "<i4").tobytes()


def _ints(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (n * dim)}").reshape(n, dim)


def _blocks(vectors: DataFrame) -> DataFrame:
    """Rows that take part, as packed blocks of rows of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        made = 0

        def block(dim: int, rows: list):
            nonlocal made
            made += 1
            ints = np.array([r[2] for r in rows], np.int64).reshape(len(rows), dim)
            codes, aligns, norms = encode(ints)
            first = rows[0][3] + made  # a number of its own: the task's id and a count
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([first], pa.int64()), pa.array([len(rows)], pa.int32()),
                 *[pa.array([x], pa.binary()) for x in (
                     np.array([r[0] for r in rows], np.int64).tobytes(), np.array([r[1] for r in rows], np.int64).tobytes(),
                     _bytes(ints), codes.tobytes(), aligns.tobytes(), norms.tobytes())]],
                names=[c.split()[0] for c in _ROWS.split(", ")])

        for b in batches:
            ids, labels, parts = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()
            for i, label, v, part in zip(ids, labels, b.column(2), parts):
                x = v.values
                if x is None or not len(x) or x.null_count:
                    continue
                x = np.floor(SCALE * x.to_numpy(zero_copy_only=False).astype(np.float64))
                if not (np.abs(x) <= LIMIT).all():  # false for NaN, too
                    continue
                label = (label + 1) % 10 if i % 7 == 0 else label
                rows = waiting.setdefault(len(x), [])
                rows.append((i, label, x.astype(np.int64), part << 33))
                if len(rows) * len(x) >= BLOCK_CELLS:
                    yield block(len(x), waiting.pop(len(x)))
        for dim, rows in waiting.items():
            yield block(dim, rows)

    slim = vectors.where("vec_id is not null and label is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), F.spark_partition_id().cast("long").alias("part"))
    return slim.mapInArrow(run, _ROWS)


def _read(b: pa.RecordBatch, i: int) -> dict:
    """One packed block of rows."""
    get = lambda c, t: np.frombuffer(b.column(c)[i].as_py(), t)
    n, dim = b.column("n")[i].as_py(), b.column("dim")[i].as_py()
    return {"block": b.column("block")[i].as_py(), "ids": get("ids", np.int64), "labels": get("labels", np.int64),
            "ints": _ints(b.column("ints")[i].as_py(), n, dim), "codes": get("codes", np.uint64).reshape(n, STAGES, -1),
            "aligns": get("aligns", np.float64).reshape(n, STAGES), "norms": get("norms", np.float64).reshape(n, 2)}


_ANCHOR = "dim int, uid string, vec_id long, label long, ints binary"


def _anchors(blocks: DataFrame) -> DataFrame:
    """Rows that ask: one row for each, named by its block and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = _read(b, i)
                at = np.flatnonzero(r["ids"] % 100 == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["ints"].shape[1]] * len(at), pa.int32()), pa.array([f"{r['block']}:{k}" for k in at], pa.string()),
                     pa.array(r["ids"][at]), pa.array(r["labels"][at]), pa.array([_bytes(r["ints"][k].astype(np.int64)) for k in at], pa.binary())],
                    names=[c.split()[0] for c in _ANCHOR.split(", ")])

    return blocks.mapInArrow(run, _ANCHOR)


def _anchor_blocks(anchors: DataFrame, parts: int) -> DataFrame:
    """Anchors in blocks of at most ``ANCHORS``, ``limits``: their positives' scores (``TOP`` each, the least long for none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def block(dim: int, rows: list):
            limits = np.full((len(rows), TOP), np.iinfo(np.int64).min)
            for k, r in enumerate(rows):
                limits[k, : len(r["limits"] or [])] = r["limits"] or []
            uids = "\n".join(r["uid"] for r in rows).encode()
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([rows[0]["number"]], pa.int64()), pa.array([len(rows)], pa.int32()),
                 *[pa.array([x], pa.binary()) for x in (
                     np.array([r["label"] for r in rows], np.int64).tobytes(), uids,
                     _bytes(np.concatenate([_ints(r["ints"], 1, dim) for r in rows]).astype(np.int64)), limits.tobytes())]], names=[c.split()[0] for c in _ANCHORS.split(", ")])

        for b in batches:
            for r in b.to_pylist():
                rows = waiting.setdefault(r["dim"], [])
                rows.append(r)
                if len(rows) >= ANCHORS:
                    yield block(r["dim"], waiting.pop(r["dim"]))
        for dim, rows in waiting.items():
            yield block(dim, rows)

    numbered = anchors.repartition(parts, "uid").withColumn("number", F.monotonically_increasing_id())
    return numbered.mapInArrow(run, _ANCHORS)


# ------------------------------------------------------------------- search

class _Best:
    """The best TOP rows of one anchor (and one limit) that a task has seen."""

    __slots__ = ("scores", "ids")

    def __init__(self):
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> float:
        return self.scores[-1] if len(self.scores) == TOP else -np.inf

    def add(self, new_scores: np.ndarray, new_ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores, new_scores]), np.concatenate([self.ids, new_ids])
        order = np.lexsort((i, -s.astype(np.float64) if s.size and np.abs(s).max() < 2 ** 52 else [-int(x) for x in s]))[:TOP]
        self.scores, self.ids = s[order], i[order]


def _floor_of(low: np.ndarray) -> float:
    """The TOP-th greatest lower bound: so many rows reach it."""
    return np.partition(low, len(low) - TOP)[len(low) - TOP] if len(low) >= TOP else -np.inf


class _Lane:
    """The rows of one length that a task holds, ordered by label."""

    def __init__(self, blocks: list[dict]):
        sizes = [len(r["ids"]) for r in blocks]
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        whole = {c: np.concatenate([r.pop(c) for r in blocks]) for c in ("ids", "labels", "ints", "codes", "aligns", "norms")}
        order = np.argsort(whole["labels"], kind="stable")
        for c in list(whole):
            setattr(self, c, whole.pop(c)[order])
        self.firsts = {r["block"]: first for r, first in zip(blocks, firsts.tolist())}
        self.places = np.empty(len(order), np.int64)
        self.places[order] = np.arange(len(order))
        self.piece = max(1, 4 * BLOCK_CELLS // self.ints.shape[1])

    def own(self, uid: str) -> int:
        """Where the anchor's own row is, -1 if it is in another lane."""
        block, place = map(int, uid.split(":"))
        return int(self.places[self.firsts[block] + place]) if block in self.firsts else -1

    def pieces(self, label: int, other: bool) -> Iterator[slice]:
        """All rows with the label, or all with another one, piece by piece."""
        lo, hi = (int(np.searchsorted(self.labels, label, side)) for side in ("left", "right"))
        for start, stop in ((0, lo), (hi, len(self.labels))) if other else ((lo, hi),):
            for at in range(start, stop, self.piece):
                yield slice(at, min(at + self.piece, stop))


def _best_of(lane: _Lane, uid: str, label: int, ints: np.ndarray, q: np.ndarray, limits: list[int], negatives: bool) -> dict[int, _Best]:
    """The best rows of the lane for one anchor (``q``: rotated), for each of its limits."""
    code, best, own = Anchor(ints, q), {lim: _Best() for lim in limits}, -1 if negatives else lane.own(uid)
    for piece in lane.pieces(label, negatives) if limits else ():
        low, high = code.bounds(lane.codes[piece], lane.aligns[piece], lane.norms[piece])
        if piece.start <= own < piece.stop:
            low[own - piece.start] = high[own - piece.start] = -np.inf  # not its own positive
        want, least = np.zeros(len(low), bool), {}
        for lim in limits:
            if negatives:
                floor = -(-LOW_PERCENT * lim // 100)
                sure = low[(low >= floor) & (high <= lim)]
                least[lim] = max(floor, best[lim].floor(), _floor_of(sure))
                want |= (high >= least[lim]) & (low <= lim)
            else:
                least[lim] = max(best[lim].floor(), _floor_of(low))
                want |= high >= least[lim]
        if piece.start <= own < piece.stop:
            want[own - piece.start] = False
        chosen = np.flatnonzero(want) + piece.start
        if not len(chosen):
            continue
        exact, ids = scores(lane.ints[chosen].astype(np.int64), ints), lane.ids[chosen]
        for lim in limits:
            fits = exact >= least[lim]
            if negatives:
                fits &= exact <= lim
            if fits.any():
                best[lim].add(exact[fits], ids[fits])
    return best


_FOUND = "uid string, lim long, vec_id long, score long"


def _search(blocks: DataFrame, anchor_blocks: DataFrame, lanes: int, negatives: bool) -> DataFrame:
    """Best rows per anchor (and limit) of each lane.  Every block of rows goes
    to one lane and every block of anchors to all; in a lane, rows of one
    length come first, then the anchors of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, lane = None, [], None
        for b in batches:
            for i in range(b.num_rows):
                at = b.column("lane")[i].as_py(), b.column("dim")[i].as_py()
                if at != now:
                    now, waiting, lane = at, [], None
                if not b.column("asks")[i].as_py():
                    waiting.append(_read(b, i))
                    continue
                if waiting:
                    lane, waiting = _Lane(waiting), []
                if lane is None:  # no rows of this length here
                    continue
                get = lambda c, t: np.frombuffer(b.column(c)[i].as_py(), t)
                n = b.column("n")[i].as_py()
                labels, limits = get("labels", np.int64), get("limits", np.int64).reshape(n, TOP)
                ints = _ints(b.column("ints")[i].as_py(), n, at[1]).astype(np.int64)
                rows, rotated = [], rotate(ints)
                for k, uid in enumerate(b.column("uids")[i].as_py().decode().split("\n")):
                    asked = [int(x) for x in np.unique(limits[k]) if x >= 0] if negatives else [0]
                    for lim, x in _best_of(lane, uid, int(labels[k]), ints[k], rotated[k], asked, negatives).items():
                        rows += [(uid, lim, vec_id, s) for s, vec_id in zip(x.scores.tolist(), x.ids.tolist())]
                cols = list(zip(*rows)) if rows else [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                                 names=["uid", "lim", "vec_id", "score"])

    laned = blocks.select(F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int").alias("lane"), F.lit(False).alias("asks"), "*")
    asked = anchor_blocks.select(F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.lit(True).alias("asks"), "*")
    dealt = laned.unionByName(asked, allowMissingColumns=True).repartitionById(lanes, F.col("lane"))
    return dealt.sortWithinPartitions("lane", "dim", "asks").mapInArrow(run, _FOUND)


def _lanes(blocks: DataFrame) -> int:
    """As many as hold ``LANE_CELLS`` each, or as keep the cluster busy; every anchor goes to each, so not more."""
    spark = blocks.sparkSession
    cells = blocks.agg(F.sum(F.col("n").cast("long") * F.col("dim"))).first()[0] or 0
    return max(1, -(-cells // LANE_CELLS), min(shuffle_parts(spark), 2 * spark.sparkContext.defaultParallelism))


def _first(found: DataFrame) -> DataFrame:
    """The best TOP rows per (anchor, limit) of all tasks, numbered from 1."""
    w = Window.partitionBy("uid", "lim").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; vectors: (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    small_batches(spark, 16)  # packed blocks are large rows
    blocks = staged(_blocks(vectors), "hard-blocks")
    anchors = staged(_anchors(blocks), "hard-anchors")
    count = anchors.count()
    if not count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    parts, lanes = max(1, -(-count // ANCHORS)), _lanes(blocks)
    none = anchors.withColumn("limits", F.lit(None).cast("array<long>"))
    positives = staged(_first(_search(blocks, _anchor_blocks(none, parts), lanes, False)), "hard-positives")
    limits = positives.groupBy("uid").agg(F.collect_list("score").alias("limits"))  # at most TOP
    # all sides grow with the input, and their files can be far smaller than their rows: merge joins, never a broadcast
    asking = _anchor_blocks(anchors.hint("merge").join(limits, "uid"), parts)
    negatives = _first(_search(blocks, asking, lanes, True))
    pos = anchors.select("uid", F.col("vec_id").alias("anchor_id")).hint("merge").join(
        positives.select("uid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "uid")
    neg = negatives.select(F.col("uid").alias("n_uid"), F.col("lim"), F.col("rank").cast("int").alias("rank"),
                           F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    both = pos.hint("merge").join(neg, (F.col("uid") == F.col("n_uid")) & (F.col("positive_score") == F.col("lim")))
    return both.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
