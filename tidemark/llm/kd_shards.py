"""Shards by a k-d tree over document metadata (operator 6).

A node holds a box of documents and a number of leaves.  All nodes of a
level are split in the same passes over a slim table (no texts): the widest
dimension of a node, relative to the whole table's range, is split at the
weighted median of its bytes (or at the share of its left leaves, where the
number of leaves is odd).  The median is found exactly in the cluster: each
pass adds up bytes in ``BINS`` bins of the range that still holds the split
value, and refines one bin per node.  Equal values are split by doc_id, so
one value holding a third of all rows does not unbalance the shards.  Only
bins (nodes x BINS rows, whatever the input) and the tree (one node per
shard) come to the driver.  A dimension that is not a whole number (strings,
fractions, dates) counts by the ranks of its distinct values.

Defined results: a null text has no bytes; a null dimension sorts lowest; rows
equal in doc_id and split dimension stay on one side; doc_ids may be any longs;
a text counts with its whole length, however long; an empty table gives no rows; columns that
are not named in ``dims`` are not read, and no name of a column clashes with the operator's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import shuffle_parts, staged

BINS = 1024
ROWS_PER_SLOT_GROUP = 50_000
MOST = (1 << 63) - 1  # the largest long
TOLERANCE = 1e-3  # of a leaf's bytes: a split may stop at a bin lighter than this


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def value_ranks(docs: DataFrame, col: str) -> DataFrame:
    """(value, rank): the place of each distinct non-null value of ``col`` in their order, from 0.

    The values are sorted by ranges across the cluster; only the number of values in each range meets in one task."""
    parts = shuffle_parts(docs.sparkSession)
    values = docs.select(F.col(col).alias("value")).where("value is not null").distinct()
    ranges = staged(values.repartitionByRange(parts, "value").select("value", F.spark_partition_id().alias("part")), "kd-values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    at = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    return staged(ranges.withColumn("at", at).join(first, "part").select("value", (F.col("first") + F.col("at")).alias("rank")), "kd-ranks")


@dataclass
class Box:
    leaves: int
    first: int  # shard of its first leaf; also the box's number while it has no split
    number: int


_PARAMS = "box int, axis int, lo long, hi long, step long, held_axis int, held long"


def _cuts(here: DataFrame, boxes: list[Box], spans: list[int], tie: int) -> list[tuple]:
    """(box, axis, value, tie value) of each box's split: rows with
    (axis, tie) <= (value, tie value) go left.  ``axes`` of ``here`` holds the dimensions, the tie-break last.

    Boxes and ranges come in as small tables (a row per box), so every pass has the same plan."""
    spark = here.sparkSession
    wanted = here.where(F.col("box").isin([b.number for b in boxes]))
    axis = lambda i: F.get("axes", F.lit(i))
    stats = {r["box"]: r for r in wanted.groupBy("box").agg(
        F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"),
        *[f(axis(i)).alias(f"{k}{i}") for i in range(tie + 1) for k, f in (("lo", F.min), ("hi", F.max))]).collect()}
    state, out = {}, []
    for box in boxes:
        r = stats.get(box.number)
        if r is None or r["n"] < 2:
            out.append((box.number, 0, MOST, MOST))  # nothing to split: all rows go left
            continue
        dim = max(range(tie), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"]) / max(1, spans[i]))
        state[box.number] = {"dim": dim, "axis": dim, "lo": r[f"lo{dim}"], "hi": r[f"hi{dim}"], "tie": (r[f"lo{tie}"], r[f"hi{tie}"]),
                             "base": 0, "want": r["w"] * (box.leaves // 2) / box.leaves,
                             "slack": TOLERANCE * r["w"] / box.leaves, "value": None}
    while state:
        params = spark.createDataFrame([(n, s["axis"], s["lo"], s["hi"], _step(s), s["dim"], s["value"]) for n, s in state.items()], _PARAMS)
        rows = here.join(F.broadcast(params), "box").withColumn("v", F.get("axes", "axis"))  # a row per box: at most the shards
        rows = rows.where(F.col("v").between(F.col("lo"), F.col("hi")) &
                          (F.col("held").isNull() | (F.get("axes", "held_axis") == F.col("held"))))
        # the difference of two longs may take 65 bits
        cells = rows.groupBy("box", F.expr("(cast(v as decimal(20,0)) - lo) div step").alias("cell")).agg(
            F.sum("size").alias("w"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        by_box: dict[int, list] = {}
        for c in cells:
            by_box.setdefault(c["box"], []).append(c)
        for n, s in list(state.items()):
            for c in sorted(by_box[n], key=lambda c: c["cell"]):
                last = c
                if s["base"] + c["w"] >= s["want"]:
                    break
                s["base"] += c["w"]
            else:
                s["base"] -= last["w"]
            c = last
            if c["lo"] == c["hi"] and s["axis"] != tie and c["w"] > s["slack"]:
                s.update(axis=tie, value=c["lo"], lo=s["tie"][0], hi=s["tie"][1])  # one heavy value: split it by doc_id
                continue
            if c["lo"] < c["hi"] and c["w"] > s["slack"]:
                s.update(lo=c["lo"], hi=c["hi"])
                continue
            nearer_before = abs(s["base"] - s["want"]) <= abs(s["base"] + c["w"] - s["want"])
            edge = c["lo"] - 1 if nearer_before and c["lo"] > -MOST - 1 else c["hi"]
            out.append((n, s["dim"], s["value"], edge) if s["axis"] == tie else (n, s["dim"], edge, MOST))
            del state[n]
    return out


def _step(s: dict) -> int:
    return max(1, -(-(s["hi"] - s["lo"] + 1) // BINS))


def kd_shards(docs: DataFrame, shards: int = 40, dims: Sequence[str] = ("doc_id", "size", "source", "lang"),
              overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot per row of ``docs``; ``dims`` may
    name any column of ``docs`` and ``size`` (UTF-8 bytes plus ``overhead``)."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    text = F.coalesce(F.col("text"), F.lit(""))
    spark = docs.sparkSession
    size = (F.octet_length(text) + overhead).cast("long")
    used = [d for d in dims if d == "size" or d in kinds]
    ranked = {i: d for i, d in enumerate(used) if d != "size" and not _whole(kinds[d])}
    tie = len(used)
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(d).alias(f"v{i}") if i in ranked else (size if d == "size" else F.col(d).cast("long")).alias(f"c{i}")
          for i, d in enumerate(used)])
    for i, d in ranked.items():  # a few values are broadcast by their known size, else a value of many rows is split by AQE
        ranks = value_ranks(docs, d).select(F.col("value").alias(f"v{i}"), F.col("rank").alias(f"c{i}"))
        slim = slim.join(ranks, f"v{i}", "left").drop(f"v{i}")
    axes = [F.coalesce(F.col(c), F.lit(-1).cast("long")) for c in [*(f"c{i}" for i in range(tie)), "doc_id"]]
    here = staged(slim.select("doc_id", "size", "text_crc32", F.array(*axes).alias("axes"), F.lit(0).alias("box")), "kd-slim")
    whole = here.agg(F.count(F.lit(1)).alias("n"), *[f(F.get("axes", F.lit(i))).alias(f"{k}{i}")
                                                     for i in range(tie) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    spans = [whole[f"hi{i}"] - whole[f"lo{i}"] if whole["n"] else 0 for i in range(tie)]  # Python's integers do not overflow
    leaves, level, numbers = [], [Box(shards, 0, 0)], 0
    while level:
        leaves += [b for b in level if b.leaves == 1 or not whole["n"]]
        level = [b for b in level if b.leaves > 1 and whole["n"]]
        if not level:
            break
        cuts = {c[0]: c for c in _cuts(here, level, spans, tie)}
        rows, below = [], []
        for b in level:
            half = b.leaves // 2
            kids = [Box(half, b.first, numbers + 1), Box(b.leaves - half, b.first + half, numbers + 2)]
            numbers += 2
            rows.append((*cuts[b.number], kids[0].number, kids[1].number))
            below += kids
        moves = spark.createDataFrame(rows, "box int, dim int, value long, edge long, low int, high int")
        v = F.get("axes", "dim")
        left = (v < F.col("value")) | ((v == F.col("value")) & (F.get("axes", F.lit(tie)) <= F.col("edge")))
        moved = here.join(F.broadcast(moves), "box", "left").withColumn(
            "box", F.when(F.col("dim").isNull(), F.col("box")).when(left, F.col("low")).otherwise(F.col("high")))
        here = staged(moved.select(*here.columns), f"kd-{numbers}")
        level = below
    shard_of = spark.createDataFrame([(b.number, b.first) for b in leaves], "box int, shard int")
    placed = here.join(F.broadcast(shard_of), "box").drop("axes", "box")
    return _with_slots(placed, whole["n"], shards).select("doc_id", "size", "text_crc32", "shard", "slot")


def _with_slots(placed: DataFrame, n: int, shards: int) -> DataFrame:
    """Gapless slot per shard: rows are numbered in groups of bounded size, group totals give each group's first slot."""
    groups = max(-(-n // (shards * ROWS_PER_SLOT_GROUP)), -(-4 * shuffle_parts(placed.sparkSession) // shards))
    rows = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(groups)).cast("int"))
    totals = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("in_part"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("shard", "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("first_slot"))
    within = Window.partitionBy("shard", "part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    numbered = rows.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(first, ["shard", "part"]).withColumn("slot", (F.col("first_slot") + F.col("at")).cast("long"))
