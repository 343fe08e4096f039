"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_utc, scratch_path

ARROW_ROWS = 256  # rows per Arrow batch: bounds a Python worker's memory when texts are long


def worker_path(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, whatever
    the working folder (on a cluster: where it is installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    worker_path(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Arrow batches of few rows: a batch of texts must fit a worker's memory."""
    worker_path(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: the
    lineage is cut, every later reader sees the same rows, and a lost
    executor costs no more than a re-read.  The folder goes when the
    application ends."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CACHES: dict[str, dict] = {}


def worker_caches(owner: str) -> dict:
    """The dict in which an operator keeps its encoders and caches in a Python
    worker.  Spark gives a worker to one operator after another: what others
    left there is dropped, so a pipeline's worker holds one operator's caches."""
    for other in [x for x in _CACHES if x != owner]:
        del _CACHES[other]
    return _CACHES.setdefault(owner, {})


def free_name(columns: Iterable[str], base: str) -> str:
    """A column name not in use (tables may carry any extra columns)."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def counter_slices(df: DataFrame, columns: Sequence[str], count_fn, cells: int, slices: int = 64) -> np.ndarray:
    """Sum one int64 counter array of ``cells`` cells over all rows.

    ``count_fn(batches) -> np.ndarray`` turns one task's Arrow batches into
    its array.  Each task emits the array in ``slices`` pieces; the pieces
    are summed per slice in the cluster, and only the summed array (a fixed
    size, whatever the input) comes to the driver."""
    if cells % slices:
        raise ValueError("cells must be a multiple of slices")
    width = cells // slices

    def emit(batches):
        arr = np.asarray(count_fn(batches), dtype="<i8").reshape(slices, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(slices), pa.int32()), pa.array([_pack(a) for a in arr], pa.binary())],
            names=["slice", "counts"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype="<i8")
        for b in batches:
            for v in b.column("counts"):
                total += _unpack(v.as_py(), width)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "counts"])

    parts = df.select(*columns).mapInArrow(emit, "slice int, counts binary")
    rows = parts.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()  # fixed size: cells * 8 bytes
    out = np.zeros((slices, width), dtype="<i8")
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["counts"], dtype="<i8")
    return out.reshape(-1)


def _pack(a: np.ndarray) -> bytes:
    """The narrowest unsigned form that holds the counts; its width leads."""
    top = int(a.max()) if a.size else 0
    for code, dt in ((1, "<u1"), (2, "<u2"), (4, "<u4"), (8, "<u8")):
        if top < 1 << (8 * code):
            return bytes([code]) + a.astype(dt).tobytes()
    raise OverflowError(top)


def _unpack(b: bytes, width: int) -> np.ndarray:
    return np.frombuffer(b, dtype=f"<u{b[0]}", offset=1, count=width).astype("<i8")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def kth_largest(df: DataFrame, key: str, k: int, bins: int = 1024) -> float | None:
    """The k-th largest non-null value of a double column, exactly: each pass
    counts the values in ``bins`` equal bins of the range that holds it and
    goes on with one bin, until that bin holds a single value.  ``bins``
    rows, whatever the input, come to the driver."""
    rows = df.where(F.col(key).isNotNull())
    lo, hi, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n or k < 1:
        return None
    k = min(k, n)
    while lo < hi:
        inside = rows.where(F.col(key).between(lo, hi))
        cell = F.least(F.floor((F.col(key) - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
        found = inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"),
                                                       F.max(key).alias("hi")).collect()
        for r in sorted(found, key=lambda r: -r["cell"]):
            if r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            k -= r["n"]
    return lo


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose doc_id is in ``kept`` (null ids match)."""
    name = free_name(docs.columns, "_kept_id")
    ids = kept.select(F.col("doc_id").cast("long").alias(name)).distinct()
    return docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")
