"""Writers (SNK1-SNK8)."""

from __future__ import annotations

from collections.abc import Sequence

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.functions.keys import HASH_COL, record_hash
from tidemark.sources.versioned import VersionedTable

DAY_COL = "_day"
MAX_RECORDS_PER_FILE = 1_000_000
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class LoadError(RuntimeError):
    pass


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  folders: bool = False) -> DataFrame:
    """A table that may not exist yet reads as empty with its schema;
    ``folders`` reads all folders below ``path`` (control logs)."""
    try:
        reader = spark.read.schema(schema).format(fmt)
        return (reader.option("recursiveFileLookup", "true") if folders else reader).load(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def existing_schema(spark: SparkSession, path: str, day_col: str = DAY_COL) -> T.StructType | None:
    """Schema of a table without its day column; None if there is no table yet."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException:
        return None
    return T.StructType([f for f in found.fields if f.name != day_col])


def load_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SNK1 read side: NDJSON with an explicit schema, no inference, FAILFAST,
    timestamps at microsecond precision."""
    return spark.read.schema(schema).options(**JSON_OPTIONS).option("mode", "FAILFAST").json(path)


def write_ndjson(df: DataFrame, path: str, files: int | None = None) -> None:
    """NDJSON files (ISO-8601 timestamps with microseconds), e.g. a load job's input."""
    out = df.repartition(files) if files else df
    out.write.options(**JSON_OPTIONS).json(path)


def append_load(df: DataFrame, target_path: str, require_rows: bool = False,
                max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """SNK1: bulk append.  ``require_rows`` makes an empty input an error
    (single-table writer); otherwise an empty input is a no-op."""
    if require_rows and df.isEmpty():
        raise LoadError("no records to load")
    df.write.mode("append").option("maxRecordsPerFile", max_records_per_file).parquet(target_path)


CORRUPT = "_corrupt"


def strict_parse(spark: SparkSession, raw: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """SNK2 check: parse JSON lines with the schema, once, and flag lines
    that are no JSON object or hold values of the wrong type, unknown keys,
    and missing values of required fields."""
    read_as = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] +
                           [T.StructField(CORRUPT, T.StringType(), True)])
    options = dict(JSON_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    parsed = F.from_json(F.col(text_col), read_as, options)
    known = F.array(*[F.lit(n) for n in schema.names])
    unknown = F.size(F.array_except(F.json_object_keys(F.col(text_col)), known)) > 0
    rows = raw.select(F.col(text_col).alias("_raw"), parsed.alias("_p"), unknown.alias("_unknown_keys"))
    return rows.select(
        *[F.col("_p").getField(n).alias(n) for n in schema.names],
        # no keys: not a JSON object
        F.coalesce("_unknown_keys", F.lit(True)).alias("_unknown_keys"),
        F.coalesce(F.col("_p").getField(CORRUPT).isNotNull(), F.lit(True)).alias("_bad_type"),
        _missing(schema, lambda n: F.col("_p").getField(n)).alias("_missing"), "_raw")


def _missing(schema: T.StructType, value) -> Column:
    out = F.lit(False)
    for f in schema.fields:
        if not f.nullable:
            out = out | value(f.name).isNull()
    return out


def strict_stream_batch(batch: DataFrame, target_path: str, schema: T.StructType, epoch: int | None = None,
                        writer: str = "stream") -> int:
    """SNK2 sink for one micro-batch: all-or-nothing.  Any invalid row fails
    the whole batch with the number of offending rows; nothing is written.
    With ``epoch`` the target is a versioned table and a replay of the epoch
    replaces its own rows; without it the rows are appended, once per call."""
    bad = batch.where(F.col("_unknown_keys") | F.col("_bad_type") | F.col("_missing")).count()
    if bad:
        raise LoadError(f"{bad} rows rejected; batch not written")
    _append(batch.select(*schema.names), target_path, schema, epoch, writer)
    return 0


def _append(rows: DataFrame, target_path: str, schema: T.StructType, epoch: int | None, writer: str) -> None:
    if epoch is None:
        rows.write.mode("append").parquet(target_path)
    else:
        VersionedTable(rows.sparkSession, target_path, schema).append(rows, epoch, writer)


def read_epochs(spark: SparkSession, target_path: str, schema: T.StructType) -> DataFrame:
    """Committed rows of a table written in epochs."""
    return VersionedTable(spark, target_path, schema).read()


def strict_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same check for typed rows: columns that the target lacks, values
    that do not convert, and missing required values."""
    unknown = [c for c in df.columns if c not in schema.names]
    extra = F.lit(False)
    for c in unknown:
        extra = extra | F.col(c).isNotNull()
    have = [f for f in schema.fields if f.name in df.columns]
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in have}
    bad = F.lit(False)
    for f in have:
        bad = bad | (F.col(f.name).isNotNull() & cast[f.name].isNull())
    value = lambda n: cast.get(n, F.lit(None))
    return df.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], extra.alias("_unknown_keys"),
                     bad.alias("_bad_type"), _missing(schema, value).alias("_missing"))


def partition_value(ts, grain: str = "day"):
    """Partition column value of a timestamp: its day, or the first day of
    its month (for long, low-rate tables where day directories would be tiny)."""
    if grain == "day":
        return F.to_date(ts)
    if grain == "month":
        return F.trunc(F.to_date(ts), "month")
    raise ValueError(f"unknown partition grain {grain!r}")


def with_day(df: DataFrame, ts_col: str, day_col: str = DAY_COL, grain: str = "day") -> DataFrame:
    return df.withColumn(day_col, partition_value(F.col(ts_col), grain))


def create_partitioned_table(df: DataFrame, target_path: str, ts_col: str, cluster_cols: Sequence[str] = (),
                             partitions: int | None = None, mode: str = "overwrite",
                             day_col: str = DAY_COL) -> None:
    """SNK6: day-partitioned files clustered by ``cluster_cols``.  Range
    partitioning on (day, cluster columns) keeps a hot day from landing in
    one task; each task sorts its slice, so row-group min/max statistics
    prune on the cluster columns."""
    out = with_day(df, ts_col, day_col)
    keys = [F.col(day_col)] + [F.col(c) for c in cluster_cols]
    # without an explicit count the range partitions are sized by AQE from the data volume
    out = out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)
    out = out.sortWithinPartitions(*keys)
    out.write.mode(mode).partitionBy(day_col).parquet(target_path)


def keyed_write(batch: DataFrame, target_path: str, ts_col: str, key: str = "id",
                day_col: str = DAY_COL, days: Sequence | None = None, count_by: str | None = None,
                count_values: Sequence = (), grain: str = "day"):
    """SNK4 + S10: write rows by primary key, idempotently; returns the
    number of rows that were new.

    A record is identified by (timestamp, key, whole hash): the 53-bit key
    alone would merge unrelated records of a very large table.  Duplicates
    inside the batch collapse, records already in the target are skipped.
    An existing duplicate has the same timestamp, so the probe of the target
    is restricted to the batch's range of partitions, never the whole table.
    ``grain`` is the partition granularity (``day``/``month``); ``days`` (first
    and last, or all, partition values of the batch) may be passed when the
    caller already knows them; the new-row count is observed during the write
    (with ``count_by``, a column not written, per value of ``count_values``:
    the result is then a dict value -> new rows)."""
    spark = batch.sparkSession
    if HASH_COL not in batch.columns:
        record = [c for c in batch.columns if c not in (key, "_synced_at", day_col, count_by)]
        batch = batch.withColumn(HASH_COL, record_hash(batch, ts_col, record))
    dated = with_day(batch, ts_col, day_col, grain)
    if days is None:
        span = dated.agg(F.min(day_col), F.max(day_col)).first()
    else:
        span = (min(days), max(days)) if days else (None, None)
    if span[0] is None:
        return {v: 0 for v in count_values} if count_by else 0
    identity = [ts_col, key, HASH_COL]
    b = dated.dropDuplicates(identity)
    stored = b.drop(count_by) if count_by else b
    existing = read_or_empty(spark, target_path, stored.schema).where(F.col(day_col).between(span[0], span[1]))
    obs = Observation(f"keyed_write_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if count_by:
        metrics += [F.sum(F.when(F.col(count_by) == F.lit(v), 1).otherwise(0)).alias(f"n_{i}")
                    for i, v in enumerate(count_values)]
    # rebalance on the day: AQE coalesces small day slices into few files and splits a hot day;
    # the metrics are observed above that shuffle, on exactly the rows written
    # a join by name moves its columns to the front; the stored order stays the batch's
    new = b.join(existing.select(*identity), identity, "left_anti").select(*b.columns).hint("rebalance", day_col).observe(obs, *metrics)
    out = new.drop(count_by) if count_by else new
    out.write.mode("append").partitionBy(day_col).parquet(target_path)
    got = obs.get
    if count_by:
        return {v: int(got[f"n_{i}"] or 0) for i, v in enumerate(count_values)}
    return int(got["rows"])


def stored_identities(stamped: DataFrame, target_path: str, ts_col: str, lo: Column, hi: Column, key: str = "id",
                      day_col: str = DAY_COL, grain: str = "day") -> DataFrame:
    """(timestamp, key, whole hash) of the target's records from ``lo`` to ``hi``
    (constants): only the partitions of that range are read."""
    identity = [ts_col, key, HASH_COL]
    schema = T.StructType([*stamped.select(*identity).schema.fields, T.StructField(day_col, T.DateType())])
    there = read_or_empty(stamped.sparkSession, target_path, schema)
    return there.where(F.col(day_col).between(partition_value(lo, grain), partition_value(hi, grain))).select(*identity)


def truncate_keep_schema(spark: SparkSession, target_path: str, schema: T.StructType,
                         partition_cols: Sequence[str] = ()) -> DataFrame:
    """SNK7: remove all rows, keep the schema (overwrite with an empty frame)."""
    empty = spark.createDataFrame([], schema)
    w = empty.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(target_path)
    return spark.read.schema(schema).parquet(target_path)


def drop_table(spark: SparkSession, name_or_path: str) -> bool:
    """SNK8: drop if it exists; success if it is already absent.  Catalog
    names go through ``DROP TABLE IF EXISTS``; paths through the Hadoop
    file system of the session."""
    if "/" not in name_or_path:
        spark.sql(f"DROP TABLE IF EXISTS {name_or_path}")
        return True
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(name_or_path)
    fs = path.getFileSystem(conf)
    if fs.exists(path):
        fs.delete(path, True)
    return True


def insert(df: DataFrame, target_path: str, method: str = "batch", schema: T.StructType | None = None,
           epoch: int | None = None, writer: str = "insert") -> None:
    """SNK3: per-table insert method; ``batch`` = bulk append (default),
    ``stream`` = the strict all-or-nothing append: the rows are checked
    against ``schema`` (default: the existing target's, or their own).

    With ``epoch``, a number that grows from call to call and is the same when
    a call is retried, the target is a versioned table: a retry replaces the
    rows of its own epoch, whichever step the first try reached, so both
    methods can be retried safely.  Read it with :func:`read_epochs`."""
    if method not in ("batch", "stream"):
        raise ValueError(f"unknown insert method {method!r}")
    if method == "batch":
        if epoch is None:
            append_load(df, target_path)
        else:
            _append(df, target_path, df.schema, epoch, writer)
        return
    if schema is None:
        try:
            schema = df.schema if epoch is not None else df.sparkSession.read.parquet(target_path).schema
        except AnalysisException:
            schema = df.schema
    strict_stream_batch(strict_rows(df, schema), target_path, schema, epoch, writer)
