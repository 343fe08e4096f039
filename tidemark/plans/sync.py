"""Incremental sync cycle (S1-S4, S8, S10) and multi-table runs.

One cycle per (table, shard): pull the tie-safe next batch after the
cursor, convert and quarantine, stage the batch as files (cuts lineage, so
a lost executor only re-runs the write), key and stamp the valid rows,
write them idempotently, then log quarantined rows, the batch and -- last --
the new checkpoint.  Data commits before the cursor: a crash between the
two re-pulls the batch and the keyed write drops the repeats.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import quarantine_split, type_projection
from tidemark.functions.keys import HASH_COL, shard_of, with_record_id
from tidemark.operators import control
from tidemark.operators.batches import batch_ends, instant
from tidemark.operators.filters import ts_lit
from tidemark.operators.schema_plan import TargetSchema, merge_versions
from tidemark.plans.specs import TableSpec, validate_specs
from tidemark.session import fresh_path
from tidemark.sources import sinks
from tidemark.sources.files import Files
from tidemark.sources.versioned import VersionedTable
from tidemark.sources.tables import scan_columns

log = logging.getLogger(__name__)

BATCH_LOG_SCHEMA = T.StructType([
    T.StructField("table_id", T.StringType()), T.StructField("node_id", T.IntegerType()),
    T.StructField("batch_id", T.LongType()), T.StructField("rows_pulled", T.LongType()),
    T.StructField("rows_written", T.LongType()), T.StructField("rows_quarantined", T.LongType()),
    T.StructField("ts_min", T.TimestampType()), T.StructField("ts_max", T.TimestampType()),
    T.StructField("phase", T.StringType()), T.StructField("as_of", T.TimestampType()),
    T.StructField("seconds", T.DoubleType()),
])


REJECT_SCHEMA = T.StructType([T.StructField("record_hash", T.StringType()), T.StructField("occurrences", T.LongType())])


def _newest_checkpoints(rows: DataFrame) -> DataFrame:
    return control.upsert_checkpoint(rows, rows.limit(0))


def _reject_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("record_hash").agg(F.sum("occurrences").alias("occurrences"))


#: kind of control log: schema, and how older cycles fold (None: every row is kept)
CONTROL_LOGS = {
    "checkpoints": (control.CHECKPOINT_SCHEMA, _newest_checkpoints),
    "batches": (BATCH_LOG_SCHEMA, None),
    "rejects": (REJECT_SCHEMA, _reject_totals),
}


@dataclass(frozen=True)
class SyncStore:
    """Layout of targets and control tables below one shared root."""

    root: str
    target_root: str | None = None

    @staticmethod
    def fresh(spark: SparkSession, name: str = "sync", target_root: str | None = None) -> SyncStore:
        return SyncStore(fresh_path(spark, name), target_root)

    def target(self, name: str) -> str:
        base = (self.target_root or f"{self.root}/target").rstrip("/")
        return f"{base}/{name}"

    @property
    def audit(self) -> str:
        return f"{self.root}/control/audit"

    def staging(self, table_id: str, node: int, seq: int) -> str:
        return f"{self.root}/staging/{quote(table_id, safe='')}/node={node}/seq={seq}"

    def folder(self, log_root: str, table_id: str, part) -> str:
        """Control rows of one table and cycle have a folder of their own:
        jobs that run at a time never share a folder's commit, and a cycle
        that runs twice overwrites its own rows."""
        return f"{log_root}/{quote(str(table_id), safe='')}/{part}"

    def read_log(self, spark: SparkSession, log_root: str, schema: T.StructType) -> DataFrame:
        return sinks.read_or_empty(spark, log_root, schema, folders=True)

    def _log(self, spark: SparkSession, kind: str, table_id: str) -> VersionedTable:
        schema, fold = CONTROL_LOGS[kind]
        return VersionedTable(spark, f"{self.root}/control/{kind}/{quote(str(table_id), safe='')}", schema, fold)

    def _all(self, spark: SparkSession, kind: str) -> DataFrame:
        """A control log of all tables.  Every table has a log of its own, so
        tables that are synchronised at a time never share a commit."""
        schema, fold = CONTROL_LOGS[kind]
        tables = [self._log(spark, kind, unquote(t)) for t in Files(spark).names(f"{self.root}/control/{kind}")]
        paths = [f"{t.root}/data/{f}" for t in tables for f in t.folders()]
        rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return fold(rows) if fold else rows

    def checkpoint_log(self, spark: SparkSession, table_id: str) -> VersionedTable:
        """Checkpoints of a table, one epoch per cycle; older cycles fold into the newest row per shard."""
        return self._log(spark, "checkpoints", table_id)

    def batch_log(self, spark: SparkSession, table_id: str) -> VersionedTable:
        return self._log(spark, "batches", table_id)

    def reject_log(self, spark: SparkSession, table_id: str) -> VersionedTable:
        """Occurrences of each rejected record that cycles have reported (the
        audit table has the rows; cycles read this state instead)."""
        return self._log(spark, "rejects", table_id)

    def read_checkpoints(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "checkpoints")

    def read_audit(self, spark: SparkSession) -> DataFrame:
        """Audit rows; ids are deterministic (table, whole record, occurrence), so a cycle or micro-batch that ran twice after a failure counts once."""
        return self.read_log(spark, self.audit, control.AUDIT_SCHEMA).dropDuplicates(["id"])

    def read_batches(self, spark: SparkSession) -> DataFrame:
        """Batch log, one row per (table, shard, cycle): a cycle that runs again replaces its rows."""
        return self._all(spark, "batches")

    def _schemas(self, name: str) -> str:
        return f"{self.root}/control/schemas/{quote(name, safe='')}"

    def target_schema(self, spark: SparkSession, name: str) -> TargetSchema | None:
        """The newest version of a target's schema (a small file per version; no Spark job)."""
        files = Files(spark)
        versions = [v for v in files.names(self._schemas(name)) if v.isdigit()]
        if not versions:
            return None
        stored = json.loads(files.read(f"{self._schemas(name)}/{versions[-1]}"))
        return TargetSchema(T.StructType.fromJson(stored["schema"]), stored["owners"])

    def evolve(self, spark: SparkSession, stamped: DataFrame, name: str, ts_col: str, bookkeeping: Sequence[str] = ()) -> DataFrame:
        """SC4, SC5 inside S1: ``stamped`` with its columns as the target takes them.

        New columns and versions after a type conflict join the target's schema, whose
        next version is committed before the rows: a cycle that breaks off in between
        leaves columns without values, and its next try finds them.  The record's id and hash
        were taken before, over the source's own columns."""
        incoming = T.StructType([f for f in stamped.schema.fields if f.name not in bookkeeping])
        known = self.target_schema(spark, name)
        before = known
        if known is None:  # the first cycle, or a target written before its schema was kept
            there = sinks.existing_schema(spark, self.target(name))
            before = TargetSchema(there) if there is not None else TargetSchema()
        after, routes = before.take(incoming)
        moved = [c for c in ("id", ts_col, HASH_COL, "_synced_at") if routes.get(c, c).lower() != c.lower()]
        if moved:
            raise TypeError(f"target {name!r}: the type of {', '.join(moved)} cannot change")
        if after != known:
            files, folder = Files(spark), self._schemas(name)
            version = max([int(v) for v in files.names(folder) if v.isdigit()] + [0]) + 1
            files.write_whole(f"{folder}/{version:018d}", json.dumps(
                {"schema": after.schema.jsonValue(), "owners": after.owners}), uuid.uuid4().hex)
        return stamped.withColumnsRenamed({c: r for c, r in routes.items() if c != r})

    def read_target(self, spark: SparkSession, name: str) -> DataFrame:
        """All rows with all columns that the target has had."""
        known = self.target_schema(spark, name)
        reader = spark.read.schema(known.schema) if known else spark.read
        return reader.parquet(self.target(name)).drop(sinks.DAY_COL, HASH_COL)

    def read_merged(self, spark: SparkSession, name: str, types: dict[str, str] | None = None) -> DataFrame:
        """A target with the versions of each column merged (:func:`merge_versions`)."""
        return merge_versions(self.read_target(spark, name), self.target_schema(spark, name) or TargetSchema(), types)

    def next_seq(self, spark: SparkSession, table_id: str | None = None) -> int:
        """Next cycle number (of a table: other tables' cycles do not matter); no Spark job."""
        names = [table_id] if table_id is not None else [
            unquote(t) for t in Files(spark).names(f"{self.root}/control/checkpoints")]
        return max([self.checkpoint_log(spark, t).last_epoch("main") for t in names] + [0]) + 1


def _rejected_hash(rejected: DataFrame):
    """Hash of the whole rejected record (all columns, nulls kept)."""
    return F.sha2(_record_json(rejected), 256)


def _record_json(rejected: DataFrame):
    cols = [c for c in rejected.columns if c not in ("reason", "_conversion_error", "node_id")]
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def quarantine_audit(rejected: DataFrame, table_id: str, node_id: int, as_of, cycle: str = "",
                     known: DataFrame | None = None) -> DataFrame:
    """One audit row per quarantined record (status ``skipped``, reason,
    first 500 characters of the record as JSON, nulls kept).

    The id is the hash of the whole record and its occurrence number: equal
    records are counted (a partial aggregate) and numbered, after the
    occurrences that ``known`` (record_hash, occurrences) has already.
    ``cycle`` tells apart deliveries that may repeat a record (stream epochs)."""
    groups = rejected.select(_rejected_hash(rejected).alias("record_hash"), "reason",
                             F.substring(_record_json(rejected), 1, 500).alias("record_sample"))
    groups = groups.groupBy("record_hash", "reason", "record_sample").agg(F.count(F.lit(1)).alias("n"))
    if known is not None:
        groups = groups.join(known, "record_hash", "left")
        groups = groups.withColumn("first", F.coalesce("occurrences", F.lit(0)) + 1)
    else:
        groups = groups.withColumn("first", F.lit(1).cast("bigint"))
    each = groups.withColumn("occurrence", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    rid = F.concat(F.lit(f"skip-{table_id}-{cycle}-"), "record_hash", F.lit("-"), F.col("occurrence").cast("string"))
    return each.select(
        rid.alias("id"), ts_lit(as_of).alias("timestamp"), F.lit(table_id).alias("table_id"),
        F.lit(node_id).cast("int").alias("node_id"), F.lit("skipped").alias("status"), F.col("reason"),
        "record_sample", F.lit(None).cast("bigint").alias("source_count"),
        F.lit(None).cast("bigint").alias("target_count"), F.lit(None).cast("bigint").alias("delta"),
        F.lit(None).cast("string").alias("check_results"), F.lit(None).cast("string").alias("message"))


def _unreported(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows beyond the occurrences that are reported already: equal rows are
    folded and counted, and only the surplus is given out again."""
    cols = rows.columns
    folded = rows.select(_rejected_hash(rows).alias("record_hash"), F.struct(*cols).alias("r")).groupBy("record_hash").agg(
        F.first("r").alias("r"), F.count(F.lit(1)).alias("n"))
    surplus = folded.join(known, "record_hash", "left").withColumn("left", F.col("n") - F.coalesce("occurrences", F.lit(0)))
    surplus = surplus.where("left > 0").withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("left"))))
    return surplus.select("r.*")


def stamp_synced(df: DataFrame, ts_col: str, as_of, exclude=(), keep_hash: bool = False) -> DataFrame:
    """Key every row (M4, over the record columns only) and stamp
    ``_synced_at`` (a parameter, never the clock)."""
    return with_record_id(df, ts_col, exclude=exclude, keep_hash=keep_hash).withColumn("_synced_at", ts_lit(as_of))


def _as_datetime(spark: SparkSession, as_of):
    if isinstance(as_of, str):
        import datetime as _dt
        try:
            return _dt.datetime.fromisoformat(as_of)
        except ValueError:
            pass
    if not isinstance(as_of, str):
        return as_of
    return spark.range(1).select(ts_lit(as_of)).first()[0]


def _phase_of(cursor, as_of_ts) -> str:
    """S5 on the driver for one cursor value (no cursor yet: initial)."""
    if cursor is None:
        return "initial"
    lag = (as_of_ts - cursor).total_seconds()
    if lag > control.CATCHUP_THRESHOLD_S:
        return "initial"
    return "catchup" if lag > control.STEADY_THRESHOLD_S else "steady"


def _phase_batch_size(spec: TableSpec, cursor, as_of_ts) -> int:
    """Batch size of the phase, the table's override first."""
    phase = _phase_of(cursor, as_of_ts)
    return int(spec.batch_sizes.get(phase, control.BATCH_SIZE.get(phase, control.OTHER_BATCH_SIZE)))


def _case_by_node(values: dict, default=None, wrap=F.lit):
    expr = None
    for node, v in values.items():
        lit = wrap(v)
        expr = F.when(F.col("node_id") == node, lit) if expr is None else expr.when(F.col("node_id") == node, lit)
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def late_window(spec: TableSpec, src: DataFrame, cursors: Mapping, store: SyncStore, as_of, known: DataFrame) -> DataFrame:
    """S11 inside the sync: rows that arrived behind their shard's cursor, by
    at most ``spec.allowed_lateness``, and are not in the target yet.

    The window is a constant range of time, pushed to the scan of the source;
    the target is read in the partitions of that range only.  Records are
    recognised by (timestamp, id, whole hash); those that cannot be converted by
    the occurrences that were reported (``known``)."""
    ts = F.col(spec.ts_col)
    late = F.expr(f"INTERVAL {spec.allowed_lateness}")
    lo, hi = F.lit(min(cursors.values())) - late, F.lit(max(cursors.values()))
    behind = (ts <= _case_by_node(cursors)) & (ts > _case_by_node(cursors) - late)
    tagged = quarantine_split(src.where((ts > lo) & (ts <= hi)).where(behind), spec.ts_col, "_conversion_error")
    valid = tagged.where(F.col("reason").isNull())
    stamped = stamp_synced(valid, spec.ts_col, as_of, exclude=["node_id", "reason", "_conversion_error"], keep_hash=True)
    there = sinks.stored_identities(stamped, store.target(spec.target), spec.ts_col, lo, hi, grain=spec.partition_grain)
    new = stamped.join(there, there.columns, "left_anti").select(*valid.columns).select(*src.columns)
    rejected = tagged.where(F.col("reason").isNotNull()).select(*src.columns)
    return new.unionByName(_unreported(rejected, known))


def sync_cycle(spark: SparkSession, spec: TableSpec, source: DataFrame, store: SyncStore, as_of,
               batch_size: int | str | None = None, seq: int | None = None, target_schema: T.StructType | None = None,
               start=None) -> list[dict]:
    """One cycle over every shard of a table in one plan.

    The shard is a logical column (F1/F4); each shard has its own cursor
    (S3), so the pull is ``ts > cursor(shard)``, cut per shard at the tie-safe
    batch end (O1) when ``batch_size`` is given (``"auto"``: each shard's
    size follows its phase, S5/S6).  A shard without a checkpoint starts at
    ``start``; by default nothing bounds it.  With ``spec.allowed_lateness``
    the cycle also takes rows that arrived behind the cursors (S11), whatever
    the batch size.  Rows whose timestamp is missing
    can never pass a cursor: every cycle looks for those that the audit table
    does not have yet, and shard 0 reports them.  Returns one counter dict per
    shard that pulled rows (empty when caught up); in each, pulled = written
    + duplicates + rejected."""
    t0 = time.time()
    seq = seq if seq is not None else store.next_seq(spark, spec.table_id)
    spark.sparkContext.setJobDescription(f"sync {spec.table_id} cycle {seq}")
    # the state before this cycle: a cycle that runs again starts where its first try did
    checkpoint_log, reject_log = store.checkpoint_log(spark, spec.table_id), store.reject_log(spark, spec.table_id)
    checkpoints = checkpoint_log.read("main", before=seq)
    curs = control.load_checkpoint(checkpoints, spec.table_id, spec.n_shards, spark, start).collect()
    cursor = {r["node_id"]: r["cursor"] for r in curs}
    restarted = {r["node_id"]: bool(r["restarted"]) for r in curs}
    prev = {r["node_id"]: (r["records_ingested"], r["records_pulled"]) for r in curs}
    prev_ts = {r["node_id"]: (None if r["restarted"] else r["cursor"]) for r in curs}

    as_of_ts = _as_datetime(spark, as_of)
    src = scan_columns(source, spec.columns, spec.ts_col)
    if target_schema is not None:
        src = type_projection(src, target_schema)
    ts = F.col(spec.ts_col)
    node = shard_of(ts, spec.n_shards, spec.shard_method) if spec.n_shards > 1 else F.lit(0)
    src = src.withColumn("node_id", F.coalesce(node, F.lit(0)).cast("int"))
    bounded = {n: c for n, c in cursor.items() if c is not None}
    after = ts.isNotNull()
    if bounded:
        open_nodes = F.col("node_id").isin([n for n in cursor if n not in bounded])
        after = (ts > _case_by_node(bounded)) | (open_nodes & ts.isNotNull()) if len(bounded) < len(cursor) else ts > _case_by_node(bounded)
    if batch_size == "auto":
        # Each shard's batch follows its phase (lag of its cursor), per-table overrides first
        sizes = {n: _phase_batch_size(spec, cursor[n] if not restarted[n] else None, as_of_ts)
                 for n in range(spec.n_shards)}
    elif batch_size is not None:
        sizes = {n: int(batch_size) for n in range(spec.n_shards)}
    if batch_size is not None:
        # O1: each shard's batch end is counted, not gathered: no candidate row moves
        his = batch_ends(src.where(after).select("node_id", spec.ts_col), spec.ts_col, sizes, "node_id")
        after = (after & (ts <= _case_by_node(his, wrap=instant))) if his else F.lit(False)
    known = reject_log.read("main", before=seq)
    pulled = src.where(after).unionByName(_unreported(src.where(ts.isNull()), known))
    if spec.allowed_lateness and bounded:
        pulled = pulled.unionByName(late_window(spec, src, bounded, store, as_of, known))
    tagged = quarantine_split(pulled, spec.ts_col, "_conversion_error")
    stage_path = store.staging(spec.table_id, 0, seq)
    tagged.hint("rebalance").write.mode("overwrite").parquet(stage_path)
    staged = spark.read.parquet(stage_path)
    valid_ts = F.when(F.col("reason").isNull(), ts)
    stats = staged.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("pulled"), F.count("reason").alias("rejected"),
        F.min(valid_ts).alias("lo"), F.max(valid_ts).alias("hi"),
        F.min(sinks.partition_value(valid_ts, spec.partition_grain)).alias("first_day"),
        F.max(sinks.partition_value(valid_ts, spec.partition_grain)).alias("last_day")).collect()  # per shard
    if not stats:
        return []
    days = [d for r in stats for d in (r["first_day"], r["last_day"]) if d is not None]
    valid = staged.where(F.col("reason").isNull()).drop("reason", "_conversion_error")
    nodes = [r["node_id"] for r in stats]
    stamped = stamp_synced(valid, spec.ts_col, as_of, exclude=["node_id"], keep_hash=True)
    written = sinks.keyed_write(store.evolve(spark, stamped, spec.target, spec.ts_col, ["node_id"]),
                                store.target(spec.target), spec.ts_col,
                                days=days, count_by="node_id", count_values=nodes, grain=spec.partition_grain)
    if any(r["rejected"] for r in stats):
        rej = staged.where(F.col("reason").isNotNull())
        quarantine_audit(rej.drop("node_id"), spec.table_id, 0, as_of, known=known) \
            .write.mode("overwrite").parquet(store.folder(store.audit, spec.table_id, seq))
        reject_log.append(rej.groupBy(_rejected_hash(rej).alias("record_hash")).agg(
            F.count(F.lit(1)).alias("occurrences")), seq)
    seconds = time.time() - t0
    cp_rows, log_rows, out = [], [], []
    for r in stats:
        n = r["node_id"]
        ing, pul = prev.get(n, (0, 0))
        ingested = r["pulled"] - r["rejected"]
        last = max([t for t in (r["hi"], prev_ts.get(n)) if t is not None], default=None)
        phase = _phase_of(last, as_of_ts)
        size = _phase_batch_size(spec, last, as_of_ts)
        # written even without a valid timestamp: the shard has then reported its rows without one
        cp_rows.append((f"{spec.table_id}_{n}", spec.table_id, n, last, ing + ingested, pul + r["pulled"],
                        as_of_ts, phase, size, seq, spec.n_shards))
        log_rows.append((spec.table_id, n, seq, r["pulled"], written[n], r["rejected"], r["lo"], r["hi"], phase,
                         as_of_ts, seconds))
        out.append({"table_id": spec.table_id, "node_id": n, "pulled": r["pulled"], "written": written[n],
                    "duplicates": ingested - written[n], "rejected": r["rejected"], "seq": seq, "seconds": seconds,
                    "cursor": last})
    store.batch_log(spark, spec.table_id).append(spark.createDataFrame(log_rows, BATCH_LOG_SCHEMA).coalesce(1), seq)
    # the cursor moves only after data and audit are committed
    checkpoint_log.append(spark.createDataFrame(cp_rows, control.CHECKPOINT_SCHEMA).coalesce(1), seq)
    sinks.drop_table(spark, stage_path)  # committed everywhere: the stage is not needed again
    return out


def incremental_sync(spark: SparkSession, spec: TableSpec, source: DataFrame, store: SyncStore, as_of,
                     batch_size: int | str | None = None, max_cycles: int | None = None, **kw) -> list[dict]:
    """S1 run: cycles until every shard is caught up (an empty cycle), or
    ``max_cycles``.  Without ``batch_size`` one cycle takes everything.  A
    cycle that neither moves a cursor nor reports a row ends the run."""
    out, cycles, before = [], 0, {}
    seq = store.next_seq(spark, spec.table_id)
    while max_cycles is None or cycles < max_cycles:
        r = sync_cycle(spark, spec, source, store, as_of, batch_size, seq=seq, **kw)
        cycles += 1
        seq += 1
        if not r:
            break
        out.extend(r)
        now = {**before, **{x["node_id"]: x["cursor"] for x in r}}
        if batch_size is None or (now == before and not any(x["rejected"] for x in r)):
            break
        before = now
    return out


def multi_table_sync(spark: SparkSession, specs: Sequence[TableSpec], sources: Mapping[str, DataFrame],
                     store: SyncStore, as_of, batch_size: int | str | Mapping | None = None,
                     parallelism: int = 3) -> DataFrame:
    """Every configured table in its own job (thread pool); a failing
    table is recorded as an ``error`` audit row and does not stop the others.
    ``batch_size`` holds for all tables, or maps table ids to sizes; ``"auto"``
    takes each table's own ``batch_sizes`` by phase."""
    validate_specs(specs)

    def run(spec):
        # each table's jobs go to their own scheduler pool (isolated under the FAIR scheduler)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"sync-{spec.table_id}")
        try:
            size = batch_size.get(spec.table_id) if isinstance(batch_size, Mapping) else batch_size
            res = incremental_sync(spark, spec, sources[spec.table_id], store, as_of, size)
            return (spec.table_id, "ok", sum(r["pulled"] for r in res), sum(r["written"] for r in res),
                    sum(r["rejected"] for r in res), None)
        except Exception as exc:  # noqa: BLE001 - per-table isolation
            log.exception("sync of %s failed", spec.table_id)
            msg = f"{type(exc).__name__}: {exc}"[:500]
            stamp = _as_datetime(spark, as_of)
            part = f"error-{uuid.uuid4().hex}"  # every failure is a row of its own
            spark.createDataFrame([(f"{part}-{spec.table_id}", stamp, spec.table_id, None, "error", msg, None, None,
                                    None, None, None, msg)], control.AUDIT_SCHEMA).coalesce(1) \
                .write.mode("overwrite").parquet(store.folder(store.audit, spec.table_id, part))
            return (spec.table_id, "error", 0, 0, 0, msg)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(run, specs))
    return spark.createDataFrame(rows, "table_id string, status string, pulled long, written long, "
                                       "quarantined long, error string")
