"""Validation run over every synchronised table.

For each spec: progress of its shards (V1), freshness of the target (V2)
and a two-way spot check on samples (V3); then the per-table and overall
rollup (A12) and one audit row with all results (V4), appended to the
store's audit table.  A check that fails to run is reported as
``query_failed`` / ``check_failed`` instead of stopping the run.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import with_record_id
from tidemark.operators import control, monitor, reconcile
from tidemark.operators.filters import recent_filter
from tidemark.plans.specs import TableSpec, specs_frame
from tidemark.plans.sync import SyncStore, _as_datetime

log = logging.getLogger(__name__)
CHECK_COLUMNS = ["table_id", "check", "status"]


def _status_row(spark: SparkSession, table_id: str, check: str, status: str) -> DataFrame:
    return spark.createDataFrame([(table_id, check, status)], "table_id string, check string, status string")


def table_checks(spark: SparkSession, spec: TableSpec, source: DataFrame, store: SyncStore, as_of,
                 checkpoints: DataFrame, sample: int = 5, source_lookback: str = "1 hour") -> DataFrame:
    """V1-V3 for one table as (table_id, check, status) rows; the progress of
    a table is its worst shard (no_checkpoint > stalled > severely_lagging >
    lagging > healthy)."""
    one = specs_frame(spark, [spec])
    severity = F.when(F.col("status") == "no_checkpoint", 4).when(F.col("status") == "stalled", 3) \
        .when(F.col("status") == "severely_lagging", 2).when(F.col("status") == "lagging", 1).otherwise(0)
    prog = monitor.progress_check(one, checkpoints, as_of).groupBy("table_id").agg(
        F.lit("progress").alias("check"),
        F.max(F.struct(severity.alias("s"), F.col("status").alias("status")))["status"].alias("status"))
    try:
        target = store.read_target(spark, spec.target)
    except Exception:  # noqa: BLE001 - an absent target is a status
        return prog.unionByName(_status_row(spark, spec.table_id, "smoke_test", "table_not_found")) \
            .unionByName(_status_row(spark, spec.table_id, "spot_check", "table_not_found"))
    try:
        fresh = monitor.freshness_check(spec.table_id, target, spec.ts_col, as_of).select(*CHECK_COLUMNS)
    except Exception:  # noqa: BLE001
        log.exception("freshness check of %s failed", spec.table_id)
        fresh = _status_row(spark, spec.table_id, "smoke_test", "query_failed")
    try:
        keyed = with_record_id(source.select(*[c for c in target.columns if c in source.columns
                                               and c not in ("id", "_synced_at")]), spec.ts_col)
        t_sample = reconcile.newest_sample(target.select("id", spec.ts_col), spec.ts_col, sample)
        s_recent = recent_filter(keyed, spec.ts_col, as_of, source_lookback)
        s_sample = s_recent.orderBy(spec.ts_col, "id").limit(sample)
        ph = reconcile.phantom_records(target, keyed, spec.ts_col, sample=sample)
        mi = reconcile.missing_records(keyed, target, spec.ts_col, sample=sample, as_of=as_of,
                                       lookback=source_lookback)
        spot = monitor.spot_check(spec.table_id, ph, mi, t_sample, s_sample).select(*CHECK_COLUMNS)
    except Exception:  # noqa: BLE001
        log.exception("spot check of %s failed", spec.table_id)
        spot = _status_row(spark, spec.table_id, "spot_check", "check_failed")
    return prog.unionByName(fresh).unionByName(spot)


def validation_run(spark: SparkSession, specs: Sequence[TableSpec], sources: Mapping[str, DataFrame],
                   store: SyncStore, as_of, run_id: str, sample: int = 5,
                   write_audit: bool = True) -> tuple[DataFrame, DataFrame]:
    """V4: checks of all tables, their rollup, and one audit row appended to
    the store.  Returns (checks, rollup).  A run that itself fails leaves an
    audit row too, with status ``error`` and the message, and raises."""
    folder = store.folder(store.audit, "validation", run_id)
    try:
        checkpoints = store.read_checkpoints(spark)
        parts = [table_checks(spark, s, sources[s.table_id], store, as_of, checkpoints, sample) for s in specs]
        checks = parts[0]
        for p in parts[1:]:
            checks = checks.unionByName(p)
        rollup = monitor.health_rollup(checks)
        if write_audit:
            monitor.validation_audit_row(checks, as_of, run_id).write.mode("overwrite").parquet(folder)
    except Exception as exc:
        if write_audit:
            text = f"{type(exc).__name__}: {exc}"[:500]
            row = (f"validation-{run_id}", _as_datetime(spark, as_of), None, None, "error", text, None, None, None, None, None, text)
            spark.createDataFrame([row], control.AUDIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(folder)
        raise
    return checks, rollup
