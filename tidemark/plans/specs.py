"""Per-table sync specifications (S9, SRC2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import normalize_columns


class SpecError(ValueError):
    pass


@dataclass(frozen=True)
class TableSpec:
    """One synchronised table: its id, source, timestamp column, selected
    columns, target name, sharding, batch sizes (overrides by phase) and the
    partition grain of its target (``day``, or ``month`` for long low-rate
    tables).  ``allowed_lateness`` (an interval, ``"2 hours"``) makes every cycle
    look again at that much time behind each shard's cursor (S11)."""

    table_id: str
    source: str
    ts_col: str
    target: str
    columns: object = None
    n_shards: int = 1
    shard_method: str = "fingerprint"
    batch_sizes: dict = field(default_factory=dict)
    partition_grain: str = "day"
    allowed_lateness: str | None = None

    def selected(self) -> list[str]:
        return normalize_columns(self.columns, self.ts_col)

    def load(self, spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
        from tidemark.sources.tables import as_instant, read_table
        if sf_dir is not None:
            return read_table(spark, sf_dir, self.source)
        return as_instant(spark.read.parquet(self.source))


def validate_specs(specs: Sequence[TableSpec]) -> list[TableSpec]:
    """Ids and targets unique; each spec's column selection valid."""
    if not specs:
        raise SpecError("no tables configured")
    ids, targets = set(), set()
    for s in specs:
        if not s.table_id or not s.ts_col or not s.target:
            raise SpecError(f"incomplete spec: {s}")
        if s.table_id in ids:
            raise SpecError(f"duplicate table id {s.table_id!r}")
        if s.target in targets:
            raise SpecError(f"duplicate target table {s.target!r}")
        if s.n_shards < 1:
            raise SpecError(f"n_shards must be >= 1 for {s.table_id!r}")
        s.selected()
        ids.add(s.table_id)
        targets.add(s.target)
    return list(specs)


def specs_frame(spark: SparkSession, specs: Sequence[TableSpec]) -> DataFrame:
    """The specs as a small control frame (one row per configured table)."""
    rows = [(s.table_id, s.source, s.ts_col, s.target, s.n_shards, s.shard_method) for s in specs]
    return spark.createDataFrame(
        rows, "table_id string, source string, ts_col string, target string, n_shards int, shard_method string")
