"""Table scans with column selection (SRC1-SRC3)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_utc

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class ColumnSelectionError(ValueError):
    pass


def normalize_columns(columns, ts_col: str) -> list[str]:
    """SRC2: ``None``/``"*"``/``["*"]`` mean all columns; a list must be
    non-empty, made of non-blank strings (trimmed) and include ``ts_col``."""
    if columns is None or columns == "*" or (isinstance(columns, (list, tuple)) and list(columns) == ["*"]):
        return ["*"]
    if isinstance(columns, str):
        raise ColumnSelectionError("columns must be a list or '*'")
    cols = list(columns)
    if not cols:
        raise ColumnSelectionError("column list is empty")
    out = []
    for c in cols:
        if not isinstance(c, str) or not c.strip():
            raise ColumnSelectionError(f"invalid column name: {c!r}")
        out.append(c.strip())
    if "*" in out:
        raise ColumnSelectionError("'*' cannot be mixed with named columns")
    if ts_col not in out:
        raise ColumnSelectionError(f"timestamp column {ts_col!r} must be selected")
    return out


def as_instant(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP_NTZ columns to TIMESTAMP (UTC session), once, at scan."""
    ntz = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    if not ntz:
        return df
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c) for c in df.columns])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return as_instant(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def scan_columns(df: DataFrame, columns=None, ts_col: str | None = None) -> DataFrame:
    """SRC1: all or a chosen list of columns; Catalyst prunes ReadSchema."""
    cols = normalize_columns(columns, ts_col) if ts_col else (["*"] if columns in (None, "*") else list(columns))
    if cols == ["*"]:
        return df
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ColumnSelectionError(f"unknown columns: {missing}")
    return df.select(*cols)


def source_schema(df: DataFrame) -> list[tuple[str, str, bool, bool]]:
    """SRC3: (name, type, nullable, is_array) of the source, from metadata."""
    out = []
    for f in df.schema.fields:
        is_array = isinstance(f.dataType, T.ArrayType)
        dt = f.dataType.elementType if is_array else f.dataType
        out.append((f.name, dt.simpleString(), f.nullable, is_array))
    return out


def source_schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame(
        source_schema(df), "name string, type string, nullable boolean, is_array boolean"
    )


def tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = DRIVER_TABLES) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in names}
