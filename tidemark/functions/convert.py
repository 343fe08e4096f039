"""Schema mapping and schema-driven conversion (SC1-SC3, M7, F12, F14).

Conversion is one ``select`` of casts driven by the schema; values that do
not convert become NULL (``try_cast``) and are reported, never raised.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Source (warehouse) type names and the Spark type each maps to.
SCALAR_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 18),
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),
    "DATETIME": T.TimestampType(),
    "GEOGRAPHY": T.StringType(),
    "JSON": T.StringType(),
}
MAX_MILLIS = 9_223_372_036_854_775  # beyond it, microseconds leave 64 bits
NESTED_TYPES = ("RECORD", "STRUCT")


def map_type(type_name: str, fields: Sequence[Mapping] | None = None, lossy_numeric: bool = False) -> T.DataType:
    """SC1: source type name (case-insensitive) -> Spark type; unknown -> string."""
    name = (type_name or "").upper()
    if name in NESTED_TYPES:
        return build_schema(fields or [], lossy_numeric)
    if lossy_numeric and name in ("NUMERIC", "BIGNUMERIC"):
        return T.DoubleType()
    if name not in SCALAR_TYPES:
        log.warning("unknown source type %r mapped to string", type_name)
        return T.StringType()
    return SCALAR_TYPES[name]


def map_field(field: Mapping, lossy_numeric: bool = False) -> T.StructField:
    """SC2: {name, type, mode, fields} -> StructField; REPEATED -> array,
    REQUIRED -> not nullable, NULLABLE/absent -> nullable."""
    dt = map_type(field["type"], field.get("fields"), lossy_numeric)
    mode = (field.get("mode") or "NULLABLE").upper()
    if mode == "REPEATED":
        dt = T.ArrayType(dt, True)
    return T.StructField(field["name"], dt, nullable=(mode != "REQUIRED"))


def build_schema(fields: Sequence[Mapping], lossy_numeric: bool = False) -> T.StructType:
    """SC3: all fields of a source schema."""
    return T.StructType([map_field(f, lossy_numeric) for f in fields])


def normalize_ts(c: Column, source_type: T.DataType | None = None) -> Column:
    """string (ISO-8601 with ``T``/``Z``/offset, or ``yyyy-MM-dd HH:mm:ss``),
    epoch milliseconds (numbers, or digit strings), date or timestamp -> TIMESTAMP;
    anything else -> NULL (routed to quarantine by :func:`quarantine_reason`)."""
    if isinstance(source_type, (T.TimestampType,)):
        return c
    if isinstance(source_type, (T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    if isinstance(source_type, (T.LongType, T.IntegerType, T.ShortType)):
        return F.timestamp_millis(c)
    if isinstance(source_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.timestamp_millis(c.cast("bigint"))
    s = F.trim(c.cast("string"))
    iso = F.coalesce(
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        # without a pattern: a space and a fraction of any length, date-only text
        F.when(s.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), F.try_to_timestamp(s)),
    )
    millis = s.try_cast("bigint")
    epoch = F.when(s.rlike("^-?[0-9]{1,16}$") & (F.abs(millis) <= MAX_MILLIS), F.timestamp_millis(millis))
    return F.coalesce(iso, epoch)


def _convert(c: Column, target: T.DataType, source: T.DataType) -> Column:
    if isinstance(target, T.TimestampType):
        return normalize_ts(c, source)
    if isinstance(target, T.BinaryType) and isinstance(source, T.StringType):
        return F.try_to_binary(c, F.lit("base64"))
    if isinstance(target, T.StringType) and isinstance(source, T.BinaryType):
        return F.base64(c)
    return c.try_cast(target)


def type_projection(df: DataFrame, target: T.StructType, error_col: str = "_conversion_error") -> DataFrame:
    """M7: convert every column to its target type in one projection.  A
    non-null input that converts to NULL names its column in ``error_col``."""
    src = {f.name: f.dataType for f in df.schema.fields}
    cols, failures = [], []
    for f in target.fields:
        if f.name not in src:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        conv = _convert(F.col(f.name), f.dataType, src[f.name])
        cols.append(conv.alias(f.name))
        failures.append(F.when(F.col(f.name).isNotNull() & conv.isNull(), F.lit(f.name)))
    err = F.concat_ws(",", *failures) if failures else F.lit("")
    return df.select(*cols, F.when(err == "", F.lit(None)).otherwise(err).alias(error_col))


def quarantine_reason(ts_col: str, error_col: str | None = "_conversion_error") -> Column:
    """``missing_<ts>`` when the timestamp is missing, else
    ``processing_error: <columns>`` for a failed conversion, else NULL."""
    reason = F.when(F.col(ts_col).isNull(), F.lit(f"missing_{ts_col}"))
    if error_col is not None:
        reason = reason.when(F.col(error_col).isNotNull(),
                             F.concat(F.lit("processing_error: "), F.col(error_col)))
    return reason


def quarantine_split(df: DataFrame, ts_col: str, error_col: str | None = None) -> DataFrame:
    """every row with a ``reason`` column (NULL = valid)."""
    if error_col is not None and error_col not in df.columns:
        error_col = None
    return df.withColumn("reason", quarantine_reason(ts_col, error_col))
