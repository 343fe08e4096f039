"""Deterministic record keys (M4) and hash shards.

All of it is built from Spark column functions, so it stays inside
whole-stage codegen and gives the same value on every executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the id rule: ids lie in [0, 2^53 - 1).
MAX_SAFE_INTEGER = 9007199254740991
TWO_POW_63 = 9223372036854775808
TWO_POW_64 = 18446744073709551616
NULL_MARK = "-"
HASH_COL = "_record_hash"


def canonical_text(c: Column, dt: T.DataType) -> Column:
    """Engine-independent text of one value, led by its length; nulls have a
    mark that no value has.  Different values give different texts: a double
    is written as a decimal only if that decimal is the same double."""
    if isinstance(dt, T.TimestampType):
        s = F.unix_micros(c).cast("string")
    elif isinstance(dt, T.TimestampNTZType):
        s = F.unix_micros(c.cast("timestamp")).cast("string")
    elif isinstance(dt, T.DateType):
        s = F.unix_date(c).cast("string")
    elif isinstance(dt, (T.DoubleType, T.FloatType)):
        exact = c.try_cast(T.DecimalType(38, 9))
        s = F.when(exact.cast("double") == c, exact.cast("string")).otherwise(c.cast("string"))
    elif isinstance(dt, T.BinaryType):
        s = F.hex(c)
    elif isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        s = F.to_json(c, {"ignoreNullFields": "false"})
    else:
        s = c.cast("string")
    return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit(NULL_MARK))


def canonical_record(df: DataFrame, ts_col: str, columns: Sequence[str] | None = None) -> Column:
    """Texts of the timestamp and of the record's columns, in schema order.
    Each part carries its length, so no two records share a text."""
    cols = list(columns) if columns is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [canonical_text(F.col(ts_col), types[ts_col])]
    parts += [canonical_text(F.col(c), types[c]) for c in cols]
    return F.concat(*parts)


def record_hash(df: DataFrame, ts_col: str, columns: Sequence[str] | None = None) -> Column:
    """The full SHA-256 of the record (hex): identity beyond the 53-bit id."""
    return F.sha2(canonical_record(df, ts_col, columns), 256)


def hash_id(sha_hex: Column) -> Column:
    """M4: first 8 bytes of a SHA-256 as a signed big-endian int64, absolute
    value, rounded to double, modulo 2^53-1, as bigint."""
    unsigned = F.conv(F.substring(sha_hex, 1, 16), 16, 10).cast(T.DecimalType(20, 0))
    two63 = F.lit(str(TWO_POW_63)).cast(T.DecimalType(20, 0))
    two64 = F.lit(str(TWO_POW_64)).cast(T.DecimalType(20, 0))
    magnitude = F.when(unsigned >= two63, two64 - unsigned).otherwise(unsigned)
    return (magnitude.cast("double") % F.lit(float(MAX_SAFE_INTEGER))).cast("bigint")


def record_id(df: DataFrame, ts_col: str, columns: Sequence[str] | None = None) -> Column:
    return hash_id(record_hash(df, ts_col, columns))


def with_record_id(df: DataFrame, ts_col: str, id_col: str = "id", exclude: Sequence[str] = (),
                   keep_hash: bool = False) -> DataFrame:
    """Key every row over its record columns (all but ``exclude``, which are
    bookkeeping columns); a source column named like the key is kept as
    ``source_<id>``.  ``keep_hash`` also keeps the whole hash, computed once."""
    if id_col in df.columns:
        df = df.withColumnRenamed(id_col, f"source_{id_col}")
    columns = df.columns
    cols = [c for c in columns if c not in set(exclude)]
    if not keep_hash:
        return df.select(record_id(df, ts_col, cols).alias(id_col), *columns)
    hashed = df.withColumn(HASH_COL, record_hash(df, ts_col, cols))
    return hashed.select(hash_id(F.col(HASH_COL)).alias(id_col), *columns, HASH_COL)


def micros_shard(ts: Column, n: int, sign_safe: bool = True) -> Column:
    """F1: ``unix_micros(ts) mod n``; ``pmod`` by default (pre-1970 rows get a shard)."""
    m = F.unix_micros(ts)
    return F.pmod(m, F.lit(n)) if sign_safe else m % F.lit(n)


def fingerprint_shard(ts: Column, n: int) -> Column:
    """stable hash of the timestamp, modulo n (spreads coarse timestamps)."""
    h = F.conv(F.substring(F.sha2(F.unix_micros(ts).cast("string"), 256), 1, 15), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n))


def shard_of(ts: Column, n: int, method: str = "fingerprint") -> Column:
    if method == "micros":
        return micros_shard(ts, n)
    if method == "fingerprint":
        return fingerprint_shard(ts, n)
    raise ValueError(f"unknown shard method {method!r}")
