"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import fingerprint_shard, micros_shard


def ts_lit(value) -> Column:
    return F.lit(value).cast("timestamp") if isinstance(value, str) else F.lit(value)


def check_shard(n: int, i: int) -> None:
    """shard parameters must satisfy n > 0 and 0 <= i < n."""
    if not (isinstance(n, int) and isinstance(i, int) and n > 0 and 0 <= i < n):
        raise ValueError(f"invalid shard {i} of {n}")


def shard_predicate(ts: Column, n: int, i: int, method: str = "micros") -> Column:
    """F1 (``micros``: ``pmod(unix_micros(ts), n) = i``) or F4 (``fingerprint``)."""
    check_shard(n, i)
    shard = micros_shard(ts, n) if method == "micros" else fingerprint_shard(ts, n)
    return shard == F.lit(i)


def shard_filter(df: DataFrame, ts_col: str, n: int, i: int, method: str = "micros") -> DataFrame:
    return df.where(shard_predicate(F.col(ts_col), n, i, method))


def cursor_filter(df: DataFrame, ts_col: str, cursor) -> DataFrame:
    """strictly after the cursor; NULL timestamps never pass.  Pushed to Parquet."""
    return df.where(F.col(ts_col) > ts_lit(cursor))


def existence_probe(probe: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """the probe rows that exist in ``source`` on ``keys`` (batched semi join)."""
    return probe.join(source.select(*keys), list(keys), "left_semi")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Order + limit -> TakeOrderedAndProject (bounded memory per task)."""
    return df.orderBy(*order).limit(n)


def filter_by_type(df: DataFrame, type_col: str, value: str, ts_col: str, n: int = 100,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """equality on the type column, newest first, ``n`` rows."""
    order = [F.col(ts_col).desc()] + [F.col(c).asc() for c in tiebreak]
    return top_n(df.where(F.col(type_col) == F.lit(value)), order, n)


def bounding_box(df: DataFrame, lat_col: str, lon_col: str, min_lat: float, max_lat: float,
                 min_lon: float, max_lon: float, ts_col: str | None = None, as_of=None,
                 lookback: str = "1 hour", n: int | None = 1000, tiebreak: Sequence[str] = ()) -> DataFrame:
    """inclusive lat/lon box (``min_lon > max_lon`` crosses the antimeridian),
    optionally within ``lookback`` before ``as_of``, newest first, ``n`` rows."""
    lat, lon = F.col(lat_col), F.col(lon_col)
    if min_lon <= max_lon:
        lon_ok = lon.between(min_lon, max_lon)
    else:
        lon_ok = (lon >= min_lon) | (lon <= max_lon)
    out = df.where(lat.between(min_lat, max_lat) & lon_ok)
    if ts_col is not None and as_of is not None:
        out = recent_filter(out, ts_col, as_of, lookback)
    if n is None:
        return out
    return top_n(out, [F.col(ts_col).desc()] + [F.col(c).asc() for c in tiebreak], n)


def recent_filter(df: DataFrame, ts_col: str, as_of, lookback: str = "1 hour") -> DataFrame:
    """F8: ``ts >= as_of - lookback``; ``as_of`` is always a parameter."""
    return df.where(F.col(ts_col) >= ts_lit(as_of) - F.expr(f"INTERVAL {lookback}"))


def status_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """IN-list predicate."""
    return df.where(F.col(col).isin(list(values)))


def pk_lookup(df: DataFrame, key_col: str, keys) -> DataFrame:
    """rows by primary key; a frame of keys becomes a semi join."""
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(keys.columns[0]).alias(key_col))
        return df.join(k, key_col, "left_semi")
    if isinstance(keys, (list, tuple, set)):
        return df.where(F.col(key_col).isin(list(keys)))
    return df.where(F.col(key_col) == F.lit(keys))


_OPS = {
    "=": lambda c, v: c == v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v, "in": lambda c, v: c.isin(list(v)),
    "between": lambda c, v: c.between(v[0], v[1]),
    "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v, "$ne": lambda c, v: c != v, "$eq": lambda c, v: c == v,
}


def condition(col: str, op: str, value) -> Column:
    if op not in _OPS:
        raise ValueError(f"unsupported operator {op!r}")
    return _OPS[op](F.col(col), value)


def dynamic_search(df: DataFrame, conditions: Sequence[tuple] = (), order_by: Sequence = (),
                   limit: int | None = None) -> DataFrame:
    """conjunction of (column, op, value) conditions, optional order and limit.
    ``order_by`` items are column names or ``"col DESC"`` strings."""
    out = df
    for col, op, value in conditions:
        out = out.where(condition(col, op, value))
    if order_by:
        cols = []
        for item in order_by:
            parts = item.split()
            c = F.col(parts[0])
            cols.append(c.desc() if len(parts) > 1 and parts[1].upper() == "DESC" else c.asc())
        out = out.orderBy(*cols)
    return out.limit(limit) if limit is not None else out


def range_scan_window(df: DataFrame, ts_col: str, lo, hi, day_col: str | None = None,
                      grain: str = "day") -> DataFrame:
    """half-open ``[lo, hi)``; with a partition column (day or month
    values, see ``grain``) the same range is stated on it too, so directory
    pruning applies."""
    from tidemark.sources.sinks import partition_value

    pred = (F.col(ts_col) >= ts_lit(lo)) & (F.col(ts_col) < ts_lit(hi))
    if day_col is not None:
        pred = pred & (F.col(day_col) >= partition_value(ts_lit(lo), grain)) \
            & (F.col(day_col) <= partition_value(ts_lit(hi), grain))
    return df.where(pred)
