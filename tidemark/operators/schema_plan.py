"""Schema evolution plans (J5, SC4-SC6)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAN_SCHEMA = "action string, column_name string, data_type string, source_column string"
_INDEX_NAME = re.compile(r"^id$|_id$|[a-z0-9]Id$")


def schema_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields],
                                 "name string, data_type string")


def schema_diff(spark: SparkSession, existing: T.StructType, source: T.StructType) -> DataFrame:
    """Match attributes by name: ``new`` / ``type_changed`` / ``same`` / ``existing_only``."""
    e = schema_frame(spark, existing).select("name", F.col("data_type").alias("existing_type"))
    s = schema_frame(spark, source).select("name", F.col("data_type").alias("source_type"))
    j = e.join(s, "name", "full_outer")
    kind = (F.when(F.col("existing_type").isNull(), "new").when(F.col("source_type").isNull(), "existing_only")
            .when(F.col("existing_type") != F.col("source_type"), "type_changed").otherwise("same"))
    return j.select("name", "existing_type", "source_type", kind.alias("kind"))


def routed_name(existing: T.StructType, source: T.StructType, field: T.StructField) -> str:
    """The target's column for a source column: itself, or after a type conflict the
    first version ``_v2``, ``_v3``, ... that has its type or is free."""
    types = {f.name: f.dataType for f in existing.fields}
    name, version = field.name, 1
    while types.get(name, field.dataType) != field.dataType or (version > 1 and name in source.names):
        version += 1
        name = f"{field.name}_v{version}"
    return name


@dataclass(frozen=True)
class TargetSchema:
    """A target's columns over all its cycles, and the source column that each holds.
    A name has one type for ever, so files of every cycle read with this schema."""

    schema: T.StructType = field(default_factory=T.StructType)
    owners: dict[str, str] = field(default_factory=dict)  # column -> source column, both in lower case

    def take(self, incoming: T.StructType) -> tuple[TargetSchema, dict[str, str]]:
        """The schema after rows of ``incoming``, and the column that each of its columns goes
        to: itself, or the first version ``_v2``, ``_v3``, ... that holds this source column
        with this type, or is free."""
        fields = {f.name.lower(): f for f in self.schema.fields}
        owners, sources, routes = dict(self.owners), {f.name.lower() for f in incoming.fields}, {}
        for f in incoming.fields:
            source, name, version = f.name.lower(), f.name, 1
            while True:
                there = fields.get(name.lower())
                fits = there is None or (there.dataType.simpleString() == f.dataType.simpleString()
                                         and owners.get(name.lower(), name.lower()) == source)
                if fits and (version == 1 or name.lower() not in sources):
                    break
                version += 1
                name = f"{f.name}_v{version}"
            routes[f.name] = there.name if there else name
            if there is None:
                fields[name.lower()] = T.StructField(name, f.dataType, True)
            owners[name.lower()] = source
        return TargetSchema(T.StructType(list(fields.values())), owners), routes

    def versions(self, column: str) -> list[str]:
        """The target's columns that hold a source column, oldest first."""
        return [f.name for f in self.schema.fields if self.owners.get(f.name.lower(), f.name.lower()) == column.lower()]


def merge_versions(target: DataFrame, known: TargetSchema, types: dict[str, str] | None = None) -> DataFrame:
    """A target with one column per source column: the versions of a column are one
    text (a row has a value in at most one of them), or the type given in ``types``
    (values that do not convert are null)."""
    out, done = [], set()
    for c in target.columns:
        owner = known.owners.get(c.lower(), c.lower())
        if owner in done:
            continue
        done.add(owner)
        all_ = [v for v in known.versions(owner) if v in target.columns] or [c]
        kind = (types or {}).get(all_[0], "string" if len(all_) > 1 else None)
        out.append((F.coalesce(*[F.col(v).try_cast(kind) for v in all_]) if kind else F.col(c)).alias(all_[0]))
    return target.select(*out)


def migration_plan(spark: SparkSession, existing: T.StructType | None, source: T.StructType) -> DataFrame:
    """SC4: ``create`` every column when the target is absent; else ``add``
    new columns (nullable) and ``add`` ``{name}_v2`` for a type conflict
    (``_v3`` and so on, where that is taken by another type); nothing is ever
    dropped or altered.  No rows = nothing to do."""
    if existing is None:
        return spark.createDataFrame([("create", f.name, f.dataType.simpleString(), f.name) for f in source.fields],
                                     PLAN_SCHEMA)
    d = schema_diff(spark, existing, source)
    new = d.where(F.col("kind") == "new").select(F.lit("add").alias("action"), F.col("name").alias("column_name"),
                                                 F.col("source_type").alias("data_type"),
                                                 F.col("name").alias("source_column"))
    routed = [(f, routed_name(existing, source, f)) for f in source.fields]
    conflict = spark.createDataFrame([("add", name, f.dataType.simpleString(), f.name) for f, name in routed
                                      if name != f.name and name not in existing.names], PLAN_SCHEMA)
    return new.unionByName(conflict)


def plan_action(plan_rows: Sequence) -> str:
    """Summary of a collected plan: ``create`` / ``migrate`` / ``none``."""
    if not plan_rows:
        return "none"
    return "create" if plan_rows[0]["action"] == "create" else "migrate"


def apply_migration(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """SC5: evolve the target to take ``incoming`` rows: missing columns are
    added (NULL for old rows), old columns are kept, and an incoming column
    whose type conflicts is routed to its version of that type, ``{name}_v2``,
    ``{name}_v3``, ... (old rows keep theirs)."""
    etypes = {f.name: f.dataType for f in existing.schema.fields}
    renames = {f.name: routed_name(existing.schema, incoming.schema, f) for f in incoming.schema.fields}
    inc = incoming.select(*[F.col(c).alias(renames.get(c, c)) for c in incoming.columns])
    # a column present only in the target must be NULL-typed like the target in the incoming rows
    for name, dt in etypes.items():
        if name not in inc.columns:
            inc = inc.withColumn(name, F.lit(None).cast(dt))
    return existing.unionByName(inc, allowMissingColumns=True)


def layout_columns(schema: T.StructType, ts_col: str, extra: Sequence[str] = ()) -> list[str]:
    """SC6: columns worth clustering/sorting on, in schema order: the
    timestamp column, ``id``, names ending in ``_id`` or ``Id`` (not ``id``
    inside a word), plus ``extra`` (e.g. partition columns); nested and array
    columns are skipped."""
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            continue
        if f.name == ts_col or _INDEX_NAME.search(f.name) or f.name in extra:
            out.append(f.name)
    return out
