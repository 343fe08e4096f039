"""Schema evolution inside the sync."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle_check import compare, duck
from tidemark.catalog import AS_OF, QUERIES, _three_shapes
from tidemark.operators.schema_plan import TargetSchema
from tidemark.oracle import ORACLE
from tidemark.plans import sync as S
from tidemark.plans.specs import TableSpec

SPEC = TableSpec("t", "t", "ts", "copy", n_shards=2)


def of(text):
    return T.StructType.fromDDL(text)


def test_query_against_sql(spark):
    n, problems = compare(QUERIES["evolving_sync"](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE["evolving_sync"])
    assert n > 0 and not problems


def test_versions_belong_to_their_source_column():
    one, r = TargetSchema().take(of("a int, b string"))
    assert r == {"a": "a", "b": "b"}
    two, r = one.take(of("a string, c date"))
    assert r == {"a": "a_v2", "c": "c"} and two.schema.names == ["a", "b", "a_v2", "c"]
    three, r = two.take(of("a string, a_v2 string, A_v3 int"))  # the source has a column of that name by now
    assert r == {"a": "a_v4", "a_v2": "a_v2_v2", "A_v3": "A_v3"}
    back, r = three.take(of("A int, B int"))
    assert r == {"A": "a", "B": "B_v2"} and back.versions("a") == ["a", "a_v2", "a_v4"]
    assert back.take(of("A int, B int")) == (back, r)


def test_a_cycle_that_breaks_off_after_its_schema_is_done_again(spark, monkeypatch):
    store, shapes = S.SyncStore.fresh(spark), _three_shapes(spark, SF_SMALL)
    S.incremental_sync(spark, SPEC, shapes[0], store, AS_OF)
    write = S.sinks.keyed_write

    def broken(*a, **k):
        write(*a, **k)
        raise RuntimeError("lost after the data")

    monkeypatch.setattr(S.sinks, "keyed_write", broken)
    with pytest.raises(RuntimeError):
        S.incremental_sync(spark, SPEC, shapes[1], store, AS_OF)
    monkeypatch.setattr(S.sinks, "keyed_write", write)
    for shape in shapes[1:]:
        S.incremental_sync(spark, SPEC, shape, store, AS_OF)
    target = store.read_target(spark, "copy")
    assert target.count() == shapes[2].count() == target.select("event_id").distinct().count()
    assert store.target_schema(spark, "copy").versions("value") == ["value", "value_v2", "value_v3"]
    merged = store.read_merged(spark, "copy", {"value": "double"})
    assert "value_v2" not in merged.columns and merged.where(F.col("value").isNull()).count() == shapes[2].where("value is null").count()
    assert dict(store.read_merged(spark, "copy").dtypes)["value"] == "string"


def test_a_target_without_a_stored_schema_and_a_new_type_of_the_time(spark):
    store, shapes = S.SyncStore.fresh(spark), _three_shapes(spark, SF_SMALL)
    S.incremental_sync(spark, SPEC, shapes[0], store, AS_OF)
    S.sinks.drop_table(spark, store._schemas("copy"))
    S.incremental_sync(spark, SPEC, shapes[1], store, AS_OF)
    target = store.read_target(spark, "copy")
    assert target.count() == shapes[1].count() and {"value", "value_v2", "k"} <= set(target.columns)
    stamped = S.stamp_synced(shapes[0].withColumn("ts", F.col("ts").cast("string")), "ts", AS_OF, keep_hash=True)
    with pytest.raises(TypeError, match="ts"):
        store.evolve(spark, stamped, "copy", "ts")
