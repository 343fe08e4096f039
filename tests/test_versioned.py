"""Epochs are there exactly once: replays, crashes between any two steps, compaction and its crashes."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import fresh_path, scratch_path
from tidemark.sources import sinks
from tidemark.sources.versioned import VersionedTable
from tidemark.streaming import stream

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA).coalesce(1)


def got(table):
    return sorted(tuple(r) for r in table.read().collect())


def fold_sum(df):
    return df.groupBy("k").agg(F.sum("v").alias("v"))


def test_replay_and_a_crash_between_write_and_commit(spark):
    t = VersionedTable(spark, fresh_path(spark, "v"), SCHEMA)
    assert got(t) == [] and t.last_epoch("main") == -1
    t.append(rows(spark, (1, 1)), 0)
    t.stage(rows(spark, (2, 2)), 1)  # the writer dies here: files, no manifest
    assert got(t) == [(1, 1)] and t.last_epoch("main") == 0
    for _ in range(2):  # it comes back, and once more
        assert t.append(rows(spark, (2, 2), (2, 2)), 1)
    assert got(t) == [(1, 1), (2, 2), (2, 2)]  # equal rows inside an epoch stay
    assert t.append(rows(spark, (1, 5)), 0, writer="another one/ with a slash")
    assert got(t) == [(1, 1), (1, 5), (2, 2), (2, 2)]
    assert len(t.vacuum()) == 1 and len(t.files.names(f"{t.root}/data")) == 3
    assert got(t) == [(1, 1), (1, 5), (2, 2), (2, 2)]
    with pytest.raises(ValueError):
        t.append(rows(spark), -1)


@pytest.mark.parametrize("fold", [None, fold_sum])
def test_compaction_keeps_every_row_and_few_files(spark, fold):
    t = VersionedTable(spark, fresh_path(spark, "v"), SCHEMA, fold=fold, compact_every=4)
    most = 0
    for e in range(22):
        t.append(rows(spark, (e % 3, 1)), e, notes={"high": e})
        if e % 7 == 6:
            t.append(rows(spark, (e % 3, 1)), e, notes={"high": e})  # a replay of the newest epoch, compacted neighbours or not
        most = max(most, len(t.folders()))
    want = [(k, sum(1 for e in range(22) if e % 3 == k)) for k in range(3)]
    have = got(t) if fold else sorted(tuple(r) for r in fold_sum(t.read()).collect())
    assert have == want and t.notes() == {"high": 21} and t.notes(before=21) == {"high": 20}
    assert most <= 6 + (0 if fold else 4) and t.last_epoch("main") == 21
    assert t.append(rows(spark, (0, 100)), 3) is False  # long committed
    before = t.read("main", before=21)
    assert fold_sum(before).agg(F.sum("v")).first()[0] == 21


def test_a_crash_inside_compaction_loses_nothing(spark, monkeypatch):
    t = VersionedTable(spark, fresh_path(spark, "v"), SCHEMA, compact_every=100)
    for e in range(4):
        t.append(rows(spark, (e, e)), e)
    want = got(t)
    real = t.files.write_whole
    monkeypatch.setattr(t.files, "write_whole", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        t.compact()  # dies before the pointer moves
    assert got(t) == want
    monkeypatch.setattr(t.files, "write_whole", real)
    monkeypatch.setattr(t.files, "delete", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        t.compact()  # dies after it moved, before the old files are removed
    monkeypatch.undo()
    assert got(t) == want and t.last_epoch("main") == 3
    t.append(rows(spark, (9, 9)), 4)
    t.compact()
    t.vacuum()
    assert got(t) == [*want, (9, 9)] and len(t.files.names(f"{t.root}/data")) <= 3


def test_strict_stream_replays_leave_rows_once(spark):
    src, target = fresh_path(spark, "src"), fresh_path(spark, "target")
    lines = [json.dumps({"k": i, "v": i}) for i in range(50)]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(1).write.text(src)
    for _ in range(2):  # no memory of the first run's offsets: the epoch is delivered again
        stream.strict_stream_append(spark, src, SCHEMA, target, fresh_path(spark, "ck")).awaitTermination()
    assert sinks.read_epochs(spark, target, SCHEMA).count() == 50
    parsed = sinks.strict_parse(spark, spark.createDataFrame([('{"k": 1}',), ('{"zz": 1}',)], "value string"), SCHEMA)
    with pytest.raises(sinks.LoadError, match="^1 rows rejected"):
        sinks.strict_stream_batch(parsed, target, SCHEMA, epoch=7)
    assert sinks.read_epochs(spark, target, SCHEMA).count() == 50


def test_insert_can_be_retried(spark):
    target = fresh_path(spark, "insert")
    for _ in range(3):
        sinks.insert(rows(spark, (1, 1)), target, "batch", epoch=0)
        sinks.insert(rows(spark, (2, 2)), target, "stream", SCHEMA, epoch=1)
    assert sorted(tuple(r) for r in sinks.read_epochs(spark, target, SCHEMA).collect()) == [(1, 1), (2, 2)]


def test_scratch_lies_in_the_applications_folder(spark):
    path = scratch_path(spark, "x")
    assert spark.sparkContext.applicationId in path and path != scratch_path(spark, "x")
