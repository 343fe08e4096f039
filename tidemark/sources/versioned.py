"""Tables written in epochs, each of them exactly once (SNK2, SNK3, SNK5, S8, S12).

A plain append cannot be retried: a micro-batch that failed after its files
were moved, before its offsets were committed, is appended twice.  Here every
epoch of a writer has a manifest::

    <root>/data/<folder>/            files of one attempt at one epoch, or of a compaction
    <root>/_epochs/<writer>/<epoch>  manifest: the attempt's folder and notes
    <root>/_current                  pointer: compacted folders, and per writer the last epoch in them

* A writer writes the attempt's files into a new folder and then renames the
  manifest into place.  Readers follow manifests, so files of an attempt that
  never got that far do not exist for them; a replay of an epoch writes a new
  folder and replaces the manifest, so the epoch's rows are there once.
* A writer's epochs grow (micro-batches, cycles).  Every ``compact_every``
  epochs the manifests but each writer's newest (it may be replayed) are folded
  into one folder and the pointer is replaced by a rename.  What a reader opens
  stays bounded, however many epochs there were.  With ``fold`` (a state, such as
  the last row per key) everything becomes one folder; without it (a history)
  folders of like size are merged, so a row is rewritten a logarithmic number of times.
* A crash between any two steps leaves the old or the new state whole.  Folders
  that nothing refers to are removed by ``vacuum``, replaced ones as soon as
  nothing refers to them (a query that still reads them must run again).

The renames must replace a file in one step, as HDFS and local file systems do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import Files


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType,
                 fold: Callable[[DataFrame], DataFrame] | None = None, compact_every: int = 32):
        self.spark, self.root, self.schema, self.fold, self.compact_every = spark, root.rstrip("/"), schema, fold, compact_every
        self.files = Files(spark)

    # ------------------------------------------------------------ what is committed

    def _pointer(self) -> dict:
        text = self.files.read(f"{self.root}/_current")
        return json.loads(text) if text else {"version": 0, "folders": [], "through": {}, "notes": {}}

    def _manifest_path(self, writer: str, epoch: int) -> str:
        return f"{self.root}/_epochs/{quote(writer, safe='')}/{epoch:018d}"

    def _deltas(self, pointer: Mapping) -> list[dict]:
        """Manifests that the pointer has not folded, in (writer, epoch) order."""
        out = []
        for w in self.files.names(f"{self.root}/_epochs"):
            through = pointer["through"].get(unquote(w), -1)
            for name in self.files.names(f"{self.root}/_epochs/{w}"):
                if name.isdigit() and int(name) > through:
                    text = self.files.read(f"{self.root}/_epochs/{w}/{name}")
                    if text:
                        out.append(json.loads(text) | {"writer": unquote(w), "epoch": int(name)})
        return out

    def last_epoch(self, writer: str) -> int:
        """The writer's newest committed epoch, -1 if there is none (no Spark job)."""
        names = [int(n) for n in self.files.names(f"{self.root}/_epochs/{quote(writer, safe='')}") if n.isdigit()]
        return max([*names, self._pointer()["through"].get(writer, -1)])

    def writers(self) -> list[str]:
        return sorted({unquote(w) for w in self.files.names(f"{self.root}/_epochs")} | set(self._pointer()["through"]))

    def notes(self, writer: str | None = None, before: int | None = None) -> dict:
        """Largest value of every note of the committed epochs (of ``writer``, below ``before``)."""
        pointer = self._pointer()
        found = [n for w, n in pointer["notes"].items() if writer in (None, w)]
        found += [m["notes"] for m in self._deltas(pointer) if writer in (None, m["writer"]) and (before is None or m["epoch"] < before)]
        out: dict = {}
        for n in found:
            for k, v in n.items():
                out[k] = v if k not in out else max(out[k], v)
        return out

    def folders(self, writer: str | None = None, before: int | None = None) -> list[str]:
        """Folders to read: the compacted ones and those of later epochs; with
        ``writer`` and ``before``, without that writer's epochs from ``before`` on."""
        pointer = self._pointer()
        later = [m["folder"] for m in self._deltas(pointer)
                 if before is None or m["writer"] != writer or m["epoch"] < before]
        return [f["folder"] for f in pointer["folders"]] + later

    def _frame(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/{f}" for f in folders])

    def read(self, writer: str | None = None, before: int | None = None) -> DataFrame:
        """The committed rows (folded, with a ``fold``); see :meth:`folders`."""
        df = self._frame(self.folders(writer, before))
        return self.fold(df) if self.fold else df

    # ------------------------------------------------------------ writing

    def append(self, df: DataFrame, epoch: int, writer: str = "main", notes: Mapping | None = None) -> bool:
        """Commit ``df`` as the writer's ``epoch``; a replay replaces what the
        epoch held.  False, and nothing is written, if the epoch is compacted
        already: it was committed, and a later one too."""
        if epoch < 0:
            raise ValueError("epochs start at 0")
        if epoch <= self._pointer()["through"].get(writer, -1):
            return False
        folder = self.stage(df, epoch, writer)
        self.commit(folder, epoch, writer, notes)
        return True

    def stage(self, df: DataFrame, epoch: int, writer: str = "main") -> str:
        """First step: the files of one attempt, in a folder that no reader knows yet."""
        folder = f"{quote(quote(writer, safe=''), safe='')}-{epoch}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.root}/data/{folder}")
        return folder

    def commit(self, folder: str, epoch: int, writer: str = "main", notes: Mapping | None = None) -> None:
        """Second step: the manifest.  From here on the epoch's rows are there."""
        path = self._manifest_path(writer, epoch)
        old = self.files.read(path)
        self.files.write_whole(path, json.dumps({"folder": folder, "notes": dict(notes or {})}), uuid.uuid4().hex)
        if old and (was := json.loads(old)["folder"]) != folder:
            self.files.delete(f"{self.root}/data/{was}")
        if len(self._deltas(self._pointer())) >= self.compact_every + len(self.writers()):
            self.compact()

    def compact(self) -> None:
        """Fold all epochs but each writer's newest (only the newest may be replayed)."""
        pointer = self._pointer()
        deltas = self._deltas(pointer)
        newest = {m["writer"]: m["epoch"] for m in deltas}
        old = [m for m in deltas if m["epoch"] < newest[m["writer"]]]
        if not old:
            return
        rows = self._frame([m["folder"] for m in old]).count() if not self.fold else 0
        kept, merged = list(pointer["folders"]), []
        while kept and (self.fold or kept[-1]["rows"] <= 2 * rows):
            merged.insert(0, kept.pop())
            rows += merged[0]["rows"]
        sources = [f["folder"] for f in merged] + [m["folder"] for m in old]
        df = self._frame(sources)
        folder = f"compacted-{pointer['version'] + 1}-{uuid.uuid4().hex[:12]}"
        (self.fold(df) if self.fold else df).hint("rebalance").write.parquet(f"{self.root}/data/{folder}")
        through, notes = dict(pointer["through"]), {w: dict(n) for w, n in pointer["notes"].items()}
        for m in old:
            through[m["writer"]] = max(through.get(m["writer"], -1), m["epoch"])
            mine = notes.setdefault(m["writer"], {})
            for k, v in m["notes"].items():
                mine[k] = v if k not in mine else max(mine[k], v)
        self.files.write_whole(f"{self.root}/_current", json.dumps(
            {"version": pointer["version"] + 1, "folders": [*kept, {"folder": folder, "rows": rows}],
             "through": through, "notes": notes}), uuid.uuid4().hex)
        # the new version is in force; what it replaced is garbage from here on
        for m in old:
            self.files.delete(self._manifest_path(m["writer"], m["epoch"]))
        for f in sources:
            self.files.delete(f"{self.root}/data/{f}")

    def vacuum(self) -> list[str]:
        """Remove folders of attempts that were never committed and of compactions
        that broke off; run it while no writer is at work.  Returns their names."""
        live = set(self.folders())
        dead = [f for f in self.files.names(f"{self.root}/data") if f not in live]
        for f in dead:
            self.files.delete(f"{self.root}/data/{f}")
        return dead
