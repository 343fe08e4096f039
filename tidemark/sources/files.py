"""Small files and folders through the session's Hadoop file systems (driver side)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """File operations below the shared folder, by path, on whatever store it lies in."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p))

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_whole(self, path: str, text: str, attempt: str) -> None:
        """The file appears with all of its text or not at all, and replaces an
        older one in one step: written beside it under a name that readers skip,
        then renamed over it."""
        folder, name = path.rsplit("/", 1)
        beside = f"{folder}/_{name}.{attempt}"
        fs, p = self._at(beside)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        to = self._jvm.org.apache.hadoop.fs.Path(path)
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf).rename(p, to, how)
