"""Small files of a table, through the file system that holds it."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """Names, texts and deletions below one path, on any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        utils = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        #: How a value is written in the name of a partition's folder, and back.
        self.escape, self.unescape = utils.escapePathName, utils.unescapePathName

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, folder: str) -> list[str]:
        """What a folder holds; nothing if it isn't there."""
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))] if self.exists(folder) else []

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, folder: str, name: str, text: str) -> None:
        """Write a file beside its place and move it there, which is one step of the file system."""
        self._fs.mkdirs(self._at(folder))
        draft, final = self._at(f"{folder}/_{name}"), self._at(f"{folder}/{name}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._fs.delete(final, False)
        if not self._fs.rename(draft, final):
            raise OSError(f"could not write {final}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def numbers(self, folder: str) -> list[int]:
        """The numbers n of the files ``<n>.json`` in a folder, in order."""
        return sorted(int(n[:-5]) for n in self.names(folder) if n.endswith(".json") and n[:-5].isdigit())
