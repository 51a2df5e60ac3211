"""Small files and renames in the store that Spark writes to, whatever file system that is."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The file system of a path, through Spark's own Hadoop settings."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._at(self.path).getFileSystem(self._conf)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._at(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at(path)))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """A whole new file or none; false if there is one of this name. Readers never see a part of it."""
        folder, _, name = path.rpartition("/")
        hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(hidden), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return self.move_new(hidden, path)

    def move_new(self, source: str, target: str) -> bool:
        """Renames a file or folder in one step; false, and the source is gone, if the target was there before."""
        java = self._jvm.java.net.URI(self._fs.getUri().toString())
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(java, self._conf)
        parent = self._at(target).getParent()
        self._fs.mkdirs(parent)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            if not self.exists(target):
                context.rename(self._at(source), self._at(target), self._none(kind))
                return True
        except Exception as error:  # noqa: BLE001
            if not self.exists(target):
                raise error
        self.delete(source)
        return False

    def _none(self, kind):
        from pyspark import SparkContext

        return SparkContext._gateway.new_array(kind, 0)

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)
