"""Small files beside the tables of a store, through the file system that Spark itself uses."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """A folder of any Hadoop file system; paths are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm = root.rstrip("/"), spark._jvm
        self._system = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._system.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none where it does not exist."""
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._system.listStatus(self._path(folder)))

    def read(self, name: str) -> str:
        stream = self._system.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False, and nothing changed, where one has this name already."""
        try:
            stream = self._system.create(self._path(name), False)
        except Py4JJavaError:
            if self.exists(name):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def put(self, name: str, text: str) -> None:
        """Write a new file that is seen whole or not at all."""
        draft = f"{name}.{uuid4().hex}"
        folder, _, base = draft.rpartition("/")
        draft = f"{folder}/_{base}" if folder else f"_{base}"
        self.create(draft, text)
        if not self._system.rename(self._path(draft), self._path(name)):
            raise OSError(f"cannot write {self.root}/{name}")

    def delete(self, name: str) -> None:
        self._system.delete(self._path(name), True)
