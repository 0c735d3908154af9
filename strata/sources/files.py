"""Small files and folders of the shared store, through Hadoop's file system
(HDFS, object stores, local), on the driver. Table data never passes here."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


class Folder:
    """One folder of the shared store."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names in the folder, sorted; none where there is no folder."""
        if not self._fs.exists(self._at("")):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at("")))

    def age(self, name: str) -> float:
        """Seconds since the entry last changed."""
        return time.time() - self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A new file with ``text``, complete from the moment it can be seen:
        written aside, then renamed. False where the name is taken."""
        aside = f"_{name}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(aside), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.exists(self._at(name)) and self._fs.rename(self._at(aside), self._at(name)):
            return True
        self._fs.delete(self._at(aside), False)
        return False

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
