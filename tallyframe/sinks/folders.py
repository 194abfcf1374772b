"""Small files and names in a folder of any store that Spark can write to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folders:
    """Hadoop's own file calls on one folder, for what Spark's readers and writers have no word for."""

    def __init__(self, spark: SparkSession, root: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._root = root
        path, conf = self._path(""), spark._jsc.hadoopConfiguration()
        self._files = path.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._files.getUri(), conf)
        self._gateway = spark.sparkContext._gateway

    def _path(self, name: str):
        return self._hadoop.Path(f"{self._root}/{name}" if name else self._root)

    def names(self) -> list[str]:
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._path("")))

    def remove(self, name: str) -> None:
        self._files.delete(self._path(name), True)

    def put(self, name: str, text: str) -> None:
        """Write ``text`` as file ``name``, replacing an earlier one in one step where the store can."""
        fresh = self._path(f"_{name}-{uuid.uuid4().hex}")
        out = self._files.create(fresh, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        how = self._gateway.new_array(self._hadoop.Options.Rename, 1)
        how[0] = self._hadoop.Options.Rename.OVERWRITE
        self._context.rename(fresh, self._path(name), how)
