"""Which batches of a store below a shared path are in effect: one marker file each, put there by one rename."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Marks:
    """Names in the order in which they took effect. A name is a batch's id and holds no slash."""

    def __init__(self, spark: SparkSession, path: str):
        self._path, self._hadoop = path.rstrip("/"), spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("x").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self._path}/{name}")

    def names(self) -> list[str]:
        found = sorted(m.getPath().getName() for m in self._fs.globStatus(self._at("*.ok")) or [])
        return [f.partition(".")[2][:-3] for f in found]

    def add(self, name: str) -> None:
        """Takes effect at once or not at all; what was written for it must be complete."""
        number = len(self.names())
        draft, final = self._at(f"{number:09d}.{name}.draft"), self._at(f"{number:09d}.{name}.ok")
        self._fs.mkdirs(self._at(""))
        self._fs.create(draft, True).close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"{name} could not be put into effect")
