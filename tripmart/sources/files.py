"""The few file operations that a commit needs, on any storage that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """Hadoop's file system of each path, as Spark itself uses it."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._settings = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        place = self._path(path)
        return place.getFileSystem(self._settings), place

    def exists(self, path: str) -> bool:
        fs, place = self._open(path)
        return fs.exists(place)

    def delete(self, path: str) -> None:
        fs, place = self._open(path)
        fs.delete(place, True)

    def children(self, path: str) -> list[tuple[str, bool]]:
        """(path, whether it is a folder) of what lies in a folder; nothing if it isn't there."""
        fs, place = self._open(path)
        if not fs.exists(place):
            return []
        return [(f"{path.rstrip('/')}/{s.getPath().getName()}", s.isDirectory()) for s in fs.listStatus(place)]

    def age_hours(self, path: str) -> float:
        import time

        fs, place = self._open(path)
        return (time.time() - fs.getFileStatus(place).getModificationTime() / 1000) / 3600

    def move(self, source: str, target: str) -> None:
        """Rename; where the target is there already, its files are replaced one by one, so an interrupted move can be repeated."""
        fs, place = self._open(source)
        goal = self._path(target)
        if not fs.exists(goal):
            fs.mkdirs(goal.getParent())
            if not fs.rename(place, goal):
                raise OSError(f"can't move {source} to {target}")
            return
        for path, _ in self.children(source):
            name = path.rsplit("/", 1)[-1]
            fs.delete(self._path(f"{target}/{name}"), True)
            if not fs.rename(self._path(path), self._path(f"{target}/{name}")):
                raise OSError(f"can't move {path} to {target}")
        fs.delete(place, True)

    def write(self, path: str, text: str) -> None:
        """Written aside and renamed, so that a file is there whole or not at all."""
        fs, place = self._open(path)
        aside = self._path(f"{path}.part")
        stream = fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        fs.delete(place, False)
        if not fs.rename(aside, place):
            raise OSError(f"can't write {path}")

    def read(self, spark: SparkSession, path: str) -> str:
        return "\n".join(row[0] for row in spark.read.text(path).collect())
