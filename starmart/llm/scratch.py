"""Stored tables of one computation, dropped once its result is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.sources.files import new_location


class Scratch:
    def __init__(self) -> None:
        self._paths: list[tuple[DataFrame | None, str]] = []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` to the shared folder and continues from the files."""
        path = new_location(df.sparkSession, name)
        df.write.parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
        self._paths.append((out, path))
        return out

    def adopt(self, path: str) -> None:
        """Counts a table at ``path`` that something else has written among these."""
        self._paths.append((None, path))

    def lend(self, other: Scratch) -> None:
        """Leaves the tables that are still there to ``other``, for whoever reads the result."""
        other._paths += self._paths
        self._paths = []

    def release(self, *keep: DataFrame) -> None:
        """Deletes all stored tables but these. Nothing that still reads the others may run after it."""
        left = [(df, path) for df, path in self._paths if any(df is k for k in keep)]
        gone = [path for df, path in self._paths if not any(df is k for k in keep)]
        if gone:
            context = SparkSession.active().sparkContext
            for path in gone:
                target = context._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
        self._paths = left
