"""Tables as a sequence of complete Parquet versions below one folder.

A version counts once its write has committed (the ``_SUCCESS`` file), so a
reader sees either the old or the new content, a failed write changes nothing,
and no job overwrites the files it is reading. Large tables are kept in parts
(``parted``), of which a batch rewrites those it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .parted import Parted


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jpath

    def _versions(self, table: str) -> list[int]:
        fs, path = self._fs(f"{self.root}/{table}")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def _committed(self, table: str, version: int) -> bool:
        fs, path = self._fs(f"{self.root}/{table}/v={version}/_SUCCESS")
        return fs.exists(path)

    def version(self, table: str) -> int | None:
        """The newest committed version, if any."""
        for v in reversed(self._versions(table)):
            if self._committed(table, v):
                return v
        return None

    def exists(self, table: str) -> bool:
        return self.parted(table).exists() or self.version(table) is not None

    def parted(self, table: str) -> Parted:
        """The table as one kept in parts, whether it is or not."""
        return Parted(self.spark, f"{self.root}/{table}")

    def read(self, table: str) -> DataFrame:
        if self.parted(table).exists():
            return self.parted(table).read()
        version = self.version(table)
        if version is None:
            raise LookupError(f"no table {table!r} below {self.root}")
        return self.spark.read.parquet(f"{self.root}/{table}/v={version}")

    def publish(self, table: str, df: DataFrame) -> DataFrame:
        """Write the table's new content as its next version and return it as stored."""
        version = max(self._versions(table), default=0) + 1
        path = f"{self.root}/{table}/v={version}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def retain(self, last: int) -> None:
        """Remove all but the newest ``last`` committed versions of every table, and failed writes before them.

        For the end of a run, when nothing reads older versions any more.
        """
        fs, root = self._fs(self.root)
        for status in fs.listStatus(root) if fs.exists(root) else []:
            table = status.getPath().getName()
            if status.isDirectory():
                self.parted(table).retain(last)
            committed = [v for v in self._versions(table) if self._committed(table, v)] if status.isDirectory() else []
            for old in self._versions(table) if len(committed) > last else []:
                if old < committed[-last]:
                    fs.delete(self._fs(f"{self.root}/{table}/v={old}")[1], True)

    def ensure(self, table: str, ddl: str) -> bool:
        """Create the table empty unless it exists; whether it was created."""
        if self.exists(table):
            return False
        self.publish(table, self.spark.createDataFrame([], ddl))
        return True
