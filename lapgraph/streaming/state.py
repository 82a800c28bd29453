"""Tables that batches rewrite, one folder per version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lapgraph.operators.upsert import upsert, upsert_edges


class VersionedTable:
    """A table below ``path``: a batch reads the newest version before its own and writes
    ``v=<batch id>``. A replayed batch starts from the same version again, so it changes
    nothing; readers take the newest complete version; older ones than the last KEPT go.
    """

    KEPT = 2

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _folder(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder, hadoop.Path

    def versions(self, before: int | None = None) -> list[int]:
        """Complete versions in order, only those lower than ``before`` if it is given."""
        files, folder, path = self._folder()
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        found = [
            int(name[2:]) for name in names
            if name.startswith("v=") and files.exists(path(folder, f"{name}/_SUCCESS"))
        ]
        return sorted(v for v in found if before is None or v < before)

    def read(self, before: int | None = None) -> DataFrame | None:
        versions = self.versions(before)
        return self.spark.read.parquet(f"{self.path}/v={versions[-1]}") if versions else None

    def write(self, table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(f"{self.path}/v={batch_id}")
        files, folder, path = self._folder()
        for version in self.versions(batch_id)[: -(self.KEPT - 1)]:
            files.delete(path(folder, f"v={version}"), True)

    def upsert(self, rows: DataFrame, keys: Sequence[str], mode: str, batch_id: int) -> None:
        """Apply one row per key, see ``operators.upsert.upsert``."""
        old = self.read(before=batch_id)
        self.write(upsert(rows.limit(0) if old is None else old, rows, keys, mode), batch_id)

    def upsert_edges(self, edges: DataFrame, nodes: DataFrame, order: Sequence[str], batch_id: int) -> None:
        """Apply edge events whose two end nodes exist, the latest per (rel, src, dst)."""
        old = self.read(before=batch_id)
        self.write(upsert_edges(edges.limit(0) if old is None else old, edges, nodes, order), batch_id)
