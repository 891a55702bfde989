"""Tables kept as versions beside each other; a small manifest names the current one of each and is replaced last."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from skein.sources.files import Files


class Store:
    """A folder of any Hadoop file system: <folder>/<table>/v=<n>/ and <folder>/manifest.json.

    One writer at a time. Readers see either all tables of a publication or none; a version that is being read is never
    overwritten. The manifest is replaced by one renaming step.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._files = Files(spark, self.folder)

    def manifest(self) -> dict[str, int]:
        return json.loads(self._files.text(f"{self.folder}/manifest.json") or "{}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}/v={self.manifest()[table]}")

    def publish(self, tables: dict[str, DataFrame], checks: tuple[DataFrame, ...] = (), marks: dict[str, int] | None = None) -> dict[str, int]:
        """Writes a new version of each table and then the manifest, in which `marks` are noted as they are; refuses if
        any of the checks has a row."""
        for check in checks:
            if not check.isEmpty():
                raise ValueError("a check on the new version found violations")
        current = self.manifest()
        following = dict(current)
        for name, df in tables.items():
            following[name] = current.get(name, 0) + 1
            df.write.mode("overwrite").parquet(f"{self.folder}/{name}/v={following[name]}")
        following |= marks or {}
        self._files.replace(f"{self.folder}/manifest.json", json.dumps(following))
        return following
