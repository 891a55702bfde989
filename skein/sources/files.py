"""Small files of any Hadoop file system, written and replaced as a whole from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Access to the file system of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._hadoop = spark._jvm.org.apache.hadoop
        self._context = self._hadoop.fs.FileContext.getFileContext(self._path(folder).toUri(), spark._jsc.hadoopConfiguration())
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):  # noqa: ANN202
        return self._hadoop.fs.Path(name)

    def text(self, name: str) -> str | None:
        """The text of a file; None if there is none."""
        if not self._fs.exists(self._path(name)):
            return None
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Writes beside the file and renames over it in one step, so that a reader sees the old text or the new."""
        fresh = self._path(f"{name}.new")
        out = self._fs.create(fresh, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        kinds = self._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        kinds[0] = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        self._context.rename(fresh, self._path(name), kinds)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
