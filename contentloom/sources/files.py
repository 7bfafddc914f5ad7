"""Small files and folders on any file system that Spark reaches, by Hadoop's own interface."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    """Driver-side handling of folders and of one-line files; tables are read and written by Spark."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _open(self, path: str):
        location = self._hadoop.Path(path)
        configuration = self._spark._jsparkSession.sessionState().newHadoopConf()
        return location, location.getFileSystem(configuration), configuration

    def exists(self, path: str) -> bool:
        location, files, _ = self._open(path)
        return files.exists(location)

    def delete(self, path: str) -> None:
        location, files, _ = self._open(path)
        files.delete(location, True)

    def names(self, path: str) -> list[str]:
        """What lies directly in a folder; nothing if there is no such folder."""
        location, files, _ = self._open(path)
        if not files.exists(location):
            return []
        return sorted(found.getPath().getName() for found in files.listStatus(location))

    def read(self, path: str) -> str | None:
        """The text of a small file, None if there is none."""
        location, files, _ = self._open(path)
        if not files.exists(location):
            return None
        stream = files.open(location)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Readers see the old text or the new one: it is written beside and renamed over."""
        beside = f"{path}.{uuid.uuid4().hex}"
        location, files, configuration = self._open(beside)
        stream = files.create(location, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        option = self._hadoop.Options.Rename
        over = self._spark.sparkContext._gateway.new_array(option, 1)
        over[0] = option.OVERWRITE
        target = self._hadoop.Path(path)
        self._hadoop.FileContext.getFileContext(files.getUri(), configuration).rename(location, target, over)
