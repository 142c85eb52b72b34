"""File-system steps of the driver: moving and deleting files by name, below one folder."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system that a folder lies in; paths are URIs as ``_metadata.file_path`` has them."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._files = self.path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        """A path from a name, or from a URI where the name has a scheme."""
        if ":/" in name:
            return self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(name))
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._files.exists(self.path(name))

    def move(self, source: str, target: str) -> None:
        """Moves a file; nothing happens if it has been moved before."""
        if self.exists(source):
            target_path = self.path(target)
            self._files.mkdirs(target_path.getParent())
            if not self._files.rename(self.path(source), target_path):
                raise OSError(f"cannot move {source} to {target}")

    def delete(self, name: str, folder: bool = False) -> None:
        if self.exists(name):
            self._files.delete(self.path(name), folder)

    def matching(self, pattern: str) -> list[str]:
        """URIs of what matches a pattern."""
        found = self._files.globStatus(self._jvm.org.apache.hadoop.fs.Path(pattern))
        return [status.getPath().toUri().toString() for status in (found or [])]
