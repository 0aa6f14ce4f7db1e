"""Folders and files through the Hadoop file system, so that they may lie wherever Spark reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``; a temporary one only for a local master without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="wardline-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Files:
    """Names, small files and renames; only metadata and file contents named here pass through the driver's JVM."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self.path(root).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def list(self, folder: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self.path(folder)))

    def sizes(self, folder: str) -> dict[str, int]:
        return {f.getPath().getName(): f.getLen() for f in self._fs.listStatus(self.path(folder)) if f.isFile()}

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self.path(folder))

    def remove(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def write(self, name: str, text: bytes) -> None:
        out = self._fs.create(self.path(name), True)
        try:
            out.write(bytearray(text))
        finally:
            out.close()

    def read(self, name: str) -> bytes:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def swap(self, staged: str, name: str) -> None:
        """Put a finished file in the place of another, in one rename."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        options[0] = rename.OVERWRITE
        context.rename(self.path(staged), self.path(name), options)

    def append_streams(self, names: list[str], target: str) -> None:
        """One file of the bytes of several, copied as a stream, a buffer at a time."""
        out = self._fs.create(self.path(target), True)
        try:
            for name in names:
                stream = self._fs.open(self.path(name))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()
