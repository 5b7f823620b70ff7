"""The few file operations that Spark's readers and writers do not offer.

They use the Hadoop file system that Spark itself writes with, so they work on any
storage Spark can reach. Names and schemas are handled here, never data.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, *parts: str):
        path = self._root
        for part in parts:
            path = self._jvm.org.apache.hadoop.fs.Path(path, part)
        return path

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._path(*parts))

    def names(self, *parts: str) -> list[str]:
        """Names directly below a folder; none if there is no such folder."""
        path = self._path(*parts)
        if not self._fs.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(path)]

    def write_text(self, text: str, *parts: str) -> None:
        """Create a small file under another name and rename it, so that it is never seen half written."""
        draft = (*parts[:-1], f".{parts[-1]}.{uuid.uuid4().hex}")
        stream = self._fs.create(self._path(*draft), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if self._fs.exists(self._path(*parts)):
            self._fs.delete(self._path(*parts), False)
        if not self._fs.rename(self._path(*draft), self._path(*parts)):
            raise OSError(f"could not put {'/'.join(parts)} in place")

    def create_text(self, text: str, *parts: str) -> bool:
        """Create a small file unless there is one of that name; says if it did. Of several callers one succeeds.

        The file appears whole. It needs a file system whose rename refuses an existing target
        as one step, as HDFS does; on a local disk a hard link takes its place.
        """
        draft = (*parts[:-1], f".{parts[-1]}.{uuid.uuid4().hex}")
        self.write_text(text, *draft)
        source, target = self._path(*draft), self._path(*parts)
        try:
            if self._fs.getScheme() == "file":
                local = [self._jvm.java.nio.file.Path.of(p.toUri().getPath(), self._no_names()) for p in (target, source)]
                self._jvm.java.nio.file.Files.createLink(*local)
            else:
                rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
                plain = self._gateway.new_array(rename, 0)
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._fs.getConf())
                context.rename(source, target, plain)
            return True
        except Py4JJavaError as error:
            if self._fs.exists(target):
                return False
            raise error
        finally:
            self._fs.delete(source, False)

    def _no_names(self):
        return self._gateway.new_array(self._jvm.java.lang.String, 0)

    def changed_at(self, *parts: str) -> int:
        """When a file or folder was last changed, in milliseconds."""
        return self._fs.getFileStatus(self._path(*parts)).getModificationTime()

    def holds_text(self, *parts: str) -> bool:
        """Is there a file here that is not empty?"""
        path = self._path(*parts)
        return self._fs.exists(path) and self._fs.getFileStatus(path).getLen() > 0

    def read_text(self, *parts: str) -> str:
        stream = self._fs.open(self._path(*parts))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, *parts: str) -> None:
        if not parts:
            raise ValueError("will not remove the root")
        self._fs.delete(self._path(*parts), True)
