"""Small files next to a table: list, read, delete, and create-if-absent, on any Hadoop file system."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """The files of one directory. ``claim`` needs a file system on which a rename never replaces a file; HDFS is one,
    and local folders use a hard link instead."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.path = self.hadoop.Path(path)
        self.fs = self.path.getFileSystem(self.conf)
        root = urlparse(self.fs.makeQualified(self.path).toString())
        self.local = unquote(root.path) if root.scheme == "file" else None

    def _at(self, name: str):
        return self.hadoop.Path(self.path, name)

    def names(self) -> dict[str, int]:
        """Modification time (milliseconds) of each entry; nothing where the directory does not exist."""
        try:
            return {f.getPath().getName(): f.getModificationTime() for f in self.fs.listStatus(self.path)}
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return {}
            raise

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def bytes(self, name: str) -> int:
        """Bytes of all files of an entry."""
        return self.fs.getContentSummary(self._at(name)).getLength()

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def claim(self, name: str, text: str) -> bool:
        """Create ``name`` with all its content, at once; False where it exists. Of several writers exactly one wins."""
        own = f".{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self._at(own), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            return self._link(own, name) if self.local is not None else self._rename(own, name)
        finally:
            self.delete(own)

    def _link(self, own: str, name: str) -> bool:
        try:
            os.link(os.path.join(self.local, own), os.path.join(self.local, name))
        except FileExistsError:
            return False
        return True

    def _rename(self, own: str, name: str) -> bool:
        kind = getattr(self.hadoop, "Options$Rename")
        never_replace = self.gateway.new_array(kind, 1)
        never_replace[0] = kind.NONE
        try:
            self.hadoop.FileContext.getFileContext(self.path.toUri(), self.conf).rename(self._at(own), self._at(name), never_replace)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True
