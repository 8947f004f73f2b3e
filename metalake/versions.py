"""A dataset at one path that is replaced as a whole.

The folder holds finished versions (``v-<id>``) and a small pointer file that
names the current one. Replacing the dataset writes a new version and then
moves a new pointer over the old one, a single file operation: whenever a job
dies, the path reads as it was or as it will be. Nothing that a reader may
still hold is deleted: the version before the current one stays until the
next replacement.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTER = "_current"
#: Where a dataset written by other tools waits while its folder is made.
ASIDE = ".before"


class _Files:
    """The few file operations needed, through Hadoop's API of the path's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def exists(self, text: str) -> bool:
        return self.fs.exists(self.path(text))

    def is_file(self, text: str) -> bool:
        return self.exists(text) and self.fs.getFileStatus(self.path(text)).isFile()

    def names(self, text: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(text))) if self.exists(text) else []

    def read(self, text: str) -> str:
        stream = self.fs.open(self.path(text))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, text: str, content: str) -> None:
        stream = self.fs.create(self.path(text), True)
        stream.write(bytearray(content, "utf-8"))
        stream.close()

    def _context(self):
        """Hadoop's interface with a rename that replaces; None where the file
        system has none, as some object stores."""
        try:
            return self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        except Py4JJavaError as e:
            if "UnsupportedFileSystemException" in str(e.java_exception):
                return None
            raise

    def put(self, text: str, content: str) -> None:
        """The whole file at once, over an old one: written beside it, then
        moved; an object store shows an object when it is whole anyway."""
        where = self._context()
        if where is None:
            return self._write(text, content)
        beside = f"{text}.{uuid.uuid4().hex[:12]}"
        self._write(beside, content)
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        where.rename(self.fs.makeQualified(self.path(beside)), self.fs.makeQualified(self.path(text)), options)

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot move {old} to {new}")

    def make(self, text: str) -> None:
        self.fs.mkdirs(self.path(text))

    def drop(self, text: str) -> None:
        self.fs.delete(self.path(text), True)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder or file to read for ``path``; None if nothing was ever there.

    A path without a pointer is a dataset of another tool and read as it is.
    What an interrupted replacement left behind is never taken for "empty".
    """
    path = path.rstrip("/")
    files = _Files(spark, path)
    if files.exists(f"{path}/{POINTER}"):
        return f"{path}/{files.read(f'{path}/{POINTER}').strip()}"
    own = [n for n in files.names(path) if not n.startswith("v-")]
    if files.is_file(path) or any(not n.startswith(("_", ".")) for n in own):
        return path
    if files.exists(path + ASIDE):
        return path + ASIDE
    folder, _, name = path.rpartition("/")
    left = [n for n in files.names(folder or ".") if n.startswith(f"{name}.before-")]
    if left:
        raise OSError(f"{path} is not there, but {', '.join(left)} is: move it back to go on from it")
    return None


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Put what ``write`` writes into the given folder in the place of the
    dataset at ``path``, which ``write`` may still read. Returns the version."""
    path = path.rstrip("/")
    files = _Files(spark, path)
    before = current(spark, path)
    version = f"v-{uuid.uuid4().hex[:16]}"
    if files.is_file(path):  # a single file of another tool makes room for the folder
        write(f"{path}.{version}")
        files.move(path, path + ASIDE)
        files.make(path)
        files.move(f"{path}.{version}", f"{path}/{version}")
    else:
        write(f"{path}/{version}")
    files.put(f"{path}/{POINTER}", version)
    keep = {POINTER, version, (before or "").rpartition("/")[2]}
    for name in files.names(path):
        if name not in keep:
            files.drop(f"{path}/{name}")
    if files.exists(path + ASIDE):
        files.drop(path + ASIDE)
    return version
