"""Names and folders on the lake's store, through Spark's own file systems.

Only names, lengths and the odd single byte pass the driver; contents are
written and read by Spark tasks. Jobs write into a hidden staging folder and
``rename`` it into place, so a job that dies leaves nothing a reader would see.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# For writes into a staging folder: each task puts its files in place, instead of the
# driver all of them one by one. Nobody reads the folder before the job is through.
TASKS_PLACE_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def staging_folder(parent: str) -> str:
    """A fresh folder under ``parent`` that Spark's readers skip."""
    return f"{parent.rstrip('/')}/_staging-{uuid.uuid4().hex}"


class Store:
    """File operations on the file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, src: str, dst: str) -> None:
        """Move a file or folder to a place that is free."""
        if self.exists(dst) or not self._fs.rename(self._path(src), self._path(dst)):
            raise FileExistsError(f"cannot move {src} to {dst}")

    def rename_all(self, moves: list[tuple[str, str]]) -> None:
        """``rename`` of many, to places of different names in folders that are there."""
        path = self._jvm.org.apache.hadoop.fs.Path
        for src, dst in moves:
            if not self._fs.rename(path(src), path(dst)):
                raise FileExistsError(f"cannot move {src} to {dst}")

    def replace(self, src: str, dst: str) -> None:
        """Move ``src`` to ``dst``, which is removed first."""
        self.delete(dst)
        self.make(dst.rsplit("/", 1)[0])
        self.rename(src, dst)

    def names(self, path: str) -> list[str]:
        """Names of what lies in a folder, in order; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def empty_files(self, path: str) -> list[str]:
        """Names of the files of no length under a path (or a glob), which
        Spark's scans pass over."""
        out, todo = [], [s.getPath() for s in self._fs.globStatus(self._path(path)) or []]
        while todo:
            at = todo.pop()
            for s in self._fs.listStatus(at):
                child = s.getPath()
                if s.isDirectory():
                    if child != at and child.getName()[0] not in "._":
                        todo.append(child)
                elif not s.getLen() and child.getName()[0] not in "._":
                    out.append(child.getName())
        return sorted(out)

    def ends(self, uri: str, head: int = 3, tail: int = 1) -> tuple[bytes, bytes]:
        """First and last bytes of a file named by the URI that Spark gives for it."""
        path = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(uri))
        size = self._fs.getFileStatus(path).getLen()
        stream = self._fs.open(path)
        try:
            read = lambda n: bytes(stream.read() for _ in range(n))
            first = read(min(head, size))
            stream.seek(max(0, size - tail))
            return first, read(min(tail, size))
        finally:
            stream.close()
