"""Small files and folders in the stores that Spark reads."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import UnsupportedOperationException
from pyspark.sql import SparkSession


class Files:
    """Small files and folders of whatever file system Spark reads a path from."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing of one that is not there."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> tuple[int, int]:
        """(files, bytes) below a folder, in one call."""
        fs, p = self._at(path)
        c = fs.getContentSummary(p)
        return c.getFileCount(), c.getLength()

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def header(self, path: str, step: int = 1 << 12) -> str:
        """The first CSV record of a file, as its lines stand there; no more is
        read than the steps that hold it."""
        fs, p = self._at(path)
        stream, got, at = fs.open(p), b"", 0
        try:
            while True:
                piece = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(
                    self._jvm.org.apache.commons.io.input.BoundedInputStream(stream, step)))
                got += piece
                end = got.find(b"\n", at)
                while end >= 0:
                    if got.count(b'"', 0, end) % 2 == 0:
                        return got[:end].decode()
                    at, end = end + 1, got.find(b"\n", end + 1)
                if not piece:
                    return got.decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def concatenate(self, target: str, parts: list[str]) -> None:
        """Put the bytes of ``parts`` behind those of ``target``: by the file
        system where it can join files (no byte is moved then), else as one
        stream of bytes, in as much memory as its buffer takes."""
        fs, t = self._at(target)
        full = [p for p in parts if fs.getFileStatus(self._at(p)[1]).getLen() > 0]
        if not full:
            return
        paths = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Path, len(full))
        for i, p in enumerate(full):
            paths[i] = self._at(p)[1]
        try:
            fs.concat(t, paths)
            return
        except UnsupportedOperationException:
            pass
        head = self.read(target)
        out = fs.create(t, True)
        try:
            out.write(bytearray(head.encode()))
            for p in paths:
                part = fs.open(p)
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, self._conf, False)
                finally:
                    part.close()
        finally:
            out.close()

    def rename(self, source: str, target: str) -> bool:
        """Whether ``source`` became ``target``; not if that is there already."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at(target)[1].toUri(), self._conf)
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._at(source)[1], self._at(target)[1], options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
