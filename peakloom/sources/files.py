"""Small files and byte ranges through the session's own file systems, so that any store that Spark reads will do."""

from __future__ import annotations

import io

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def size(spark: SparkSession, path: str) -> int:
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getLen()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_range(spark: SparkSession, path: str, start: int, length: int) -> bytes:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        stream.seek(start)
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return read_range(spark, path, 0, size(spark, path)).decode()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that must not be there yet: of two writers one fails."""
    fs, p = _at(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _at(spark, path)
    target = _at(spark, to)[1]
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(p, target):
        raise FileExistsError(f"{path} can't become {to}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


class StoredFile(io.RawIOBase):
    """A file of the store that reads only the ranges that are asked for; `bytes_read` counts them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.length, self.at, self.bytes_read = spark, path, size(spark, path), 0, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.length)[whence]
        return self.at

    def tell(self) -> int:
        return self.at

    def read(self, n: int = -1) -> bytes:
        n = max(0, self.length - self.at if n is None or n < 0 else min(n, self.length - self.at))
        out = read_range(self.spark, self.path, self.at, n) if n else b""
        self.at += n
        self.bytes_read += n
        return out

    def readinto(self, b) -> int:
        out = self.read(len(b))
        b[: len(out)] = out
        return len(out)
