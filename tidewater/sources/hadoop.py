"""Folders and small files through the session's Hadoop file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import empty


class Folders:
    """Listing, renames and small text files on whatever store a path names."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, path: str):
        p = self.path_class(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self.at(path)
        return bool(fs.exists(p))

    def names(self, path: str) -> list[str]:
        """Names directly below a folder, sorted (none if it is missing)."""
        p, fs = self.at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def rename(self, source: str, target: str) -> None:
        p, fs = self.at(source)
        parent = self.path_class(target).getParent()
        fs.mkdirs(parent)
        if not fs.rename(p, self.path_class(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, path: str) -> None:
        p, fs = self.at(path)
        fs.delete(p, True)

    def read_text(self, path: str) -> str:
        p, fs = self.at(path)
        stream = fs.open(p)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write under a private name, then rename: readers see all or nothing."""
        target = self.path_class(path)
        attempt = f"{target.getParent().toString()}/_{uuid.uuid4().hex}"
        p, fs = self.at(attempt)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if fs.exists(target) or not fs.rename(p, target):
            fs.delete(p, False)
            raise FileExistsError(f"{path} was written by another job")

    def touch(self, path: str, millis: int) -> None:
        """Set the modification time."""
        p, fs = self.at(path)
        fs.setTimes(p, millis, -1)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, name below ``root``, length, modified) of all files at any depth,
    listed by Spark; contents are not read. An absent folder has none."""
    folders = Folders(spark)
    if not folders.exists(root):
        return empty(spark, "path string, name string, length long, modified timestamp")
    p, fs = folders.at(root)
    base = fs.makeQualified(p).toString().rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root)
    return files.select("path", F.expr(f"substring(path, {len(base) + 2})").alias("name"), "length",
                        F.col("modificationTime").alias("modified"))
