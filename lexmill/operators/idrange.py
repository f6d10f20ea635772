"""Ranges of record ids, reserved before rows are written.

The number of stored rows is no place to go on from: after a delete the next id would be one that exists. Ids go on from the greatest one
stored (`high_water`), or, with a folder of reservations, from the greatest one ever given out, so that not even the last id comes
back once its row is deleted, and two batches at a time get ranges of their own.

A reservation is one small file, named by its place in the sequence, that says where the next range begins. It is written aside and put in
place only where no file has that name yet, which the file system decides (a hard link locally, a rename without overwriting
elsewhere); who comes second reads the new end and tries the next place. A batch that is run again gets its range again.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def high_water(stored: DataFrame, prefix: str) -> int:
    """Greatest number among the stored ids of a prefix, 0 without any or where rows carry no ids."""
    if "record_id" not in stored.columns:
        return 0
    number = F.regexp_extract("record_id", f"^{prefix}([0-9]+)$", 1).try_cast("bigint")
    return stored.agg(F.max(number)).head()[0] or 0


class IdRanges:
    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.folder = self.jvm.org.apache.hadoop.fs.Path(folder)
        self.fs = self.folder.getFileSystem(self.conf)
        self.fs.mkdirs(self.folder)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, name)

    def _read(self, name: str) -> dict | None:
        if not self.fs.exists(self._path(name)):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self, name: str, value: dict) -> None:
        stream = self.fs.create(self._path(name), True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()

    def _put_in_place(self, aside: str, name: str) -> bool:
        """Whether `aside` became `name`; False where that is taken."""
        source, target = self._path(aside), self._path(name)
        try:
            if self.fs.getUri().getScheme() == "file":
                paths = [self.fs.pathToFile(p).toPath() for p in (target, source)]
                self.jvm.java.nio.file.Files.createLink(*paths)
            else:
                mode = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
                files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.folder.toUri(), self.conf)
                files.rename(source, target, self.gateway.new_array(mode, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.fs.delete(source, False)
        return True

    def reserve(self, prefix: str, batch: str, count: int, used: int = 0) -> int:
        """First of `count` numbers that no other batch gets, above `used`. A batch gets the same again if none of them is used by now."""
        own = f"batch-{prefix}-{hashlib.sha256(batch.encode()).hexdigest()}"
        before = self._read(own)
        if before and before["count"] >= count and before["first"] > used:
            return before["first"]
        while True:
            names = [s.getPath().getName() for s in self.fs.listStatus(self.folder)]
            places = [int(n.rsplit("-", 1)[1]) for n in names if n.startswith(f"range-{prefix}-")]
            last = max(places, default=-1)
            end = self._read(f"range-{prefix}-{last:012d}")["next"] if places else 1
            first = max(end, used + 1)
            aside = f"aside-{uuid.uuid4().hex}"
            self._write(aside, {"batch": batch, "first": first, "next": first + count})
            if self._put_in_place(aside, f"range-{prefix}-{last + 1:012d}"):
                self._write(own, {"first": first, "count": count})
                return first
