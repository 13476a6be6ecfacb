"""Small files in a shared folder, through the file system that Spark itself uses.

Pointers, manifests and other metadata lines are read and written by the driver;
the data beside them is always written by Spark jobs.  ``publish`` makes a whole
file appear under a name that nobody else has taken: it is written aside and
renamed without overwriting, so a reader sees it complete or not at all, and of
two writers of one name one is told so.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, of: str = "") -> list[str]:
        """Names in the folder, sorted; none if it is not there."""
        at = self.path(of)
        if not self.fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Make ``name`` hold ``text``; False if the name is taken."""
        aside = f"_aside-{uuid.uuid4().hex}"
        out = self.fs.create(self.path(aside))
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.fs.exists(self.path(name)):
            self.remove(aside)
            return False
        self.fs.mkdirs(self.path(name).getParent())
        options = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        keep = self.spark.sparkContext._gateway.new_array(options, 1)
        keep[0] = options.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(self.path(aside)), self.fs.makeQualified(self.path(name)), keep)
        except Exception as e:  # noqa: BLE001  the rename that lost to another writer
            if "FileAlreadyExists" not in str(e):
                raise
            self.remove(aside)
            return False
        return True

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
