"""Small file-system helper for the commit log, through Hadoop's FileSystem.

Only the driver touches these files (the commit log, configs, epochs); data
files are always written and read by Spark's own Parquet source.  Going
through Hadoop's FileSystem means the same code works for ``file:``, HDFS and
object stores.  An exclusive create (``overwrite=false``) is atomic on local
disks and HDFS; object stores need a conditional put for that guarantee.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid

from pyspark.sql import SparkSession


def temporary(p: str) -> str:
    """A hidden name beside ``p``; listings of versions skip it."""
    return f"{posixpath.dirname(p)}/.{posixpath.basename(p)}.{uuid.uuid4().hex}.tmp"


def link_exclusive(src: str, dst: str) -> bool:
    try:
        os.link(src, dst)
    except FileExistsError:
        return False
    return True


class HadoopFS:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._root = jvm.org.apache.hadoop.fs.Path(root)
        self._fs = self._root.getFileSystem(conf)

    def path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def qualified(self, p: str) -> str:
        return str(self._fs.makeQualified(self.path(p)).toString())

    def exists(self, p: str) -> bool:
        return bool(self._fs.exists(self.path(p)))

    def mkdirs(self, p: str) -> None:
        self._fs.mkdirs(self.path(p))

    def list_names(self, p: str) -> list[str]:
        hp = self.path(p)
        if not self._fs.exists(hp):
            return []
        return sorted(str(s.getPath().getName()) for s in self._fs.listStatus(hp))

    def list_dirs(self, p: str) -> list[str]:
        hp = self.path(p)
        if not self._fs.exists(hp):
            return []
        return sorted(str(s.getPath().getName()) for s in self._fs.listStatus(hp) if s.isDirectory())

    def create_exclusive(self, p: str, text: str) -> bool:
        """Create ``p`` holding ``text``; False if it already exists. The text is
        written to a temporary file first, so ``p`` is never seen half-written:
        a hard link (local disks) or a rename that refuses an existing target
        (HDFS) publishes it."""
        if self.exists(p):
            return False
        tmp = temporary(p)
        self._put(tmp, text)
        if self._fs.getScheme() != "file":
            done = self.rename(tmp, p)
        else:
            done = link_exclusive(self._local(tmp), self._local(p))
        if self.exists(tmp):
            self.delete(tmp)
        return done

    def write_text(self, p: str, text: str) -> None:
        """Replace ``p`` by a whole new file; readers see the old one or the new one."""
        tmp = temporary(p)
        self._put(tmp, text)
        if self._fs.getScheme() == "file":
            os.replace(self._local(tmp), self._local(p))
        else:
            self._replace(tmp, p)

    def _replace(self, src: str, dst: str) -> None:
        """Rename over an existing target in one step."""
        hadoop = self._jvm.org.apache.hadoop.fs
        how = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.OVERWRITE
        hadoop.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf()).rename(self.path(src), self.path(dst), how)

    def _local(self, p: str) -> str:
        return str(self.path(p).toUri().getPath())

    def _put(self, p: str, text: str) -> None:
        out = self._fs.create(self.path(p), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read_text(self, p: str) -> str:
        hp = self.path(p)
        stream = self._fs.open(hp)
        try:
            buf = self._jvm.java.io.ByteArrayOutputStream()
            self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, buf, 65536, False)
            raw = bytes(buf.toByteArray())
            return raw.decode("utf-8")
        finally:
            stream.close()

    def read_json(self, p: str):
        return json.loads(self.read_text(p))

    def delete(self, p: str, recursive: bool = True) -> bool:
        return bool(self._fs.delete(self.path(p), recursive))

    def rename(self, src: str, dst: str) -> bool:
        return bool(self._fs.rename(self.path(src), self.path(dst)))

    def modification_time_ms(self, p: str) -> int:
        return int(self._fs.getFileStatus(self.path(p)).getModificationTime())
