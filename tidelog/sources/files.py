"""Small metadata files through Hadoop's file systems, so that local, hdfs:// and object-store paths all work.

A file appears whole or not at all: it is written under a hidden name and then moved. ``create`` never replaces a file:
on local disks the move is a hard link, which fails if the name is taken, elsewhere Hadoop's rename without overwrite,
which HDFS carries out in one step. Object stores that copy instead of renaming need a store with exclusive creation.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_TAKEN = ("FileAlreadyExistsException", "already exists")


class Files:
    def __init__(self, spark: SparkSession):
        self.gateway, self.jvm, self.conf = spark.sparkContext._gateway, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self.jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.conf), target

    def _listed(self, kind, *values):
        made = self.gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            made[i] = value
        return made

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def read_bytes(self, path: str) -> bytes | None:
        fs, at = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def read(self, path: str) -> str | None:
        found = self.read_bytes(path)
        return None if found is None else found.decode(errors="replace")

    def create(self, path: str, content: str | bytes, replace: bool = False) -> bool:
        """Write a whole file; False if the name is taken and it isn't to be replaced."""
        fs, at = self._at(path)
        if not replace and fs.exists(at):
            return False
        hidden = self.jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}-{uuid.uuid4().hex}.tmp")
        stream = fs.create(hidden, True)
        try:
            stream.write(bytearray(content.encode() if isinstance(content, str) else content))
        finally:
            stream.close()
        try:
            self._moved(fs, hidden, at, replace)
        except Py4JJavaError as error:
            if not replace and any(t in str(error.java_exception) for t in _TAKEN):
                return False
            raise
        finally:
            fs.delete(hidden, False)
        return True

    def _moved(self, fs, hidden, at, replace: bool) -> None:
        if at.getFileSystem(self.conf).getScheme() == "file":
            local = lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
            if replace:
                option = getattr(self.jvm.java.nio.file, "StandardCopyOption").ATOMIC_MOVE
                fs.delete(self.jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.crc"), False)
                self.jvm.java.nio.file.Files.move(local(hidden), local(at), self._listed(self.jvm.java.nio.file.CopyOption, option))
            else:
                self.jvm.java.nio.file.Files.createLink(local(at), local(hidden))
            return
        how = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.conf).rename(hidden, at, self._listed(how, how.OVERWRITE if replace else how.NONE))

    def names(self, path: str) -> list[tuple[str, int]]:
        """(name, bytes) of what is in a folder, sorted; hidden files aside."""
        fs, at = self._at(path)
        found = ((s.getPath().getName(), s.getLen()) for s in fs.listStatus(at)) if fs.exists(at) else ()
        return sorted(f for f in found if not f[0].startswith("."))

    def below(self, path: str) -> list[tuple[str, int]]:
        """(path relative to the folder, bytes) of all files below it, sorted; hidden ones and markers aside."""
        fs, at = self._at(path)
        found = []
        if fs.exists(at):
            root, walk = fs.getFileStatus(at).getPath().toUri().getPath().rstrip("/"), fs.listFiles(at, True)
            while walk.hasNext():
                status = walk.next()
                name = status.getPath().toUri().getPath()[len(root) + 1 :]
                if not name.rsplit("/", 1)[-1].startswith((".", "_")):
                    found.append((name, status.getLen()))
        return sorted(found)

    def make_folder(self, path: str) -> None:
        fs, at = self._at(path)
        fs.mkdirs(at)

    def remove(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def rename(self, source: str, target: str) -> None:
        """Within a file system a move; between two a copy and then a removal."""
        fs, at = self._at(source)
        other, to = self._at(target)
        other.mkdirs(to.getParent())
        if fs.getUri().toString() == other.getUri().toString():
            if other.exists(to) or not fs.rename(at, to):
                raise OSError(f"can't move {source} to {target}")
        else:
            self.jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, other, to, True, False, self.conf)

    def copy(self, source: str, target: str) -> None:
        fs, at = self._at(source)
        other, to = self._at(target)
        self.jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, other, to, False, True, self.conf)
