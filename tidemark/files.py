"""Thin driver-side helper over the Hadoop file system: names, renames and small metadata texts, never data."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RENAMES_AT_ONCE = 8


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def is_file(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target) and fs.getFileStatus(target).isFile()

    def make_folder(self, path: str) -> None:
        fs, target = self._at(path)
        fs.mkdirs(target)

    def names(self, folder: str) -> list[str]:
        """Sorted entry names of a folder, hidden ones left out; empty when the folder is missing."""
        fs, target = self._at(folder)
        if not fs.exists(target):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(target)]
        return sorted(name for name in names if not name.startswith(("_", ".")))

    def is_complete(self, folder: str) -> bool:
        """True when a Spark write into the folder was committed."""
        return self.exists(f"{folder}/_SUCCESS")

    def rename(self, source: str, target: str) -> None:
        """Move a file; one already at the target is an error."""
        fs, old = self._at(source)
        _, new = self._at(target)
        fs.mkdirs(new.getParent())
        if fs.exists(new):
            raise FileExistsError(target)
        if not fs.rename(old, new):
            raise OSError(f"cannot rename {source} to {target}")

    def rename_all(self, pairs: Iterable[tuple[str, str]], replace: bool = False) -> list[str]:
        """Rename many files, a few at a time, and return the targets in the given order; a repeated run may replace its own."""
        pairs, targets, move = iter(pairs), [], self.replace if replace else self.rename
        with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
            while block := list(islice(pairs, 1000)):
                list(pool.map(lambda pair: move(*pair), block))
                targets += [target for _, target in block]
        return targets

    def create_once(self, path: str, text: str) -> bool:
        """Write a small text, whole, unless the path exists already; of several writers one gets True."""
        waiting = f"{path}.{uuid.uuid4().hex}"
        fs, target = self._at(waiting)
        self._put(fs, target, text)
        modes = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.org.apache.hadoop.fs.Options.Rename.NONE.getClass(), 1)
        modes[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        _, new = self._at(path)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(target, new, modes)
        except Py4JJavaError as problem:
            fs.delete(target, False)
            if self.exists(path):
                return False
            raise problem
        return True

    def _put(self, fs, target, text: str) -> None:
        out = fs.create(target, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def details(self, folder: str) -> list[dict]:
        """Path, length and modification time (milliseconds) of a folder's files."""
        fs, target = self._at(folder)
        found = fs.listStatus(target) if fs.exists(target) else []
        return [{"path": s.getPath().toString(), "length": s.getLen(), "time": s.getModificationTime()} for s in found if s.isFile()]

    def write_text(self, path: str, text: str) -> None:
        """Write a small text; readers see the old one or the new one, where the file system can replace a file in one step."""
        fs, target = self._at(f"{path}.new")
        self._put(fs, target, text)
        self.replace(f"{path}.new", path)

    def replace(self, source: str, target: str) -> None:
        """
        Put a file in another's place in one step; a file system that cannot do so sets the old one aside first and
        deletes it when the new one is there.
        """
        fs, old = self._at(source)
        _, new = self._at(target)
        fs.mkdirs(new.getParent())
        options = self._jvm.org.apache.hadoop.fs.Options
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        except Py4JJavaError:  # no FileContext for this scheme
            aside = f"{target}.{uuid.uuid4().hex}"
            if fs.exists(new):
                self.rename(target, aside)
            self.rename(source, target)
            self.delete(aside)
            return
        modes = self._jvm.java.lang.reflect.Array.newInstance(options.Rename.OVERWRITE.getClass(), 1)
        modes[0] = options.Rename.OVERWRITE
        context.rename(old, new, modes)

    def read_text(self, path: str) -> str | None:
        fs, target = self._at(path)
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        fs, target = self._at(path)
        if fs.exists(target) and not fs.delete(target, True):
            raise OSError(f"cannot delete {path}")
