"""Stores of files that are rewritten in place, and rolled text files: small steps on the file system around Spark jobs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skein.session import delete_folder

POINTER = "CURRENT"


class Folder:
    """A path in whatever file system it lies in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of what lies in the folder; none if there is no folder."""
        if not self.files.exists(self._path("")):
            return []
        return sorted(status.getPath().getName() for status in self.files.listStatus(self._path("")))

    def has(self, name: str) -> bool:
        return self.files.exists(self._path(name))

    def read_text(self, name: str) -> str | None:
        if not self.has(name):
            return None
        stream = self.files.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, name: str, text: str) -> None:
        """Write a file beside and move it over the old one in one step: a reader sees the old text or the new one."""
        beside = f".{name}-{uuid.uuid4().hex}"
        stream = self.files.create(self._path(beside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        flags = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        flags[0] = kind.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.conf)
        context.rename(self._path(beside), self._path(name), flags)

    def move_here(self, source: Folder, old: str, name: str) -> None:
        if not self.files.rename(source._path(old), self._path(name)):
            raise OSError(f"cannot move {source.path}/{old} to {self.path}/{name}")

    def make(self) -> None:
        self.files.mkdirs(self._path(""))

    def delete(self, name: str) -> None:
        self.files.delete(self._path(name), True)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the store's rows, or None before the first write."""
    name = Folder(spark, path).read_text(POINTER)
    return f"{path.rstrip('/')}/{name}" if name else None


def read_store(spark: SparkSession, path: str, schema: StructType | str, kind: str = "json") -> DataFrame:
    """Rows of the store as the last finished rewrite left them; none before the first."""
    version = current_version(spark, path)
    return spark.read.schema(schema).format(kind).load(version) if version else spark.createDataFrame([], schema)


def rewrite_store(rows: DataFrame, path: str, kind: str = "json") -> int:
    """Replace all rows of the store at ``path``, which ``rows`` may itself read; returns their number.

    The new rows are written beside the old ones, counted while they are written and again as they lie there. Only
    if both counts agree the pointer file is switched, in one step; then versions other than the new one are deleted. A failure
    before the switch leaves the old store whole, one after it the new store, with a left-over that the next rewrite
    deletes. One writer at a time; a reader that started before the switch may lose its files after it.
    """
    spark, folder = rows.sparkSession, Folder(rows.sparkSession, path)
    name = f"version-{uuid.uuid4().hex}"
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format(kind).option("ignoreNullFields", False).save(f"{folder.path}/{name}")
    validate(spark, f"{folder.path}/{name}", rows.schema, kind, seen.get["n"])
    folder.replace_text(POINTER, name)
    for old in folder.names():
        if old.startswith("version-") and old != name:
            folder.delete(old)
    return seen.get["n"]


def validate(spark: SparkSession, version: str, schema: StructType, kind: str, expected: int) -> None:
    """Count the rows that lie in a version; raise unless they are as many as were written."""
    found = spark.read.schema(schema).format(kind).load(version).count()
    if found != expected:
        raise ValueError(f"{version} holds {found} rows, {expected} were written")


def rolled_text(lines: DataFrame, path: str, prefix: str, suffix: str = "", max_rows: int = 1_000_000,
                max_bytes: int = 128 << 20, run: str = "0") -> list[str]:
    """Write column ``value`` as lines to files ``<prefix>-<run>-<task>-<number><suffix>`` below ``path``; returns the names.

    A file is closed before the line that would bring it over ``max_rows`` lines or ``max_bytes`` bytes; a longer line has a file of its
    own. Each task rolls its own rows, in order, without a shuffle. Files are written aside and then moved, which
    costs one step of the file system a file; files of the same ``run`` are deleted first, so a run done again replaces its own.
    """
    spark, folder = lines.sparkSession, Folder(lines.sparkSession, path)
    aside = Folder(spark, f"{folder.path}/.aside-{uuid.uuid4().hex}")

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = rows = held = seq = 0
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(0)), 0), np.int64) + 1
            total, files, at = np.append(0, np.cumsum(sizes)), np.empty(len(sizes), np.int32), 0
            while at < len(sizes):
                # Lines that still fit: by rows, and by bytes up to the running sum that fills the file.
                stop = min(at + max_rows - rows, int(np.searchsorted(total, total[at] + max_bytes - held, "right")) - 1)
                if stop <= at:
                    if rows:
                        file, rows, held = file + 1, 0, 0
                        continue
                    stop = at + 1
                files[at:stop] = file
                rows, held = rows + stop - at, held + int(total[stop] - total[at])
                at = stop
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(np.arange(seq, seq + len(sizes))), batch.column(0)], ["_file", "_seq", "value"])
            seq += len(sizes)

    numbered = lines.select("value").mapInArrow(roll, "_file int, _seq long, value string").sortWithinPartitions("_file", "_seq")
    numbered.select("_file", "value").write.partitionBy("_file").text(aside.path)
    folder.make()
    for old in folder.names():
        if old.startswith(f"{prefix}-{run}-"):
            folder.delete(old)
    names = []
    for part in aside.names():
        number = re.fullmatch(r"_file=(\d+)", part)
        for file in Folder(spark, f"{aside.path}/{part}").names() if number else ():
            task = re.match(r"part-(\d+)", file)
            if task:
                names.append(f"{prefix}-{run}-{task[1]}-{int(number[1]):05d}{suffix}")
                folder.move_here(aside, f"{part}/{file}", names[-1])
    delete_folder(spark, aside.path)
    return sorted(names)
