"""What the operators share: the words of a text, the shared folder, and bounded slices of Arrow batches.

Words are the runs of ``[^\\x20\\x09-\\x0D]+``. ``bytes.split()`` and ``bytes.lower()`` follow the same
definition on UTF-8, as they know ASCII only.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import urllib.parse
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's regular expression for what stands between words.
GAP = r"[ \t\n\x0B\f\r]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, as in tests, a local session makes and sets a
    temporary folder; a cluster, whose executors couldn't see it, gets an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.sparkContext.setCheckpointDir(found)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quern-{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to a table in the shared folder and read it back: the lineage ends in files that outlive executors."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of one number that are sent to every executor; a table that was counted and has more is joined by shuffle.
MOST_SENT = 500_000


def counted(df: DataFrame, name: str) -> DataFrame:
    """df, staged, with a broadcast hint if it has MOST_SENT rows or fewer."""
    table = staged(df, name)
    return F.broadcast(table) if table.count() <= MOST_SENT else table


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hot_join(left: DataFrame, right: DataFrame, key: str, rows: Column, total: int) -> DataFrame:
    """left joined with right by key, which is unique in right and which all of left's rows find; rows counts left's rows of a
    key and total all of them.

    Keys with more than a fourth of an even part are few, four times the number of parts at most. They are broadcast, so that
    their rows stay where they are; all others are joined as Spark sees fit. left and right are read twice: stage them.
    """
    hot = rows * F.lit(4 * partitions(left.sparkSession)) > F.lit(total)
    few = right.where(hot)
    here = left.join(F.broadcast(few), key)
    there = left.join(F.broadcast(few.select(key)), key, "left_anti").join(right.where(~hot), key)
    return here.unionByName(there)


def text_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others of any name neither clash nor are read."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text mod n; a null doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system: Python workers stay after a task, beside the JVM and its next stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds at most that many bytes of the column, or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends, first, total = np.cumsum(sizes), 0, 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(ends, total + most, side="right")))
            yield batch.slice(first, last - first)
            first, total = last, int(ends[last - 1])
        del batch, sizes, ends
    give_back()


class Arrays:
    """numpy arrays as files of a folder that all executors share.

    A file is written under a name of its own and then moved, so a repeated or lost task leaves either nothing or
    the same whole file. Readers map files into memory; where the folder is in a store without such files, the first
    worker of a machine that needs a file copies it to the machine's temporary folder, and the others map that copy.
    """

    def __init__(self, uri: str) -> None:
        self.uri = uri

    def _path(self) -> str | None:
        parsed = urllib.parse.urlsplit(self.uri)
        return urllib.parse.unquote(parsed.path) if parsed.scheme in ("", "file") else None

    def save(self, name: str, array: np.ndarray) -> None:
        own = f"{name}.{uuid.uuid4().hex}.tmp"
        if path := self._path():
            os.makedirs(path, exist_ok=True)
            with open(f"{path}/{own}", "wb") as out:
                np.save(out, array)
            os.replace(f"{path}/{own}", f"{path}/{name}.npy")
            return
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(self.uri)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{own}") as out:
            sink = pa.BufferOutputStream()
            np.save(sink, array)
            out.write(sink.getvalue())
        store.move(f"{path}/{own}", f"{path}/{name}.npy")

    def load(self, name: str) -> np.ndarray:
        if path := self._path():
            return np.asarray(np.load(f"{path}/{name}.npy", mmap_mode="r"))  # slices of a plain array are cheaper
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(self.uri)
        local = f"{tempfile.gettempdir()}/{self.uri.rpartition('/')[2]}"  # a folder's name is its own
        to, own = f"{local}/{name}.npy", f"{local}/{name}.{uuid.uuid4().hex}.tmp"
        if not os.path.exists(to):
            os.makedirs(local, exist_ok=True)
            fs.copy_files(f"{path}/{name}.npy", own, source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
            os.replace(own, to)
        return np.asarray(np.load(to, mmap_mode="r"))


def partitions(spark: SparkSession) -> int:
    """How many parts a shuffle has in this session: a job that outgrows its memory is given more."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)
