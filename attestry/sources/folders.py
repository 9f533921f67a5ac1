"""One folder for each key on a disk that all tasks see, made without Hadoop's local file system.

Hadoop starts a process for each folder and each file that it makes on such a disk, to set their permissions, and Spark
lists, checks and opens them one by one; with hundreds of thousands of folders that is nearly all of the time. The layout
is Spark's own (`key=value` folders, part files), so either can read what the other has written.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The folder of null and of empty text.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: What Spark escapes in names of folders.
_ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
#: Lines of about so many bytes are handed on at once.
READ_BYTES = 1 << 22


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on the machines' own or mounted disk; None if another store holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def folder_name(key: str, value: str | None) -> str:
    return f"{key}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value) if value else NO_VALUE}"


def folder_value(name: str) -> str | None:
    value = name.split("=", 1)[1]
    return None if value == NO_VALUE else unquote(value)


def key_value(column: str) -> F.Column:
    """The key as it is read back: null for everything that shares the folder of null."""
    text = F.col(column).cast("string")
    return F.when((text != "") & (text != NO_VALUE), text)


def write_lines(frame: DataFrame, keys: list[str], line: str, path: str) -> None:
    """Lines of text, one folder for each key and one file of it for each task, replacing what was there.

    Rows are written as they are dealt. `keys` must come from `key_value`. A file gets its name when it is complete; the
    folders are moved into place together when all tasks have ended.
    """
    spark = frame.sparkSession
    run = uuid.uuid4().hex
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    made = target.suffix(f".{run}")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    root = local_path(spark, made.toString())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{run}.json"
        hidden = f".{name}.{task.taskAttemptId()}"
        at, out, rows = None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(out.name, os.path.join(os.path.dirname(out.name), name))

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            rows += n
            text = batch.column(len(keys)).cast(pa.large_binary())
            data, offsets = text.buffers()[2], np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
            new = np.ones(n, dtype=bool)
            for c in range(len(keys)):
                column = pc.fill_null(batch.column(c), "")
                new[1:] &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            new[1:] = ~new[1:]
            first = np.flatnonzero(new)
            for a, b in zip(first.tolist(), [*first[1:].tolist(), n], strict=True):
                own = tuple(batch.column(c)[a].as_py() for c in range(len(keys)))
                if own != at:
                    close()
                    folder = os.path.join(root, *(folder_name(k, v) for k, v in zip(keys, own, strict=True)))
                    os.makedirs(folder, exist_ok=True)
                    at, out = own, open(os.path.join(folder, hidden), "wb")
                out.write(memoryview(data)[offsets[a] : offsets[b]])
        close()
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    ended = F.concat(F.col(line), F.lit("\n"))
    dealt = frame.sortWithinPartitions(*keys).select(*keys, ended.alias("_line"))
    store.mkdirs(made)
    try:
        dealt.mapInArrow(write, "rows long").agg(F.sum("rows")).collect()
        store.create(spark._jvm.org.apache.hadoop.fs.Path(made, "_SUCCESS")).close()
        store.delete(target, True)
        if not store.rename(made, target):
            raise OSError(f"could not move {made.toString()} to {path}")
    finally:
        store.delete(made, True)


def read_lines(spark: SparkSession, keys: list[str], path: str) -> DataFrame:
    """(keys, line) of all folders that `write_lines` or Spark has made."""
    root = local_path(spark, path)

    def under(folder: str, depth: int) -> Iterator[str]:
        if depth == len(keys):
            yield folder
        else:
            with os.scandir(os.path.join(root, folder)) as found:
                names = [x.name for x in found if x.name.startswith(f"{keys[depth]}=")]
            for name in names:
                yield from under(os.path.join(folder, name), depth + 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, lines, size = [], [], 0

        def packed() -> pa.RecordBatch:
            count = [n for _, n in values]
            columns = [
                pa.array([v[c] for v, _ in values], pa.string()).take(pa.array(np.repeat(np.arange(len(count)), count)))
                for c in range(len(keys))
            ]
            return pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.binary())], names=[*keys, "line"])

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                own = tuple(folder_value(x) for x in folder.split("/"))
                for name in sorted(os.listdir(os.path.join(root, folder))):
                    if name.startswith((".", "_")):
                        continue
                    with open(os.path.join(root, folder, name), "rb") as file:
                        for part in iter(lambda: file.readlines(READ_BYTES), []):  # noqa: B023
                            found = [x for x in part if x.strip()]
                            values.append((own, len(found)))
                            lines += found
                            size += sum(map(len, found))
                            if size >= READ_BYTES:
                                yield packed()
                                values, lines, size = [], [], 0
        if lines:
            yield packed()

    schema = ", ".join([*(f"`{k}` string" for k in keys), "line binary"])
    folders = spark.createDataFrame(pa.table({"folder": pa.array(list(under("", 0)), pa.string())}))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return folders.repartition(parts).mapInArrow(read, schema).withColumn("line", F.col("line").cast("string"))
