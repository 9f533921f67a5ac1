"""Tables written to the shared work folder and read back, which cuts the lineage."""

from __future__ import annotations

import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from attestry.session import work_dir


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_LISTS: list[list[str]] = []


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a Parquet table under `spark.checkpoint.dir`; survives the loss of executors.

    What the write has shuffled is removed once the table is complete, as nothing reads it again.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    for paths in _LISTS:
        paths.append(path)
    return out


def drop(table: DataFrame) -> None:
    """Delete a stored table. Only for tables that no later action reads: all that came of it has been stored itself."""
    path = _PATHS.pop(table, None)
    if path is not None:
        _delete(table.sparkSession, path)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that are stored inside."""
    paths: list[str] = []
    _LISTS.append(paths)
    try:
        yield paths
    finally:
        _LISTS.remove(paths)


def release(paths: list[str], reader: DataFrame) -> None:
    """Delete noted tables, except those that `reader` still reads."""
    if paths:
        read = {file.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") for file in reader.inputFiles()}
        for path in paths:
            if path.split(":", 1)[-1].lstrip("/") not in read:
                _delete(reader.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
