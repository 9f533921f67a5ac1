"""Batch readers: response logs, project lists, landscape files, run folders."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry import schemas
from attestry.functions.yamljson import spread, yaml_to_json
from attestry.session import folder_names
from attestry.sources import folders

CORRUPT = "_corrupt_record"
LOG_LINES = T.StructType(schemas.RESPONSE_LOG.fields + [T.StructField(CORRUPT, T.StringType())])


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Raw response log: one JSON object per line, fixed schema.

    A line that does not parse keeps its text in ``_corrupt_record``.
    """
    return (
        spark.read.schema(LOG_LINES)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_responses_by_repo(spark: SparkSession, path: str, response: T.DataType) -> DataFrame:
    """(response, owner, repo) of all folders that `write_responses_by_repo` has made."""
    if folders.local_path(spark, path) is None:
        return spark.read.schema(f"response {response.simpleString()}, owner string, repo string").json(path)
    schema = T.StructType([T.StructField("response", response)])
    rows = folders.read_lines(spark, ["owner", "repo"], path)
    return rows.select(F.from_json("line", schema).alias("row"), "owner", "repo").select("row.response", "owner", "repo")


def split_responses(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good lines and bad lines (truncated text, or no query type)."""
    bad = F.col("metadata.queryType").isNull()
    if CORRUPT in log.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
        return log.filter(~bad).drop(CORRUPT), log.filter(bad)
    return log.filter(~bad), log.filter(bad)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file holding one JSON array; absent fields read as NULL."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack tables whose columns differ; absent columns are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_project_list(spark: SparkSession, path: str) -> DataFrame:
    """Targets in either shape: ``{owner,name}`` or a project with ``repos``."""
    return read_json_array(spark, path, schemas.PROJECT_LIST)


def split_project_list(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable entries and the rest (neither a target nor a project)."""
    usable = F.col("repos").isNotNull() | (F.col("owner").isNotNull() & F.col("name").isNotNull())
    return entries.filter(usable), entries.filter(~usable)


def read_landscape(spark: SparkSession, path: str) -> DataFrame:
    """Landscape YAML files, one row per file, parsed to the nested schema."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_file"), "value")
    parsed = spread(files).select("source_file", yaml_to_json(F.col("value")).alias("json"))
    return parsed.select("source_file", F.from_json("json", schemas.LANDSCAPE).alias("doc"))


def read_table_view(spark: SparkSession, path: str, view: str = "data") -> DataFrame:
    """Read Parquet and register it under a view name."""
    frame = spark.read.parquet(path)
    frame.createOrReplaceTempView(view)
    return frame


def row_and_unique_counts(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows and distinct key combinations, NULL keys left out of the key text."""
    key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    return frame.agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("unique_count"))


def read_runs(spark: SparkSession, pattern: str) -> DataFrame:
    """Parquet tables of several runs at once, with the file each row came from."""
    return (
        spark.read.option("mergeSchema", True)
        .parquet(pattern)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def current_run(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of the newest dated run of a table partitioned by ``run_ts``.

    The newest run is found from the names of the run folders; files of the others are not opened.
    """
    path = f"{root.rstrip('/')}/{table}"
    names = [n for n in folder_names(spark, path) if n.startswith("run_ts=")]
    if not names:
        raise ValueError(f"no run of {table} under {root}")
    newest = max(names, key=lambda n: unquote(n.split("=", 1)[1]))
    return spark.read.option("basePath", path).parquet(f"{path}/{newest}")
