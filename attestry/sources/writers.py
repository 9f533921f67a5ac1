"""Sinks: Parquet, CSV and JSON-lines tables, exports and table upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from attestry import schemas
from attestry.functions import values as V
from attestry.operators.joins import left_join_many
from attestry.sources import folders

# Options of writes with a file or folder for each of very many rows or keys: each task moves its own files into place when
# it ends, instead of the driver all of them, one after another, when the job ends.
MANY_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def describe_columns(frame: DataFrame) -> DataFrame:
    """Attach column descriptions; Spark stores them in the Parquet footer."""
    return frame.select(
        *[
            F.col(f"`{c}`").alias(c, metadata={"comment": schemas.COLUMN_COMMENTS[c]})
            if c in schemas.COLUMN_COMMENTS
            else F.col(f"`{c}`")
            for c in frame.columns
        ]
    )


def write_parquet(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """ZSTD Parquet with described columns, replacing what was there."""
    writer = describe_columns(frame).write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_all(tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Every table of a run to ``root/<table>``; returns the rows of each.

    The rows are counted as they are written, without a scan for it.
    """
    counts = {}
    for name, frame in tables.items():
        seen = Observation(name)
        write_parquet(frame.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root.rstrip('/')}/{name}")
        counts[name] = seen.get["rows"]
    return counts


def count_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Row counts by table as a DataFrame, one row for each table."""
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


def write_run(tables: dict[str, DataFrame], root: str, run_ts: str) -> None:
    """Every table as one dated partition; ``readers.current_run`` reads the newest."""
    for name, frame in tables.items():
        (
            describe_columns(frame)
            .withColumn("run_ts", F.lit(run_ts))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("run_ts")
            .parquet(f"{root.rstrip('/')}/{name}")
        )


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


_SOURCE_COLUMNS = [
    "source_url", "fetched_at", "schema_version", "last_updated", "repository_url", "project_name",
]


def _with_url_identity(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.select(
        V.url_part(F.col("source_url"), 4).alias("owner"),
        V.url_part(F.col("source_url"), 5).alias("repo"),
        *columns,
    )


def sbom_export(sboms: DataFrame) -> DataFrame:
    """Feed of the SBOM file: identity from the source URL, sorted."""
    columns = _SOURCE_COLUMNS + ["sbom_format", "sbom_file", "sbom_url", "sbom_comment"]
    # columns after the identity keep one large repository from being one sort task
    return _with_url_identity(sboms, columns).orderBy(
        "owner", "repo", "source_url", "sbom_format", "sbom_file", "sbom_url"
    )


def attestation_export(attestations: DataFrame) -> DataFrame:
    """Feed of the attestation file: identity from the source URL, sorted."""
    columns = _SOURCE_COLUMNS + [
        "attestation_source", "attestation_name", "attestation_location",
        "attestation_predicate_uri", "attestation_comment",
    ]
    return _with_url_identity(attestations, columns).orderBy(
        "owner", "repo", "attestation_source", "source_url", "attestation_name",
        "attestation_location",
    )


def wide_artifact_export(
    repositories: DataFrame, releases: DataFrame, assets: DataFrame
) -> DataFrame:
    """One row per artifact with its release and repository repeated.

    Repositories without releases and releases without artifacts keep one row.
    """
    repos = repositories.select(
        F.col("id").alias("repository_id"),
        "nameWithOwner",
        F.col("url").alias("repository_url"),
        "description",
    )
    rels = releases.select(
        F.col("id").alias("release_id"),
        "repository_id",
        F.col("name").alias("release_name"),
        "tagName",
        "createdAt",
    )
    files = assets.select(
        F.col("id").alias("artifact_id"),
        "release_id",
        F.col("name").alias("artifact_name"),
        F.col("downloadUrl").alias("artifact_url"),
    )
    unreleased = repos.join(rels.select("repository_id").distinct(), "repository_id", "left_anti")
    released = left_join_many(repos.join(rels, "repository_id"), files, "release_id")
    return released.unionByName(unreleased, allowMissingColumns=True)


def encode_nested(frame: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text, so that a flat file can hold them."""
    nested = ("array", "struct", "map")
    return frame.select(
        *[
            F.to_json(c).alias(c) if t.startswith(nested) else F.col(f"`{c}`")
            for c, t in frame.dtypes
        ]
    )


def append_responses(log: DataFrame, path: str) -> None:
    """Append response records as JSON lines."""
    log.write.mode("append").json(path)


def write_responses_by_repo(latest: DataFrame, path: str) -> None:
    """Responses only, one folder per repository.

    Making a folder takes longer than filling it, so repositories are dealt over all shuffle partitions by number, not by
    size; one with more than a partition's share of the rows is split over several. There are fewer of those than
    partitions, whatever the log. On a disk that the tasks see they make the folders themselves; in any other store it is
    Spark's writer, whose tasks move their own folders into place.
    """
    parts = int(latest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = latest.select("metadata.owner", "metadata.repo", "response")
    rows = rows.select(folders.key_value("owner").alias("owner"), folders.key_value("repo").alias("repo"), "response")
    share = max(1, rows.count() / parts)
    counts = rows.groupBy(F.col("owner").alias("_owner"), F.col("repo").alias("_repo")).agg(F.count("*").alias("_rows"))
    large = counts.filter(F.col("_rows") > share).withColumn("_pieces", F.ceil(F.col("_rows") / share))
    same = F.col("owner").eqNullSafe(F.col("_owner")) & F.col("repo").eqNullSafe(F.col("_repo"))
    piece = F.pmod(F.monotonically_increasing_id(), F.coalesce("_pieces", F.lit(1)))
    dealt = (
        rows.join(F.broadcast(large), same, "left")
        .select("owner", "repo", "response", piece.alias("_piece"))
        .repartition(parts, "owner", "repo", "_piece")
        .drop("_piece")
    )
    if folders.local_path(latest.sparkSession, path) is not None:
        lines = dealt.select("owner", "repo", F.to_json(F.struct("response")).alias("line"))
        folders.write_lines(lines, ["owner", "repo"], "line", path)
    else:
        dealt.write.mode("overwrite").options(**MANY_FILES).partitionBy("owner", "repo").json(path)


def responses_to_table(log: DataFrame) -> DataFrame:
    """Response log as a flat table: record metadata as columns, response nested."""
    return log.select(
        F.col("metadata.queryType").alias("query_type"),
        F.col("metadata.timestamp").alias("timestamp"),
        F.col("metadata.owner").alias("owner"),
        F.col("metadata.repo").alias("repo"),
        "response",
    )


def text_files(repositories: DataFrame, workflows: DataFrame, documents: DataFrame) -> DataFrame:
    """Workflow and document texts under flat, safe file names.

    ``documents`` has ``repository_id, path, content``.
    """
    texts = workflows.select(
        "repository_id",
        F.lit("workflows__").alias("prefix"),
        F.col("filename").alias("path"),
        "content",
    ).unionByName(
        documents.select("repository_id", F.lit("").alias("prefix"), "path", "content")
    )
    names = repositories.select(
        F.col("id").alias("repository_id"),
        V.owner_of(F.col("nameWithOwner")).alias("owner"),
        V.repo_of(F.col("nameWithOwner")).alias("repo"),
    )
    return (
        texts.filter(V.blank_to_null(F.col("content")).isNotNull())
        .join(names, "repository_id")
        .select(
            V.safe_part(F.col("owner")).alias("owner"),
            F.concat(
                V.safe_part(F.col("owner")),
                F.lit("__"),
                V.safe_part(F.col("repo")),
                F.lit("__"),
                F.col("prefix"),
                V.safe_path(F.col("path")),
            ).alias("safe_name"),
            "content",
        )
    )


def write_text_files(files: DataFrame, path: str) -> None:
    """Texts with their safe names, one folder per owner; a large owner's is written by several tasks."""
    (
        files.hint("rebalance", "owner")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("owner")
        .parquet(path)
    )


def write_response_table(log: DataFrame, path: str) -> None:
    """The response log as Parquet, one folder per query type."""
    write_parquet(responses_to_table(log), path, ["query_type"])


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count, column count and column types of every table."""
    parts = [
        frame.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(frame.columns)).alias("column_count"),
            F.lit(", ".join(f"{c} {t}" for c, t in frame.dtypes)).alias("columns"),
        )
        for name, frame in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_tables(spark: SparkSession, prefix: str = "agg_") -> list[str]:
    """Drop every catalogue table and view whose name starts with the prefix."""
    dropped = []
    for table in spark.catalog.listTables():
        if table.name.startswith(prefix):
            if table.isTemporary:
                spark.catalog.dropTempView(table.name)
            else:
                spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
            dropped.append(table.name)
    return sorted(dropped)


def run_sql_file(
    spark: SparkSession, path: str, tables: dict[str, DataFrame], args: dict | None = None
) -> DataFrame:
    """Run one saved SQL statement over the given tables; ``args`` fill its ``:name`` parameters, as values, not as text.

    A path with a scheme is read from that store, any other from the driver's disk.
    """
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    if "://" in path:
        statement = spark.read.text(path, wholetext=True).first()[0]
    else:
        with open(path, encoding="utf-8") as handle:
            statement = handle.read()
    return spark.sql(statement.rstrip().rstrip(";"), args=args or {})


def count_where(spark: SparkSession, pattern: str, condition: str) -> DataFrame:
    """Count rows over many run files; the condition reaches the file scan."""
    return spark.read.parquet(pattern).filter(condition).agg(F.count("*").alias("row_count"))
