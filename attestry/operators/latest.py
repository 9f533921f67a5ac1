"""Newest rows per key, as windows whose rank limit runs before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attestry.session import folder_names


def newest_per_key(
    frame: DataFrame, keys: list[str], order: list[Column], keep: int = 1
) -> DataFrame:
    """The first ``keep`` rows of each key in the given order.

    Spark turns ``row_number() <= n`` into a group limit on each input
    partition, so a key holding a third of all rows still sends only ``n`` rows
    per input partition over the network. ``order`` must end in a unique column
    for a repeatable result.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return (
        frame.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= keep)
        .drop("_rank")
    )


def _response_keys(prefer: list[str] | None) -> tuple[list[Column], list[Column]]:
    """What a response answers, and the order of those that answer the same, without ties."""
    kind = F.col("metadata.queryType")
    family, order = kind, []
    if prefer:
        family = F.when(kind.isin(prefer), F.lit(prefer[0])).otherwise(kind)
        order = [F.array_position(F.lit(prefer), kind).asc()]
    keys = [family.alias("_type"), F.col("metadata.owner").alias("_owner"), F.col("metadata.repo").alias("_repo")]
    return keys, [*order, F.col("metadata.timestamp").desc_nulls_last()]


def latest_responses(log: DataFrame, prefer: list[str] | None = None) -> DataFrame:
    """The newest response of each repository and query type.

    ``prefer`` lists query types that answer the same question, best first; a
    repository keeps its best one of those only.
    """
    keys, order = _response_keys(prefer)
    order.append(F.xxhash64("response").asc())
    return newest_per_key(log.select("*", *keys), ["_type", "_owner", "_repo"], order).drop(
        "_type", "_owner", "_repo"
    )


def latest_stored_responses(log: DataFrame, prefer: list[str] | None = None) -> DataFrame:
    """``latest_responses`` of a log that is read straight from stored Parquet.

    Rows are ranked as keys, times and their places in the files, which are known without reading a response; the
    responses of the places that win are then read by a semi join. With equal times the row stored last wins.
    """
    keys, order = _response_keys(prefer)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    ).alias("_place")
    ranked = newest_per_key(
        log.select("metadata", *keys, place), ["_type", "_owner", "_repo"], [*order, F.col("_place").desc()]
    )
    newest = ranked.select(F.col("_place.file").alias("_file"), F.col("_place.row").alias("_row"))
    placed = log.select("*", place)
    won = (placed["_place.file"] == newest["_file"]) & (placed["_place.row"] == newest["_row"])
    return placed.join(newest, won, "left_semi").drop("_place")


def response_for(log: DataFrame, owner: str, repo: str) -> DataFrame:
    """The newest response of one repository, whatever its query type."""
    chosen = log.filter((F.col("metadata.owner") == owner) & (F.col("metadata.repo") == repo))
    return (
        chosen.orderBy(F.col("metadata.timestamp").desc_nulls_last(), F.xxhash64("response"))
        .limit(1)
        .select("response")
    )


def upsert_documents(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Insight documents keyed by (repo_id, source_url); the newest wins.

    With equal times the arriving row wins over the stored one.
    """
    both = stored.withColumn("_new", F.lit(0)).unionByName(arrived.withColumn("_new", F.lit(1)))
    order = [
        F.col("fetched_at").desc_nulls_last(), F.col("_new").desc(), F.xxhash64("document").asc(),
    ]
    return newest_per_key(both, ["repo_id", "source_url"], order).drop("_new")


def upsert_in_place(arrived: DataFrame, path: str, parts: int = 64) -> None:
    """``upsert_documents`` into a stored table of ``parts`` folders by key.

    Only the folders that the arriving keys fall in are read, and only those are replaced, together, when the write is
    complete; the files of all others stay as they are. The first call makes the table. A row's folder follows from its
    key, so ``parts`` must stay the same.
    """
    spark = arrived.sparkSession
    arrived = arrived.withColumn(
        "part", F.pmod(F.xxhash64("repo_id", "source_url"), F.lit(parts)).cast("int")
    )
    # At most as many numbers as the table has folders.
    touched = [row[0] for row in arrived.select("part").distinct().collect()]
    merged = arrived
    if any(name.startswith("part=") for name in folder_names(spark, path)):
        known = spark.read.schema(arrived.schema).parquet(path).filter(F.col("part").isin(touched))
        merged = upsert_documents(known, arrived)
    else:
        merged = upsert_documents(arrived.limit(0), arrived)
    # The ranking has dealt the rows by key already, so that every task holds some of each folder and no folder is one
    # task's work; dealing them once more by folder would move every document twice.
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("part")
        .parquet(path)
    )


def newest_releases(releases: DataFrame, keep: int = 5) -> DataFrame:
    """The newest ``keep`` releases of each repository."""
    order = [F.col("createdAt").desc_nulls_last(), F.col("id").asc()]
    return newest_per_key(releases, ["repository_id"], order, keep)


def first_assets(assets: DataFrame, keep: int = 50) -> DataFrame:
    """Up to ``keep`` artifacts of each release, in id order."""
    return newest_per_key(assets, ["release_id"], [F.col("id").asc()], keep)


def last_project_records(projects: DataFrame, sequence: str) -> DataFrame:
    """One record per project name: the last in input sequence."""
    return newest_per_key(projects, ["project_name"], [F.col(sequence).desc()]).drop(sequence)
