"""Attestation and SBOM records out of insight documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry import schemas

COMMON = [
    "repo_id", "source_url", "fetched_at", "schema_version", "last_updated", "repository_url",
    "project_name",
]


def _parsed(documents: DataFrame) -> DataFrame:
    """Each document parsed once; header fields as columns, the rest in ``d``."""
    return documents.select(
        "repo_id",
        "source_url",
        "fetched_at",
        F.from_json("document", schemas.INSIGHTS).alias("d"),
    ).select(
        "repo_id",
        "source_url",
        "fetched_at",
        F.col("d.header.schema-version").alias("schema_version"),
        F.col("d.header.last-updated").try_cast("date").alias("last_updated"),
        F.col("d.repository.url").alias("repository_url"),
        F.col("d.project.name").alias("project_name"),
        "d",
    )


def _labelled(source: str, items: Column) -> Column:
    """(source, JSON text) pairs; a list that is absent or no list gives none."""
    return F.transform(
        F.coalesce(items, F.array().cast("array<string>")),
        lambda i: F.struct(F.lit(source).alias("source"), i.alias("item")),
    )


def attestations(documents: DataFrame) -> DataFrame:
    """All attestation records, from the six places a document can hold them."""
    kinds = ["adhoc", "ci", "release"]

    def from_tool(tool: Column) -> Column:
        results = F.from_json(tool, schemas.INSIGHT_TOOL)["results"]
        return F.transform(
            F.array(results),
            lambda r: F.array(
                *[F.struct(F.lit(f"tool_{k}").alias("source"), r[k].alias("item")) for k in kinds]
            ),
        )[0]

    tools = F.coalesce("d.repository.security.tools", F.array().cast("array<string>"))
    places = F.concat(
        _labelled("release", F.col("d.repository.release.attestations")),
        F.flatten(F.transform(tools, from_tool)),
        _labelled("top_level", F.col("d.attestations")),
        _labelled("security_artifacts", F.col("d.security-artifacts.attestations")),
    )
    record = F.from_json("item", schemas.ATTESTATION)
    return (
        _parsed(documents)
        .select(*COMMON, F.inline(places))
        .filter(F.col("item").isNotNull())
        .select(*COMMON, F.col("source").alias("attestation_source"), record.alias("a"))
        .select(
            *COMMON,
            "attestation_source",
            F.col("a.name").alias("attestation_name"),
            F.col("a.location").alias("attestation_location"),
            F.col("a.predicate-uri").alias("attestation_predicate_uri"),
            F.col("a.comment").alias("attestation_comment"),
        )
    )


def sboms(documents: DataFrame, with_release_path: bool = False) -> DataFrame:
    """All SBOM records of the documents.

    ``with_release_path`` also reads the list under ``repository.release`` and
    adds ``sbom_source`` to tell the two apart.
    """
    lists = _labelled("top_level", F.col("d.dependencies.sbom"))
    if with_release_path:
        lists = F.concat(lists, _labelled("release", F.col("d.repository.release.dependencies.sbom")))
    record = F.from_json("item", schemas.SBOM_ENTRY)
    out = (
        _parsed(documents)
        .select(*COMMON, F.inline(lists))
        .filter(F.col("item").isNotNull())
        .select(*COMMON, F.col("source").alias("sbom_source"), record.alias("s"))
        .select(
            *COMMON,
            F.col("s.sbom-format").alias("sbom_format"),
            F.col("s.sbom-url").alias("sbom_url"),
            F.col("s.sbom-file").alias("sbom_file"),
            F.col("s.comment").alias("sbom_comment"),
            "sbom_source",
        )
    )
    return out if with_release_path else out.drop("sbom_source")


def record_status(records: DataFrame, noun: str) -> DataFrame:
    """One row: how many records from how many repositories, as a sentence."""
    return records.agg(
        F.count("*").alias("record_count"), F.count_distinct("repo_id").alias("repo_count")
    ).select(
        "record_count",
        "repo_count",
        F.when(
            F.col("record_count") > 0,
            F.concat(
                F.col("record_count"), F.lit(f" {noun}(s) from "), F.col("repo_count"),
                F.lit(" repo(s)"),
            ),
        )
        .otherwise(F.lit(f"no {noun}s found"))
        .alias("status"),
    )
