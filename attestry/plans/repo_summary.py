"""Repository-level model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions import rules as R
from attestry.functions import values as V

# Repository flag -> artifact flag it is raised by.
ARTIFACT_FLAGS_OF_REPO = {
    "has_sbom_artifact": "is_sbom",
    "has_signature_artifact": "is_signature",
    "has_attestation_artifact": "is_attestation",
    "has_vex_document": "is_vex",
    "has_slsa_provenance": "is_slsa_provenance",
    "has_in_toto_attestation": "is_in_toto_link",
    "has_container_attestation": "is_container_attestation",
    "has_license_file": "is_license_file",
}
# Repository flag -> SBOM format it is raised by.
FORMAT_FLAGS = {
    "has_spdx_sbom": "spdx",
    "has_cyclonedx_sbom": "cyclonedx",
    "has_unknown_sbom_format": "unknown",
}


def _column(prefix: str, label: str) -> str:
    return prefix + label.replace("-", "_")


CATEGORY_FLAGS = {_column("uses_", c): c for c in R.SUMMARY_CATEGORIES}
TOOL_FLAGS = {_column("uses_", t): t for t in R.SUMMARY_TOOLS}


def _aggs(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def release_signals(patterns: DataFrame) -> DataFrame:
    """Artifact signals per release. Counts and flags only, so the partial
    aggregate shrinks even a release holding a third of all artifacts."""
    keys = [c for c in ("release_id", "repository_id") if c in patterns.columns]
    return patterns.groupBy(*keys).agg(
        *_aggs(
            {
                "total_assets": "count(*)",
                **{c: f"bool_or(sbom_format = '{f}')" for c, f in FORMAT_FLAGS.items()},
                **{c: f"bool_or({f})" for c, f in ARTIFACT_FLAGS_OF_REPO.items()},
                "sbom_artifact_count": "count_if(is_sbom)",
                "signature_artifact_count": "count_if(is_signature)",
            }
        )
    )


def artifact_stats(releases: DataFrame, patterns: DataFrame) -> DataFrame:
    """Release and artifact figures per repository.

    Artifacts are folded to releases before they meet the release table, and
    releases to one row each before the repository aggregate, so no step
    counts distinct values over artifact rows.
    """
    signals = release_signals(patterns)
    owned = "repository_id" in patterns.columns
    flags = {c: f"bool_or({c})" for c in [*FORMAT_FLAGS, *ARTIFACT_FLAGS_OF_REPO]}
    count_columns = ["total_assets", "sbom_artifact_count", "signature_artifact_count"]
    counts = {c: f"sum({c})" for c in count_columns}
    joined = releases.select(
        F.col("id").alias("release_id"), "repository_id", "tagName", "createdAt"
    ).join(signals, ["release_id", "repository_id"] if owned else "release_id", "left")
    # Artifacts already joined to releases are repeated by a release listed twice;
    # those that are not are counted once per listing here. Both count the same.
    once = {c: f"max({c})" for c in count_columns} if owned else counts
    per_release = joined.groupBy("repository_id", "release_id").agg(
        *_aggs(
            {
                **flags,
                **once,
                "tagName": "min(tagName)",
                "date_tag": "min_by(tagName, createdAt)",
                "createdAt": "min(createdAt)",
            }
        )
    )
    return per_release.groupBy("repository_id").agg(
        *_aggs(
            {
                "total_releases": "count(*)",
                **flags,
                **counts,
                "releases_with_sbom_count": "count_if(has_sbom_artifact)",
                "releases_with_signatures_count": "count_if(has_signature_artifact)",
                "first_release_with_sbom": "min(IF(has_sbom_artifact, tagName, NULL))",
                "first_sbom_date": "min(IF(has_sbom_artifact, createdAt, NULL))",
                "first_sbom_tag_by_date": (
                    "min_by(date_tag, IF(has_sbom_artifact, struct(createdAt, date_tag), NULL))"
                ),
            }
        )
    )


def workflow_stats(tools: DataFrame) -> DataFrame:
    """Tool figures per repository.

    Detections are folded to one row per workflow first; that replaces three
    filtered distinct counts by plain sums.
    """
    scanners = ", ".join(f"'{c}'" for c in R.SCANNER_CATEGORIES)
    per_workflow = tools.groupBy("repository_id", "workflow_id").agg(
        *_aggs(
            {
                **{c: f"bool_or(tool_category = '{v}')" for c, v in CATEGORY_FLAGS.items()},
                **{c: f"bool_or(tool_name = '{v}')" for c, v in TOOL_FLAGS.items()},
                "scans": f"bool_or(tool_category IN ({scanners}))",
            }
        )
    )
    return per_workflow.groupBy("repository_id").agg(
        *_aggs(
            {
                **{c: f"bool_or({c})" for c in [*CATEGORY_FLAGS, *TOOL_FLAGS]},
                "sbom_generator_count": "count_if(uses_sbom_generator)",
                "signer_count": "count_if(uses_signer)",
                "scanner_count": "count_if(scans)",
            }
        )
    )


def repo_summary(
    repositories: DataFrame,
    releases: DataFrame,
    patterns: DataFrame,
    workflows: DataFrame,
    tools: DataFrame,
) -> DataFrame:
    """One row per repository with all its signals.

    ``patterns`` needs ``release_id`` and the artifact signals only, so the
    output of ``classify_assets`` serves without the identity joins; likewise
    ``tools`` may come straight from ``detect_tools``.
    """
    spine = repositories.select(
        F.col("id").alias("repository_id"),
        V.owner_of(F.col("nameWithOwner")).alias("owner"),
        F.col("name").alias("repo"),
        "nameWithOwner",
        "description",
        "url",
    )
    flow_counts = workflows.groupBy("repository_id").agg(F.count("*").alias("total_workflows"))
    joined = (
        spine.join(artifact_stats(releases, patterns), "repository_id", "left")
        .join(workflow_stats(tools), "repository_id", "left")
        .join(flow_counts, "repository_id", "left")
    )
    number = lambda *names: [f"coalesce({c}, 0L) AS {c}" for c in names]
    flag = lambda *names: [f"coalesce({c}, false) AS {c}" for c in names]
    return joined.selectExpr(
        *spine.columns,
        *number("total_releases", "total_assets", "total_workflows"),
        *flag(*FORMAT_FLAGS, "has_sbom_artifact"),
        *number("sbom_artifact_count"),
        *flag(*list(ARTIFACT_FLAGS_OF_REPO)[1:]),
        *number("signature_artifact_count"),
        *flag(*CATEGORY_FLAGS, *TOOL_FLAGS),
        *number("sbom_generator_count", "signer_count", "scanner_count"),
        *number("releases_with_sbom_count", "releases_with_signatures_count"),
        "coalesce(try_divide(double(releases_with_sbom_count), double(total_releases)), 0D) "
        "AS sbom_adoption_rate",
        "first_release_with_sbom",
        "first_sbom_date",
        "first_sbom_tag_by_date",
    )


# The ten signals of the maturity score, one point each.
MATURITY_SIGNALS: dict[str, float] = {
    "has_sbom_artifact": 1.0,
    "has_signature_artifact": 1.0,
    "has_attestation_artifact": 1.0,
    "has_slsa_provenance": 1.0,
    "has_vex_document": 1.0,
    "uses_sbom_generator": 1.0,
    "uses_signer": 1.0,
    "uses_vulnerability_scanner": 1.0,
    "uses_dependency_scanner": 1.0,
    "uses_code_scanner": 1.0,
}


def maturity_score(weights: dict[str, float] = MATURITY_SIGNALS) -> Column:
    """Weighted count of a repository's signals, 0 to 10 by default."""
    return F.expr(" + ".join(f"IF({c}, {float(w)}D, 0D)" for c, w in weights.items()))


def with_maturity_score(
    summary: DataFrame, weights: dict[str, float] = MATURITY_SIGNALS
) -> DataFrame:
    return summary.withColumn("security_maturity_score", maturity_score(weights))
