"""Summary tables of a run and the status rows of each model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions import rules as R
from attestry.functions import values as V


def executive_summary(summary: DataFrame) -> DataFrame:
    """One row of figures over all repositories."""
    flag = lambda c: V.sum_flag(F.col(c))
    share = lambda c: V.percent(flag(c), F.count("*"))
    return summary.agg(
        F.count("*").alias("total_repos"),
        flag("has_sbom_artifact").alias("repos_with_sbom"),
        flag("has_signature_artifact").alias("repos_with_signatures"),
        flag("has_attestation_artifact").alias("repos_with_attestations"),
        share("has_sbom_artifact").alias("sbom_percentage"),
        share("has_signature_artifact").alias("signature_percentage"),
        share("has_attestation_artifact").alias("attestation_percentage"),
        F.sum("total_releases").alias("total_releases"),
        F.sum("total_assets").alias("total_assets"),
        F.sum("total_workflows").alias("total_workflows"),
        flag("uses_sbom_generator").alias("repos_using_sbom_generators"),
        flag("uses_signer").alias("repos_using_signers"),
        flag("uses_vulnerability_scanner").alias("repos_using_vuln_scanners"),
        flag("uses_dependency_scanner").alias("repos_using_dep_scanners"),
        flag("uses_code_scanner").alias("repos_using_code_scanners"),
        flag("uses_container_scanner").alias("repos_using_container_scanners"),
    )


def tool_category_summary(tools: DataFrame) -> DataFrame:
    """Distinct repositories and workflows per tool and category."""
    return (
        tools.groupBy("tool_category", "tool_name")
        .agg(
            F.count_distinct("repository_id").alias("repo_count"),
            F.count_distinct("workflow_id").alias("workflow_count"),
        )
        .orderBy(F.desc("repo_count"), "tool_name", "tool_category")
    )


def tool_summary(tools: DataFrame, repositories: DataFrame) -> DataFrame:
    """Tool adoption with its share of all repositories.

    ``repositories`` may be the repository summary or the base table.
    """
    total = repositories.agg(F.count("*")).scalar()
    return tool_category_summary(tools).select(
        "tool_name",
        "tool_category",
        "repo_count",
        "workflow_count",
        V.percent(F.col("repo_count"), total).alias("adoption_percentage"),
    )


def _by_signals() -> list[Column]:
    signals = F.col("has_sbom_artifact").cast("int") + F.col("has_signature_artifact").cast("int")
    return [signals.desc(), F.col("nameWithOwner").asc()]


def repo_summary_sorted(summary: DataFrame) -> DataFrame:
    """Repositories for a report, those with most signals first."""
    return summary.orderBy(*_by_signals()).select(
        "nameWithOwner", "total_releases", "has_sbom_artifact", "has_signature_artifact",
        "has_attestation_artifact", "uses_sbom_generator", "uses_signer", "uses_code_scanner",
    )


def repo_detail(summary: DataFrame) -> DataFrame:
    """Repositories with their counts, those with most signals first."""
    return summary.orderBy(*_by_signals()).select(
        "nameWithOwner", "total_releases", "total_assets", "sbom_artifact_count",
        "signature_artifact_count", "uses_sbom_generator", "uses_signer",
        "uses_vulnerability_scanner", "uses_code_scanner",
    )


def sbom_summary(summary: DataFrame) -> DataFrame:
    """One row on formats and adoption; partial adoption includes full adoption."""
    flag = V.sum_flag
    return summary.filter("has_sbom_artifact").agg(
        F.count("*").alias("total_repos"),
        flag(F.col("has_spdx_sbom")).alias("spdx_count"),
        flag(F.col("has_cyclonedx_sbom")).alias("cyclonedx_count"),
        flag(F.col("has_unknown_sbom_format")).alias("unknown_count"),
        flag(F.col("sbom_adoption_rate") > 0).alias("partial_adoption"),
        flag(F.col("sbom_adoption_rate") == 1.0).alias("full_adoption"),
    )


# Count column -> artifact flag.
ADVANCED = {
    "vex_count": "is_vex",
    "slsa_count": "is_slsa_provenance",
    "intoto_link_count": "is_in_toto_link",
    "intoto_layout_count": "is_in_toto_layout",
    "sigstore_bundle_count": "is_sigstore_bundle",
    "swid_tag_count": "is_swid_tag",
    "container_attestation_count": "is_container_attestation",
    "license_file_count": "is_license_file",
    "generic_attestation_count": "is_attestation",
}


def advanced_artifacts(patterns: DataFrame) -> DataFrame:
    """One row of counts over artifacts beyond SBOMs and signatures.

    Counts are folded per repository first: the distinct count of repositories
    is then a plain count, and a repository holding a third of the artifacts is
    one partial row per input partition. Repositories without such artifacts
    leave after that; a filter on the single artifact would be moved below the
    classification and repeat its text work.
    """
    per_repo = patterns.groupBy("repository_id").agg(
        *[F.expr(f"count_if({f})").alias(c) for c, f in ADVANCED.items()]
    )
    some = " + ".join(ADVANCED)
    return per_repo.filter(f"{some} > 0").agg(
        F.count("repository_id").alias("repos_with_advanced_artifacts"),
        *[F.sum(c).alias(c) for c in ADVANCED],
    )


def category_stats(tools: DataFrame) -> DataFrame:
    """Repositories, tools and detections per category, with a readable label."""
    return (
        tools.groupBy("tool_category")
        .agg(
            F.count_distinct("repository_id").alias("repo_count"),
            F.count_distinct("tool_name").alias("unique_tools"),
            F.count("*").alias("total_detections"),
        )
        .withColumn("label", V.category_label(F.col("tool_category")))
        .orderBy(F.desc("repo_count"), "tool_category")
    )


def repos_per_tool(tools: DataFrame) -> DataFrame:
    return (
        tools.groupBy("tool_name")
        .agg(F.count_distinct("repository_id").alias("repo_count"))
        .orderBy(F.desc("repo_count"), "tool_name")
    )


def artifact_totals(summary: DataFrame) -> DataFrame:
    """One row: totals and whole percentages for the console."""
    flag = lambda c: V.sum_flag(F.col(c))
    share = lambda c: V.percent(flag(c), F.count("*"), 0)
    return summary.agg(
        F.count("*").alias("total_repos"),
        flag("has_sbom_artifact").alias("repos_with_sbom"),
        flag("has_signature_artifact").alias("repos_with_signatures"),
        flag("has_attestation_artifact").alias("repos_with_attestations"),
        share("has_sbom_artifact").alias("sbom_pct"),
        share("has_signature_artifact").alias("signature_pct"),
        share("has_attestation_artifact").alias("attestation_pct"),
    )


# Status rows of the models ---------------------------------------------------

# Status count -> artifact flag.
STATUS_FLAGS = {
    "sbom_count": "is_sbom",
    "signature_count": "is_signature",
    "attestation_count": "is_attestation",
    "vex_count": "is_vex",
    "slsa_count": "is_slsa_provenance",
    "intoto_link_count": "is_in_toto_link",
    "intoto_layout_count": "is_in_toto_layout",
    "sigstore_bundle_count": "is_sigstore_bundle",
    "swid_tag_count": "is_swid_tag",
    "container_attestation_count": "is_container_attestation",
    "license_file_count": "is_license_file",
}


def _status(table: str) -> Column:
    return F.lit(f"✓ Created {table}").alias("status")


def artifact_status(patterns: DataFrame) -> DataFrame:
    return patterns.agg(
        F.count("*").alias("total_assets"),
        *[V.sum_flag(F.col(f)).alias(c) for c, f in STATUS_FLAGS.items()],
    ).select(_status("agg_artifact_patterns"), "*")


def tools_status(tools: DataFrame) -> DataFrame:
    return tools.agg(
        F.count("*").alias("total_detections"),
        F.count_distinct("workflow_id").alias("unique_workflows"),
        F.count_distinct("repository_id").alias("unique_repositories"),
    ).select(_status("agg_workflow_tools"), "*")


def repo_summary_status(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count("*").alias("total_repositories"),
        V.sum_flag(F.col("has_sbom_artifact")).alias("repos_with_sbom"),
        V.sum_flag(F.col("uses_cosign")).alias("repos_using_cosign"),
        V.sum_flag(F.col("uses_syft")).alias("repos_using_syft"),
    ).select(_status("agg_repo_summary"), "*")


def summary_status(
    summary: DataFrame, tools: DataFrame, patterns: DataFrame
) -> DataFrame:
    """One (status, figure, value) row per summary table and figure.

    The repository summary and the tool counts are each aggregated once.
    """
    repos = summary.agg(
        F.count("*").alias("total"),
        F.coalesce(V.sum_flag(F.col("has_sbom_artifact")), F.lit(0)).alias("sbom"),
        F.coalesce(V.sum_flag(F.col("has_signature_artifact")), F.lit(0)).alias("signed"),
    ).selectExpr(
        "stack(6,"
        "'agg_executive_summary','total_repos',total,"
        "'agg_executive_summary','repos_with_sbom',sbom,"
        "'agg_executive_summary','repos_with_signatures',signed,"
        "'agg_repo_summary_sorted','total_repos',total,"
        "'agg_sbom_summary','repos_with_sboms',sbom,"
        "'agg_repo_detail','total_repos',total) AS (table_name, figure, value)"
    )
    per_tool = (
        tool_category_summary(tools)
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("repo_count"), F.lit(0)).alias("detections"),
        )
        .selectExpr(
            "stack(3,'agg_tool_summary','unique_tools',n,"
            "'agg_tool_summary','total_tool_detections',detections,"
            "'agg_tool_category_summary','tool_detections',n) AS (table_name, figure, value)"
        )
    )
    advanced = advanced_artifacts(patterns).select(
        F.lit("agg_advanced_artifacts").alias("table_name"),
        F.lit("repos").alias("figure"),
        F.coalesce("repos_with_advanced_artifacts", F.lit(0)).alias("value"),
    )
    return repos.unionByName(per_tool).unionByName(advanced)


def _or_none(table: DataFrame, found: DataFrame, name: str, none: str) -> DataFrame:
    """The status rows found, and one that says so where the table has no row at all."""
    figures = [c for c in found.columns if c != "status"]
    nothing = table.sparkSession.range(1).select(
        F.lit(f"✓ Created {name} ({none})").alias("status"), *[F.lit(0).cast("long").alias(c) for c in figures]
    )
    return found.unionByName(nothing.filter(~table.select(F.lit(1)).exists()))


def sbom_summary_status(table: DataFrame) -> DataFrame:
    """Status of ``agg_sbom_summary``: repositories with SBOMs, or the row for an empty table."""
    name = "agg_sbom_summary"
    found = table.select(
        _status(name), F.coalesce("total_repos", F.lit(0)).cast("long").alias("repos_with_sboms")
    )
    return _or_none(table, found, name, "no SBOMs")


def advanced_artifacts_status(table: DataFrame) -> DataFrame:
    """Status of ``agg_advanced_artifacts``: repositories that have some, or the row for an empty table."""
    name = "agg_advanced_artifacts"
    found = table.select(
        _status(name), F.coalesce("repos_with_advanced_artifacts", F.lit(0)).cast("long").alias("repos")
    )
    return _or_none(table, found, name, "none detected")


def project_status(projects: DataFrame) -> DataFrame:
    level = lambda m: V.count_if(F.col("maturity") == m)
    rate = F.round(F.avg("sbom_adoption_rate") * 100, 1)
    return projects.agg(
        F.count("*").alias("total_projects"),
        level("graduated").alias("graduated_projects"),
        level("incubating").alias("incubating_projects"),
        level("sandbox").alias("sandbox_projects"),
        F.sum("repos_with_sbom").alias("total_repos_with_sbom"),
        F.concat(rate.cast("string"), F.lit("%")).alias("avg_sbom_adoption_rate"),
    ).select(_status("agg_cncf_project_summary"), "*")


# Small groupings --------------------------------------------------------------


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULLs are not counted."""
    return (
        frame.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), column)
    )


def tool_combinations(summary: DataFrame, minimum: int = 2) -> DataFrame:
    """How often three tools occur together, for combinations seen repeatedly."""
    return (
        summary.groupBy("uses_syft", "uses_cosign", "uses_trivy")
        .agg(F.count("*").alias("repo_count"))
        .filter(F.col("repo_count") >= minimum)
        .orderBy(F.desc("repo_count"), "uses_syft", "uses_cosign", "uses_trivy")
    )


def repos_using_all(tools: DataFrame, wanted: list[str]) -> DataFrame:
    """Repositories in which every one of the given tools was found."""
    return (
        tools.filter(F.col("tool_name").isin(wanted))
        .groupBy("nameWithOwner")
        .agg(F.count_distinct("tool_name").alias("_tools"))
        .filter(F.col("_tools") == len(set(wanted)))
        .select("nameWithOwner")
    )


def tools_by_category(tools: DataFrame) -> DataFrame:
    """Report feed: each category with its tools as a sorted list.

    The list holds one entry per tool of the rule catalogue, so it is as long as
    the catalogue however many detections there are.
    """
    entry = F.struct(
        (-F.col("repo_count")).alias("_order"),
        F.col("tool_name").alias("tool"),
        F.col("repo_count").alias("repos"),
        F.col("workflow_count").alias("workflows"),
    )
    listed = tool_category_summary(tools).groupBy("tool_category").agg(
        F.sort_array(F.collect_list(entry)).alias("tools")
    )
    text = F.transform(
        "tools",
        lambda t: F.concat(
            t["tool"], F.lit(": "), t["repos"], F.lit(" repositories, "), t["workflows"],
            F.lit(" workflows"),
        ),
    )
    return listed.select(
        V.category_label(F.col("tool_category")).alias("category"),
        F.array_join(text, "; ").alias("tools"),
    )
