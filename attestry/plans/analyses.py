"""Saved analyses over the project and repository summaries.

Every list with a limit is ordered down to a unique column, so it is the same
on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions import values as V
from attestry.operators.joins import left_join_many

MARK = "✓"


def _level_order() -> Column:
    level = F.col("maturity")
    return (
        F.when(level == "graduated", 1)
        .when(level == "incubating", 2)
        .when(level == "sandbox", 3)
        .otherwise(4)
    )


def _ratio(part: str, whole: str) -> Column:
    return F.concat(F.col(part), F.lit("/"), F.col(whole))


def _pct(rate: Column) -> Column:
    return F.round(rate * 100, 1)


def by_maturity(projects: DataFrame) -> DataFrame:
    """Security practice per maturity level."""
    positive = lambda c: V.count_if(F.col(c) > 0)
    return (
        projects.groupBy("maturity")
        .agg(
            F.count("*").alias("project_count"),
            positive("repos_with_sbom").alias("projects_with_sbom"),
            _pct(F.avg("sbom_adoption_rate")).alias("avg_sbom_adoption_pct"),
            positive("repos_with_signatures").alias("projects_with_signing"),
            positive("repos_with_slsa_provenance").alias("projects_with_slsa"),
            positive("repos_using_codeql").alias("projects_using_codeql"),
            V.count_if(F.col("has_security_audits")).alias("projects_with_audits"),
            F.round(F.avg("security_maturity_score"), 2).alias("avg_security_score"),
        )
        .orderBy(_level_order(), "maturity")
    )


def leaders(projects: DataFrame, minimum: float = 5.0, limit: int = 20) -> DataFrame:
    """Projects with the highest maturity score."""
    return (
        projects.filter(F.col("security_maturity_score") >= minimum)
        .orderBy(F.desc("security_maturity_score"), "maturity", "display_name", "project_name")
        .limit(limit)
        .select(
            "display_name",
            "maturity",
            "category",
            "security_maturity_score",
            _ratio("repos_with_sbom", "total_repos").alias("sbom_repos"),
            _ratio("repos_with_signatures", "total_repos").alias("signing_repos"),
            F.when(F.col("has_security_audits"), MARK).otherwise("").alias("audited"),
            F.when(F.col("url_for_bestpractices").isNotNull(), MARK)
            .otherwise("")
            .alias("openssf_badge"),
            "homepage_url",
        )
    )


def _stacked(rows: list[list[str]], names: list[str]) -> str:
    cells = ", ".join(cell for row in rows for cell in row)
    return f"stack({len(rows)}, {cells}) AS ({', '.join(names)})"


def format_adoption(projects: DataFrame) -> DataFrame:
    """Projects and repositories per SBOM format, from one aggregate."""
    formats = [("SPDX", "repos_with_spdx"), ("CycloneDX", "repos_with_cyclonedx")]
    totals = projects.agg(
        F.count("*").alias("n"),
        *[V.count_if(F.col(c) > 0).alias(f"p_{c}") for _, c in formats],
        *[F.sum(c).alias(f"r_{c}") for _, c in formats],
    )
    rows = [[f"'{label}'", f"p_{c}", f"r_{c}", "n"] for label, c in formats]
    return (
        totals.selectExpr(
            _stacked(rows, ["sbom_format", "projects_using", "total_repos_using", "n"])
        )
        .select(
            "sbom_format",
            "projects_using",
            "total_repos_using",
            V.percent(F.col("projects_using"), F.col("n")).alias("adoption_pct"),
        )
        .orderBy(F.desc("adoption_pct"), "sbom_format")
    )


# Shown name, shown category, project count column.
TOOL_POPULARITY = [
    ("Syft", "SBOM Generator", "repos_using_syft"),
    ("Trivy", "Vulnerability Scanner", "repos_using_trivy"),
    ("Cosign", "Signing Tool", "repos_using_cosign"),
    ("CodeQL", "Code Scanner", "repos_using_codeql"),
    ("SLSA Generator", "Provenance", "repos_using_slsa_generator"),
    ("Grype", "Vulnerability Scanner", "repos_using_grype"),
    ("CDXGen", "SBOM Generator", "repos_using_cdxgen"),
    ("Snyk", "Vulnerability Scanner", "repos_using_snyk"),
    ("Dependabot", "Dependency Updater", "repos_using_dependabot"),
    ("Renovate", "Dependency Updater", "repos_using_renovate"),
    ("GoReleaser", "Release Automation", "repos_using_goreleaser"),
]


def tool_popularity(projects: DataFrame) -> DataFrame:
    """Projects and repositories per tool, from one aggregate."""
    totals = projects.agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(f"r_{c}") for _, _, c in TOOL_POPULARITY],
        *[V.count_if(F.col(c) > 0).alias(f"p_{c}") for _, _, c in TOOL_POPULARITY],
    )
    rows = [
        [f"'{name}'", f"'{category}'", f"p_{c}", f"r_{c}", "n"]
        for name, category, c in TOOL_POPULARITY
    ]
    names = ["tool_name", "category", "projects_using", "repos_using", "n"]
    return (
        totals.selectExpr(_stacked(rows, names))
        .filter("repos_using > 0")
        .select(
            *names[:-1],
            V.percent(F.col("projects_using"), F.col("n")).alias("project_adoption_pct"),
        )
        .orderBy(F.desc("projects_using"), "tool_name")
    )


def audit_correlation(projects: DataFrame) -> DataFrame:
    """Practice of audited projects against the rest."""
    share = lambda c: _pct(F.avg(F.when(F.col(c) > 0, 1.0).otherwise(0.0)))
    return (
        projects.groupBy("has_security_audits")
        .agg(
            F.count("*").alias("project_count"),
            _pct(F.avg("sbom_adoption_rate")).alias("avg_sbom_adoption_pct"),
            share("repos_with_signatures").alias("pct_with_signing"),
            share("repos_with_slsa_provenance").alias("pct_with_slsa"),
            F.round(F.avg("security_maturity_score"), 2).alias("avg_security_score"),
        )
        .orderBy(F.desc("has_security_audits"))
        .select(
            F.when(F.col("has_security_audits"), "With Security Audits")
            .otherwise("No Security Audits")
            .alias("audit_status"),
            "project_count",
            "avg_sbom_adoption_pct",
            "pct_with_signing",
            "pct_with_slsa",
            "avg_security_score",
        )
    )


def by_category(projects: DataFrame, minimum: int = 3, limit: int = 15) -> DataFrame:
    """Practice per category, for categories of some size."""
    positive = lambda c: V.count_if(F.col(c) > 0)
    return (
        projects.groupBy("category")
        .agg(
            F.count("*").alias("project_count"),
            _pct(F.avg("sbom_adoption_rate")).alias("avg_sbom_adoption_pct"),
            positive("repos_with_sbom").alias("projects_with_sbom"),
            positive("repos_using_cosign").alias("projects_using_cosign"),
            positive("repos_using_trivy").alias("projects_using_trivy"),
            F.round(F.avg("security_maturity_score"), 2).alias("avg_security_score"),
        )
        .filter(F.col("project_count") >= minimum)
        .orderBy(F.col("avg_security_score").desc_nulls_last(), F.desc("project_count"), "category")
        .limit(limit)
    )


def missing_practices(projects: DataFrame, below: float = 4.0, limit: int = 25) -> DataFrame:
    """Mature projects with a low score, and what they lack."""
    lacks = lambda c, label: F.when(c == 0, f"❌ {label}").otherwise(MARK)
    updates = F.col("repos_using_dependabot") + F.col("repos_using_renovate")
    return (
        projects.filter(F.col("maturity").isin("graduated", "incubating"))
        .filter(F.col("security_maturity_score") < below)
        .orderBy(
            F.when(F.col("maturity") == "graduated", 1).otherwise(2),
            "security_maturity_score",
            "display_name",
            "project_name",
        )
        .limit(limit)
        .select(
            "display_name",
            "maturity",
            "category",
            "total_repos",
            "security_maturity_score",
            lacks(F.col("repos_with_sbom"), "No SBOM").alias("sbom_status"),
            lacks(F.col("repos_with_signatures"), "No Signing").alias("signing_status"),
            lacks(F.col("repos_using_vuln_scanner"), "No Vuln Scanning").alias("scanning_status"),
            lacks(updates, "No Dep Mgmt").alias("dep_mgmt_status"),
            "homepage_url",
        )
    )


def discovery_urls(projects: DataFrame) -> DataFrame:
    """Projects with an address where packages or images can be looked at."""
    return (
        projects.filter("package_manager_url IS NOT NULL OR docker_url IS NOT NULL")
        .orderBy("maturity", "display_name")
        .select(
            "display_name",
            "maturity",
            _ratio("repos_with_sbom", "total_repos").alias("sbom_repos"),
            "package_manager_url",
            "docker_url",
            "homepage_url",
        )
    )


def adoption_over_time(projects: DataFrame, limit: int = 30) -> DataFrame:
    """When projects released their first SBOM, latest first."""
    return (
        projects.filter("earliest_sbom_date IS NOT NULL")
        .orderBy(F.desc("earliest_sbom_date"), "project_name")
        .limit(limit)
        .select(
            "display_name",
            "maturity",
            "earliest_release_with_sbom",
            "earliest_sbom_date",
            F.year(F.to_date("earliest_sbom_date")).alias("sbom_adoption_year"),
            _ratio("repos_with_sbom", "total_repos").alias("current_sbom_coverage"),
        )
    )


def multi_repo_projects(projects: DataFrame, limit: int = 25) -> DataFrame:
    """Projects spread over several repositories, the largest first."""
    return (
        projects.filter("total_repos > 1")
        .orderBy(
            F.desc("total_repos"),
            F.col("security_maturity_score").desc_nulls_last(),
            "project_name",
        )
        .limit(limit)
        .select(
            "display_name",
            "maturity",
            "total_repos",
            "primary_repos",
            "repos_with_sbom",
            _pct(F.col("sbom_adoption_rate")).alias("sbom_adoption_pct"),
            F.col("repos_using_cosign").alias("signing_repos"),
            "security_maturity_score",
            "repo_url",
        )
    )


def overview(summary: DataFrame) -> DataFrame:
    """Six headline figures as (metric, value) rows, from one aggregate."""
    figures = [
        ("Repositories with SBOMs", "has_sbom_artifact"),
        ("Repositories with Signatures", "has_signature_artifact"),
        ("Repositories using Cosign", "uses_cosign"),
        ("Repositories using Syft", "uses_syft"),
    ]
    score = F.round(F.avg("security_maturity_score"), 2)
    totals = summary.agg(
        F.count("*").cast("string").alias("n"),
        *[V.count_if(F.col(c)).cast("string").alias(c) for _, c in figures],
        F.concat(score.cast("string"), F.lit("/10")).alias("score"),
    )
    rows = [["'Total Repositories'", "n"]]
    rows += [[f"'{label}'", c] for label, c in figures]
    rows += [["'Average Security Maturity Score'", "score"]]
    return totals.selectExpr(_stacked(rows, ["metric", "value"]))


# Shown name, repository flag.
TOP_TOOLS = [
    ("Syft", "uses_syft"),
    ("Trivy", "uses_trivy"),
    ("Cosign", "uses_cosign"),
    ("CodeQL", "uses_codeql"),
    ("Snyk", "uses_snyk"),
    ("Dependabot", "uses_dependabot"),
    ("GoReleaser", "uses_goreleaser"),
    ("Grype", "uses_grype"),
]


def top_tools(summary: DataFrame) -> DataFrame:
    """Repositories per tool with their share, from one aggregate."""
    totals = summary.agg(
        F.count("*").alias("n"), *[V.sum_flag(F.col(c)).alias(c) for _, c in TOP_TOOLS]
    )
    rows = [[f"'{label}'", c, "n"] for label, c in TOP_TOOLS]
    return (
        totals.selectExpr(_stacked(rows, ["tool", "repo_count", "n"]))
        .filter("repo_count > 0")
        .select(
            "tool", "repo_count", V.percent(F.col("repo_count"), F.col("n")).alias("percentage")
        )
        .orderBy(F.desc("repo_count"), "tool")
    )


def known_sboms(patterns: DataFrame) -> DataFrame:
    """All released SBOM files."""
    return (
        patterns.filter("is_sbom")
        .orderBy("nameWithOwner", "asset_name", "asset_id")
        .select("nameWithOwner", "asset_name", "sbom_format", "download_url")
    )


def generator_gap(summary: DataFrame) -> DataFrame:
    """One row: generator use against released SBOMs."""
    flag = lambda c: V.sum_flag(F.col(c))
    totals = summary.agg(
        F.count("repository_id").alias("total_repos"),
        flag("uses_syft").alias("repos_using_syft"),
        flag("uses_trivy").alias("repos_using_trivy"),
        flag("uses_cdxgen").alias("repos_using_cdxgen"),
        flag("has_sbom_artifact").alias("repos_with_sbom_artifacts"),
        flag("uses_sbom_generator").alias("repos_using_sbom_generators"),
    )
    gap = F.col("repos_using_sbom_generators") - F.col("repos_with_sbom_artifacts")
    return totals.withColumn("gap", gap)


def maturity_correlation(projects: DataFrame) -> DataFrame:
    """SBOM adoption and three tools per known maturity level."""
    return (
        projects.filter("maturity IS NOT NULL")
        .groupBy("maturity")
        .agg(
            F.count("*").alias("project_count"),
            F.sum("repos_with_sbom").alias("projects_with_sbom"),
            F.avg("sbom_adoption_rate").alias("avg_adoption_rate"),
            F.sum("repos_using_syft").alias("projects_using_syft"),
            F.sum("repos_using_trivy").alias("projects_using_trivy"),
            F.sum("repos_using_cosign").alias("projects_using_cosign"),
        )
        .orderBy(_level_order(), "maturity")
    )


def melt_tool_usage(correlation: DataFrame) -> DataFrame:
    """Tool columns of the correlation as rows."""
    tools = ["projects_using_syft", "projects_using_trivy", "projects_using_cosign"]
    return correlation.unpivot(["maturity"], tools, "tool", "count")


# Summary columns of the exploration table.
EXPLORATION = [
    "total_releases", "total_assets", "total_workflows", "has_sbom_artifact", "sbom_artifact_count",
    "uses_syft", "uses_trivy", "uses_cdxgen", "uses_cosign", "uses_sigstore", "uses_codeql",
    "uses_sbom_generator", "uses_signer", "uses_vulnerability_scanner",
]


def exploration_table(
    summary: DataFrame, project_repos: DataFrame, projects: DataFrame
) -> DataFrame:
    """Repositories with signals and the traits of the projects they belong to."""
    bridge = project_repos.select(
        F.concat(F.col("owner"), F.lit("/"), F.col("name")).alias("nameWithOwner"), "project_name"
    )
    traits = projects.select("project_name", "maturity", "category", "subcategory")
    named = bridge.join(traits, "project_name", "left")
    spine = summary.select("nameWithOwner", "description", *EXPLORATION)
    return left_join_many(spine, named, "nameWithOwner").drop("project_name")


def signers_without_sbom(summary: DataFrame) -> DataFrame:
    return summary.filter("uses_cosign AND NOT has_sbom_artifact").select("nameWithOwner")


def format_distribution(summary: DataFrame) -> DataFrame:
    """One row: repositories per SBOM format."""
    return summary.agg(
        V.sum_flag(F.col("has_spdx_sbom")).alias("spdx_count"),
        V.sum_flag(F.col("has_cyclonedx_sbom")).alias("cyclonedx_count"),
    )


def audited_projects(projects: DataFrame, limit: int | None = None) -> DataFrame:
    listed = (
        projects.filter("has_security_audits")
        .orderBy("maturity", "display_name", "project_name")
        .select(
            "display_name", "maturity", "security_audit_count", "latest_audit_date",
            "latest_audit_vendor",
        )
    )
    return listed if limit is None else listed.limit(limit)


def projects_missing_sboms(projects: DataFrame) -> DataFrame:
    return (
        projects.filter("repos_with_sbom = 0 AND maturity IN ('graduated', 'incubating')")
        .orderBy("maturity", "display_name")
        .select("display_name", "maturity", "category", "total_repos", "homepage_url")
    )


def sbom_count_per_repo(patterns: DataFrame) -> DataFrame:
    """Released SBOM files per repository, most first."""
    return (
        patterns.filter("is_sbom")
        .groupBy("nameWithOwner")
        .agg(F.count("*").alias("sbom_count"))
        .orderBy(F.desc("sbom_count"), "nameWithOwner")
    )


def asset_breakdown(
    patterns: DataFrame, releases: DataFrame, name_with_owner: str | None = None
) -> DataFrame:
    """Artifacts with their release tag, newest release first; one repository or all."""
    chosen = patterns
    if name_with_owner is not None:
        chosen = chosen.filter(F.col("nameWithOwner") == name_with_owner)
    tags = releases.select(F.col("id").alias("release_id"), "tagName", "createdAt")
    return (
        chosen.join(tags, "release_id")
        .orderBy(F.desc("createdAt"), "asset_name", "asset_id")
        .select(
            "nameWithOwner", "tagName", "asset_id", "asset_name", "is_sbom", "is_signature",
            "is_attestation",
        )
    )
