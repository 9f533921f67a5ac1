"""Project-level model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions import values as V
from attestry.plans.repo_summary import maturity_score

# Project count column -> repository flag it counts.
REPO_COUNTS = {
    "repos_with_sbom": "has_sbom_artifact",
    "repos_with_spdx": "has_spdx_sbom",
    "repos_with_cyclonedx": "has_cyclonedx_sbom",
    "repos_with_signatures": "has_signature_artifact",
    "repos_with_attestations": "has_attestation_artifact",
    "repos_with_slsa_provenance": "has_slsa_provenance",
    "repos_with_in_toto": "has_in_toto_attestation",
    "repos_using_syft": "uses_syft",
    "repos_using_trivy": "uses_trivy",
    "repos_using_cosign": "uses_cosign",
    "repos_using_sigstore": "uses_sigstore",
    "repos_using_slsa_generator": "uses_slsa_github_generator",
    "repos_using_cdxgen": "uses_cdxgen",
    "repos_using_grype": "uses_grype",
    "repos_using_goreleaser": "uses_goreleaser",
    "repos_using_codeql": "uses_codeql",
    "repos_using_snyk": "uses_snyk",
    "repos_using_vuln_scanner": "uses_vulnerability_scanner",
    "repos_using_container_scanner": "uses_container_scanner",
    "repos_using_dependabot": "uses_dependabot",
    "repos_using_renovate": "uses_renovate",
}
# Project sum column -> repository number it adds up.
REPO_SUMS = {
    "total_releases": "total_releases",
    "total_release_assets": "total_assets",
    "total_workflows": "total_workflows",
    "total_sbom_artifacts": "sbom_artifact_count",
}
# Project attributes carried into the summary.
IDENTITY = ["project_name", "display_name", "description", "maturity", "category", "subcategory"]
ATTRIBUTES = [
    "date_accepted", "date_incubating", "date_graduated", "has_security_audits",
    "security_audit_count", "latest_audit_date", "latest_audit_vendor", "homepage_url", "repo_url",
    "clomonitor_name", "dev_stats_url", "blog_url", "crunchbase", "twitter",
    "url_for_bestpractices", "package_manager_url", "docker_url",
]


def project_rollup(
    project_repos: DataFrame, summary: DataFrame, case_insensitive: bool = False
) -> DataFrame:
    """Repository signals per project.

    The bridge joins the summary on owner and name; the first aggregate keeps
    those two columns among its keys, so it reuses the join's partitioning and
    leaves one row per project and repository. What would be two dozen distinct
    counts are then plain sums with a partial aggregate.
    """
    fold = F.lower if case_insensitive else (lambda c: c)
    bridge = project_repos.select(
        "project_name",
        "primary",
        "owner",
        "name",
        fold(F.col("owner")).alias("_owner"),
        fold(F.col("name")).alias("_name"),
    )
    repos = summary.select(
        fold(V.owner_of(F.col("nameWithOwner"))).alias("_owner"),
        fold(V.repo_of(F.col("nameWithOwner"))).alias("_name"),
        *dict.fromkeys([*REPO_COUNTS.values(), *REPO_SUMS.values()]),
        "first_sbom_date",
        "first_release_with_sbom",
        # A summary scored with weights of its own keeps them.
        (F.col("security_maturity_score") if "security_maturity_score" in summary.columns else maturity_score()).alias(
            "score"
        ),
    )
    joined = bridge.join(repos, ["_owner", "_name"], "left")
    aggs = lambda exprs: [F.expr(sql).alias(name) for name, sql in exprs.items()]
    per_repo = joined.groupBy("project_name", "_owner", "_name", "owner", "name").agg(
        *aggs(
            {
                "is_primary": "bool_or(`primary`)",
                **{c: f"bool_or({flag})" for c, flag in REPO_COUNTS.items()},
                **{c: f"sum({number})" for c, number in REPO_SUMS.items()},
                "first_sbom_date": "min(first_sbom_date)",
                "first_release_with_sbom": "min(first_release_with_sbom)",
                "score": "max(score)",
            }
        )
    )
    # a repository without owner or name counts in no distinct count
    named = "owner IS NOT NULL AND name IS NOT NULL"
    return per_repo.groupBy("project_name").agg(
        *aggs(
            {
                "total_repos": f"count_if({named})",
                "primary_repos": f"count_if({named} AND is_primary)",
                **{c: f"count_if({named} AND {c})" for c in REPO_COUNTS},
                **{c: f"sum(coalesce({c}, 0L))" for c in REPO_SUMS},
                "earliest_sbom_date": "min(first_sbom_date)",
                "earliest_release_with_sbom": "min(first_release_with_sbom)",
                # A sum and a count add up the same in any order, unlike an average.
                "score_sum": "sum(score)",
                "score_count": "count(score)",
            }
        )
    )


def project_summary(
    projects: DataFrame,
    project_repos: DataFrame,
    summary: DataFrame,
    case_insensitive: bool = False,
) -> DataFrame:
    """One row per project with its attributes and rolled-up signals."""
    rollup = project_rollup(project_repos, summary, case_insensitive)
    joined = projects.select(*IDENTITY, *ATTRIBUTES).join(rollup, "project_name", "left")
    counts = ["total_repos", "primary_repos", *REPO_SUMS, *REPO_COUNTS]
    return joined.selectExpr(
        *IDENTITY,
        *[f"coalesce({c}, 0L) AS {c}" for c in counts],
        "coalesce(try_divide(double(repos_with_sbom), double(total_repos)), 0D) "
        "AS sbom_adoption_rate",
        "earliest_sbom_date",
        "earliest_release_with_sbom",
        "try_divide(score_sum, score_count) AS security_maturity_score",
        *ATTRIBUTES,
    )
