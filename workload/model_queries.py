"""Repository, project and summary models and the saved analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestry.operators import classify
from attestry.plans import analyses, models, project_summary, repo_summary, summaries
from attestry.plans import project_summary as PS
from workload.prelude import pct, sum_if
from workload.registry import query

_SUMMARY = "SELECT * FROM scored"
_ORDER = (
    "CASE maturity WHEN 'graduated' THEN 1 WHEN 'incubating' THEN 2 WHEN 'sandbox' THEN 3 ELSE 4 END"
)


@query("repo_summary", _SUMMARY)
def repo_summary_query(g):
    return g.summary


@query("repo_summary_from_models", "SELECT * EXCLUDE (security_maturity_score) FROM scored")
def repo_summary_from_models(g):
    return repo_summary.repo_summary(
        g.repositories, g.releases, g.patterns, g.workflows, g.tools
    )


@query(
    "release_signals",
    "SELECT release_id, count(*) AS total_assets, "
    + ", ".join(f"bool_or(sbom_format = '{f}') AS {c}" for c, f in repo_summary.FORMAT_FLAGS.items())
    + ", "
    + ", ".join(f"bool_or({f}) AS {c}" for c, f in repo_summary.ARTIFACT_FLAGS_OF_REPO.items())
    + f", {sum_if('is_sbom')} AS sbom_artifact_count, {sum_if('is_signature')} AS signature_artifact_count"
    + " FROM agg_artifact_patterns GROUP BY release_id",
)
def release_signals(g):
    return repo_summary.release_signals(classify.classify_assets(g.assets))


@query(
    "executive_summary",
    "SELECT count(*) AS total_repos, "
    f"{sum_if('has_sbom_artifact')} AS repos_with_sbom, "
    f"{sum_if('has_signature_artifact')} AS repos_with_signatures, "
    f"{sum_if('has_attestation_artifact')} AS repos_with_attestations, "
    f"{pct(sum_if('has_sbom_artifact'), 'count(*)')} AS sbom_percentage, "
    f"{pct(sum_if('has_signature_artifact'), 'count(*)')} AS signature_percentage, "
    f"{pct(sum_if('has_attestation_artifact'), 'count(*)')} AS attestation_percentage, "
    "sum(total_releases)::BIGINT AS total_releases, sum(total_assets)::BIGINT AS total_assets, "
    "sum(total_workflows)::BIGINT AS total_workflows, "
    f"{sum_if('uses_sbom_generator')} AS repos_using_sbom_generators, "
    f"{sum_if('uses_signer')} AS repos_using_signers, "
    f"{sum_if('uses_vulnerability_scanner')} AS repos_using_vuln_scanners, "
    f"{sum_if('uses_dependency_scanner')} AS repos_using_dep_scanners, "
    f"{sum_if('uses_code_scanner')} AS repos_using_code_scanners, "
    f"{sum_if('uses_container_scanner')} AS repos_using_container_scanners FROM agg_repo_summary",
)
def executive_summary(g):
    return summaries.executive_summary(g.summary)


_PER_TOOL = (
    "SELECT tool_category, tool_name, count(DISTINCT repository_id) AS repo_count, "
    "count(DISTINCT workflow_id) AS workflow_count FROM agg_workflow_tools GROUP BY tool_category, tool_name"
)


@query(
    "tool_summary",
    f"SELECT tool_name, tool_category, repo_count, workflow_count, {pct('repo_count', 'total_repos')} "
    f"AS adoption_percentage FROM ({_PER_TOOL}) CROSS JOIN "
    "(SELECT count(*) AS total_repos FROM base_repositories)",
)
def tool_summary(g):
    return summaries.tool_summary(g.tools, g.repositories)


@query("tool_category_summary", _PER_TOOL)
def tool_category_summary(g):
    return summaries.tool_category_summary(g.tools)


@query(
    "repo_summary_sorted",
    "SELECT nameWithOwner, total_releases, has_sbom_artifact, has_signature_artifact, "
    "has_attestation_artifact, uses_sbom_generator, uses_signer, uses_code_scanner FROM agg_repo_summary",
)
def repo_summary_sorted(g):
    return summaries.repo_summary_sorted(g.summary)


@query(
    "repo_detail",
    "SELECT nameWithOwner, total_releases, total_assets, sbom_artifact_count, signature_artifact_count, "
    "uses_sbom_generator, uses_signer, uses_vulnerability_scanner, uses_code_scanner FROM agg_repo_summary",
)
def repo_detail(g):
    return summaries.repo_detail(g.summary)


@query(
    "sbom_summary",
    f"SELECT count(*) AS total_repos, {sum_if('has_spdx_sbom')} AS spdx_count, "
    f"{sum_if('has_cyclonedx_sbom')} AS cyclonedx_count, {sum_if('has_unknown_sbom_format')} AS unknown_count, "
    f"{sum_if('sbom_adoption_rate > 0')} AS partial_adoption, {sum_if('sbom_adoption_rate = 1.0')} AS full_adoption "
    "FROM agg_repo_summary WHERE has_sbom_artifact",
)
def sbom_summary(g):
    return summaries.sbom_summary(g.summary)


_ADVANCED = (
    "SELECT count(DISTINCT repository_id) AS repos_with_advanced_artifacts, "
    + ", ".join(f"{sum_if(f)} AS {c}" for c, f in summaries.ADVANCED.items())
    + " FROM agg_artifact_patterns WHERE "
    + " OR ".join(summaries.ADVANCED.values())
)


@query("advanced_artifacts", _ADVANCED)
def advanced_artifacts(g):
    return summaries.advanced_artifacts(g.patterns)


_TAG = "'v' || (o_orderkey * 7919 % 100)"


@query(
    "first_sbom_tags",
    f"SELECT repository_id, min({_TAG}) AS first_release_with_sbom, min(o_orderdate) AS first_sbom_date, "
    f"arg_min({_TAG}, (o_orderdate, {_TAG})) AS first_sbom_tag_by_date FROM base_releases l JOIN orders ON l.id = 'L' || o_orderkey "
    "WHERE l.id IN (SELECT release_id FROM agg_artifact_patterns WHERE is_sbom) GROUP BY repository_id",
)
def first_sbom_tags(g):
    """Tags whose order as text is not that of their dates: the smallest one and the one of the first date."""
    tag = F.concat(F.lit("v"), (F.substring("id", 2, 20).cast("long") * 7919 % 100).cast("string"))
    stats = repo_summary.artifact_stats(g.releases.withColumn("tagName", tag), classify.classify_assets(g.assets))
    return stats.filter("first_sbom_date IS NOT NULL").select(
        "repository_id", "first_release_with_sbom", "first_sbom_date", "first_sbom_tag_by_date"
    )


@query(
    "category_stats",
    "SELECT tool_category, count(DISTINCT repository_id) AS repo_count, "
    "count(DISTINCT tool_name) AS unique_tools, count(*) AS total_detections, "
    "CASE tool_category WHEN 'goreleaser' THEN 'Goreleaser' WHEN 'signer' THEN 'Signer' "
    "WHEN 'sbom-generator' THEN 'Sbom Generator' ELSE "
    "upper(tool_category[1]) || split_part(tool_category, '-', 1)[2:] || ' Scanner' END AS label "
    "FROM agg_workflow_tools GROUP BY tool_category",
)
def category_stats(g):
    return summaries.category_stats(g.tools)


@query(
    "repos_per_tool",
    "SELECT tool_name, count(DISTINCT repository_id) AS repo_count FROM agg_workflow_tools GROUP BY tool_name",
)
def repos_per_tool(g):
    return summaries.repos_per_tool(g.tools)


@query(
    "artifact_totals",
    f"SELECT count(*) AS total_repos, {sum_if('has_sbom_artifact')} AS repos_with_sbom, "
    f"{sum_if('has_signature_artifact')} AS repos_with_signatures, "
    f"{sum_if('has_attestation_artifact')} AS repos_with_attestations, "
    f"{pct(sum_if('has_sbom_artifact'), 'count(*)', 0)} AS sbom_pct, "
    f"{pct(sum_if('has_signature_artifact'), 'count(*)', 0)} AS signature_pct, "
    f"{pct(sum_if('has_attestation_artifact'), 'count(*)', 0)} AS attestation_pct FROM agg_repo_summary",
)
def artifact_totals(g):
    return summaries.artifact_totals(g.summary)


@query(
    "artifact_status",
    "SELECT '✓ Created agg_artifact_patterns' AS status, count(*) AS total_assets, "
    + ", ".join(f"{sum_if(f)} AS {c}" for c, f in summaries.STATUS_FLAGS.items())
    + " FROM agg_artifact_patterns",
)
def artifact_status(g):
    return summaries.artifact_status(g.patterns)


@query(
    "tools_status",
    "SELECT '✓ Created agg_workflow_tools' AS status, count(*) AS total_detections, "
    "count(DISTINCT workflow_id) AS unique_workflows, count(DISTINCT repository_id) AS unique_repositories "
    "FROM agg_workflow_tools",
)
def tools_status(g):
    return summaries.tools_status(g.tools)


@query(
    "repo_summary_status",
    "SELECT '✓ Created agg_repo_summary' AS status, count(*) AS total_repositories, "
    f"{sum_if('has_sbom_artifact')} AS repos_with_sbom, {sum_if('uses_cosign')} AS repos_using_cosign, "
    f"{sum_if('uses_syft')} AS repos_using_syft FROM agg_repo_summary",
)
def repo_summary_status(g):
    return summaries.repo_summary_status(g.summary)


@query(
    "summary_status",
    "SELECT 'agg_executive_summary' AS table_name, 'total_repos' AS figure, count(*) AS value FROM agg_repo_summary "
    "UNION ALL SELECT 'agg_executive_summary', 'repos_with_sbom', count(*) FROM agg_repo_summary WHERE has_sbom_artifact "
    "UNION ALL SELECT 'agg_executive_summary', 'repos_with_signatures', count(*) FROM agg_repo_summary WHERE has_signature_artifact "
    "UNION ALL SELECT 'agg_repo_summary_sorted', 'total_repos', count(*) FROM agg_repo_summary "
    "UNION ALL SELECT 'agg_sbom_summary', 'repos_with_sboms', count(*) FROM agg_repo_summary WHERE has_sbom_artifact "
    "UNION ALL SELECT 'agg_repo_detail', 'total_repos', count(*) FROM agg_repo_summary "
    f"UNION ALL SELECT 'agg_tool_summary', 'unique_tools', count(*) FROM ({_PER_TOOL}) "
    f"UNION ALL SELECT 'agg_tool_summary', 'total_tool_detections', coalesce(sum(repo_count), 0)::BIGINT FROM ({_PER_TOOL}) "
    f"UNION ALL SELECT 'agg_tool_category_summary', 'tool_detections', count(*) FROM ({_PER_TOOL}) "
    f"UNION ALL SELECT 'agg_advanced_artifacts', 'repos', repos_with_advanced_artifacts FROM ({_ADVANCED})",
)
def summary_status(g):
    return summaries.summary_status(g.summary, g.tools, g.patterns)


def _guarded(name: str, found: str, figure: str, none: str) -> str:
    """Status rows of a table with rows and of the same table without any."""

    def rows(where: str) -> str:
        return (
            f"SELECT '✓ Created {name}' AS status, coalesce({figure[0]}, 0) AS {figure[1]} FROM ({found}) WHERE {where} "
            f"UNION ALL SELECT '✓ Created {name} ({none})', 0 WHERE NOT EXISTS (SELECT 1 FROM ({found}) WHERE {where})"
        )

    return f"SELECT * FROM ({rows('true')}) UNION ALL SELECT * FROM ({rows('false')})"


@query(
    "sbom_status_rows",
    _guarded(
        "agg_sbom_summary",
        "SELECT count(*) AS total_repos FROM agg_repo_summary WHERE has_sbom_artifact",
        ("total_repos", "repos_with_sboms"),
        "no SBOMs",
    ),
)
def sbom_status_rows(g):
    """The summary's status, and that of a summary without rows."""
    table = summaries.sbom_summary(g.summary)
    return summaries.sbom_summary_status(table).unionByName(
        summaries.sbom_summary_status(table.filter("false"))
    )


@query(
    "advanced_status_rows",
    _guarded(
        "agg_advanced_artifacts", _ADVANCED, ("repos_with_advanced_artifacts", "repos"), "none detected"
    ),
)
def advanced_status_rows(g):
    """The table's status, and that of a table without rows."""
    table = summaries.advanced_artifacts(g.patterns)
    return summaries.advanced_artifacts_status(table).unionByName(
        summaries.advanced_artifacts_status(table.filter("false"))
    )


@query(
    "project_status",
    "SELECT '✓ Created agg_cncf_project_summary' AS status, count(*) AS total_projects, "
    "count(*) FILTER (WHERE maturity = 'graduated') AS graduated_projects, "
    "count(*) FILTER (WHERE maturity = 'incubating') AS incubating_projects, "
    "count(*) FILTER (WHERE maturity = 'sandbox') AS sandbox_projects, "
    "sum(repos_with_sbom)::BIGINT AS total_repos_with_sbom, "
    "round(avg(sbom_adoption_rate) * 100, 1)::VARCHAR || '%' AS avg_sbom_adoption_rate FROM projects_all",
)
def project_status(g):
    return summaries.project_status(g.project_summary)


@query(
    "tool_combinations",
    "SELECT uses_syft, uses_cosign, uses_trivy, count(*) AS repo_count FROM agg_repo_summary "
    "GROUP BY ALL HAVING count(*) > 1",
)
def tool_combinations(g):
    return summaries.tool_combinations(g.summary)


@query(
    "repos_using_both_tools",
    "SELECT nameWithOwner FROM agg_workflow_tools WHERE tool_name IN ('syft', 'cosign') "
    "GROUP BY nameWithOwner HAVING count(DISTINCT tool_name) = 2",
)
def repos_using_both_tools(g):
    return summaries.repos_using_all(g.tools, ["syft", "cosign"])


@query(
    "tools_by_category",
    "SELECT label AS category, string_agg(tool_name || ': ' || repo_count || ' repositories, ' || "
    "workflow_count || ' workflows', '; ' ORDER BY repo_count DESC, tool_name) AS tools FROM ("
    "SELECT *, CASE tool_category WHEN 'goreleaser' THEN 'Goreleaser' WHEN 'signer' THEN 'Signer' "
    "WHEN 'sbom-generator' THEN 'Sbom Generator' ELSE upper(tool_category[1]) || "
    "split_part(tool_category, '-', 1)[2:] || ' Scanner' END AS label "
    f"FROM ({_PER_TOOL})) GROUP BY label",
)
def tools_by_category(g):
    return summaries.tools_by_category(g.tools)


# Projects -------------------------------------------------------------------


@query("project_rollup", "SELECT * EXCLUDE (security_maturity_score) FROM rollup")
def project_rollup(g):
    return project_summary.project_rollup(g.project_repos, g.summary).drop(
        "score_sum", "score_count"
    )


@query("project_summary", "SELECT * FROM projects_all")
def project_summary_query(g):
    return g.project_summary


@query("project_summary_case_insensitive", "SELECT * FROM projects_folded")
def project_summary_case_insensitive(g):
    return project_summary.project_summary(
        g.projects, g.project_repos, g.summary, case_insensitive=True
    )


_POS = lambda c: f"count(*) FILTER (WHERE {c} > 0)"
_AVG_RATE = "round(avg(sbom_adoption_rate) * 100, 1) AS avg_sbom_adoption_pct"
_AVG_SCORE = "round(avg(security_maturity_score), 2) AS avg_security_score"


@query(
    "by_maturity",
    f"SELECT maturity, count(*) AS project_count, {_POS('repos_with_sbom')} AS projects_with_sbom, "
    f"{_AVG_RATE}, {_POS('repos_with_signatures')} AS projects_with_signing, "
    f"{_POS('repos_with_slsa_provenance')} AS projects_with_slsa, "
    f"{_POS('repos_using_codeql')} AS projects_using_codeql, "
    f"count(*) FILTER (WHERE has_security_audits) AS projects_with_audits, {_AVG_SCORE} "
    "FROM projects_all GROUP BY maturity",
)
def by_maturity(g):
    return analyses.by_maturity(g.project_summary)


def _ratio(part, whole="total_repos"):
    return f"{part} || '/' || {whole}"


@query(
    "leaders",
    "SELECT display_name, maturity, category, security_maturity_score, "
    f"{_ratio('repos_with_sbom')} AS sbom_repos, {_ratio('repos_with_signatures')} AS signing_repos, "
    "CASE WHEN has_security_audits THEN '✓' ELSE '' END AS audited, "
    "CASE WHEN url_for_bestpractices IS NOT NULL THEN '✓' ELSE '' END AS openssf_badge, homepage_url "
    "FROM projects_all WHERE security_maturity_score >= 5 "
    "ORDER BY security_maturity_score DESC, maturity NULLS FIRST, display_name, project_name LIMIT 20",
)
def leaders(g):
    return analyses.leaders(g.project_summary)


@query(
    "leaders_low_bar",
    "SELECT display_name, maturity, category, security_maturity_score, "
    f"{_ratio('repos_with_sbom')} AS sbom_repos, {_ratio('repos_with_signatures')} AS signing_repos, "
    "CASE WHEN has_security_audits THEN '✓' ELSE '' END AS audited, "
    "CASE WHEN url_for_bestpractices IS NOT NULL THEN '✓' ELSE '' END AS openssf_badge, homepage_url "
    "FROM projects_all WHERE security_maturity_score >= 2 "
    "ORDER BY security_maturity_score DESC, maturity NULLS FIRST, display_name, project_name LIMIT 20",
)
def leaders_low_bar(g):
    return analyses.leaders(g.project_summary, minimum=2.0)


@query(
    "format_adoption",
    " UNION ALL ".join(
        f"SELECT '{label}' AS sbom_format, {_POS(c)} AS projects_using, "
        f"sum({c})::BIGINT AS total_repos_using, {pct(_POS(c), 'count(*)')} AS adoption_pct FROM projects_all"
        for label, c in [("SPDX", "repos_with_spdx"), ("CycloneDX", "repos_with_cyclonedx")]
    ),
)
def format_adoption(g):
    return analyses.format_adoption(g.project_summary)


@query(
    "tool_popularity",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS tool_name, '{category}' AS category, {_POS(c)} AS projects_using, "
        f"sum({c})::BIGINT AS repos_using, {pct(_POS(c), 'count(*)')} AS project_adoption_pct FROM projects_all"
        for name, category, c in analyses.TOOL_POPULARITY
    )
    + ") WHERE repos_using > 0",
)
def tool_popularity(g):
    return analyses.tool_popularity(g.project_summary)


_SHARE = lambda c: f"round(avg(CASE WHEN {c} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 1)"


@query(
    "audit_correlation",
    "SELECT CASE WHEN has_security_audits THEN 'With Security Audits' ELSE 'No Security Audits' END "
    f"AS audit_status, count(*) AS project_count, {_AVG_RATE}, "
    f"{_SHARE('repos_with_signatures')} AS pct_with_signing, "
    f"{_SHARE('repos_with_slsa_provenance')} AS pct_with_slsa, {_AVG_SCORE} "
    "FROM projects_all GROUP BY has_security_audits",
)
def audit_correlation(g):
    return analyses.audit_correlation(g.project_summary)


@query(
    "by_category",
    f"SELECT category, count(*) AS project_count, {_AVG_RATE}, "
    f"{_POS('repos_with_sbom')} AS projects_with_sbom, {_POS('repos_using_cosign')} AS projects_using_cosign, "
    f"{_POS('repos_using_trivy')} AS projects_using_trivy, {_AVG_SCORE} "
    "FROM projects_all GROUP BY category HAVING count(*) >= 3 "
    "ORDER BY avg_security_score DESC NULLS LAST, project_count DESC, category LIMIT 15",
)
def by_category(g):
    return analyses.by_category(g.project_summary)


_LACKS = lambda c, label: f"CASE WHEN {c} = 0 THEN '❌ {label}' ELSE '✓' END"


@query(
    "missing_practices",
    "SELECT display_name, maturity, category, total_repos, security_maturity_score, "
    f"{_LACKS('repos_with_sbom', 'No SBOM')} AS sbom_status, "
    f"{_LACKS('repos_with_signatures', 'No Signing')} AS signing_status, "
    f"{_LACKS('repos_using_vuln_scanner', 'No Vuln Scanning')} AS scanning_status, "
    f"{_LACKS('(repos_using_dependabot + repos_using_renovate)', 'No Dep Mgmt')} AS dep_mgmt_status, "
    "homepage_url FROM projects_all WHERE maturity IN ('graduated', 'incubating') "
    "AND security_maturity_score < 4 ORDER BY CASE maturity WHEN 'graduated' THEN 1 ELSE 2 END, "
    "security_maturity_score, display_name, project_name LIMIT 25",
)
def missing_practices(g):
    return analyses.missing_practices(g.project_summary)


@query(
    "discovery_urls",
    f"SELECT display_name, maturity, {_ratio('repos_with_sbom')} AS sbom_repos, package_manager_url, "
    "docker_url, homepage_url FROM projects_all "
    "WHERE package_manager_url IS NOT NULL OR docker_url IS NOT NULL",
)
def discovery_urls(g):
    return analyses.discovery_urls(g.project_summary)


@query(
    "adoption_over_time",
    "SELECT display_name, maturity, earliest_release_with_sbom, earliest_sbom_date, "
    "extract(year FROM earliest_sbom_date::DATE)::INT AS sbom_adoption_year, "
    f"{_ratio('repos_with_sbom')} AS current_sbom_coverage FROM projects_all "
    "WHERE earliest_sbom_date IS NOT NULL ORDER BY earliest_sbom_date DESC, project_name LIMIT 30",
)
def adoption_over_time(g):
    return analyses.adoption_over_time(g.project_summary)


@query(
    "multi_repo_projects",
    "SELECT display_name, maturity, total_repos, primary_repos, repos_with_sbom, "
    "round(sbom_adoption_rate * 100, 1) AS sbom_adoption_pct, repos_using_cosign AS signing_repos, "
    "security_maturity_score, repo_url FROM projects_all WHERE total_repos > 1 "
    "ORDER BY total_repos DESC, security_maturity_score DESC NULLS LAST, project_name LIMIT 25",
)
def multi_repo_projects(g):
    return analyses.multi_repo_projects(g.project_summary)


_OVERVIEW = [
    ("Repositories with SBOMs", "has_sbom_artifact"),
    ("Repositories with Signatures", "has_signature_artifact"),
    ("Repositories using Cosign", "uses_cosign"),
    ("Repositories using Syft", "uses_syft"),
]


@query(
    "overview",
    "SELECT 'Total Repositories' AS metric, count(*)::VARCHAR AS value FROM scored "
    + " ".join(
        f"UNION ALL SELECT '{label}', count(*)::VARCHAR FROM scored WHERE {c}" for label, c in _OVERVIEW
    )
    + " UNION ALL SELECT 'Average Security Maturity Score', "
    "round(avg(security_maturity_score), 2)::VARCHAR || '/10' FROM scored",
)
def overview(g):
    return analyses.overview(g.summary)


@query(
    "top_tools",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{label}' AS tool, {sum_if(c)} AS repo_count, {pct(sum_if(c), 'count(*)')} AS percentage "
        "FROM agg_repo_summary"
        for label, c in analyses.TOP_TOOLS
    )
    + ") WHERE repo_count > 0",
)
def top_tools(g):
    return analyses.top_tools(g.summary)


@query(
    "generator_gap",
    "SELECT count(DISTINCT repository_id) AS total_repos, "
    f"{sum_if('uses_syft')} AS repos_using_syft, {sum_if('uses_trivy')} AS repos_using_trivy, "
    f"{sum_if('uses_cdxgen')} AS repos_using_cdxgen, {sum_if('has_sbom_artifact')} AS repos_with_sbom_artifacts, "
    f"{sum_if('uses_sbom_generator')} AS repos_using_sbom_generators, "
    f"{sum_if('uses_sbom_generator')} - {sum_if('has_sbom_artifact')} AS gap FROM agg_repo_summary",
)
def generator_gap(g):
    return analyses.generator_gap(g.summary)


_CORRELATION = (
    "SELECT maturity, count(*) AS project_count, sum(repos_with_sbom)::BIGINT AS projects_with_sbom, "
    "round(avg(sbom_adoption_rate), 6) AS avg_adoption_rate, "
    "sum(repos_using_syft)::BIGINT AS projects_using_syft, "
    "sum(repos_using_trivy)::BIGINT AS projects_using_trivy, "
    "sum(repos_using_cosign)::BIGINT AS projects_using_cosign "
    "FROM projects_all WHERE maturity IS NOT NULL GROUP BY maturity"
)


@query("maturity_correlation", _CORRELATION)
def maturity_correlation(g):
    return analyses.maturity_correlation(g.project_summary).withColumn(
        "avg_adoption_rate", F.round("avg_adoption_rate", 6)
    )


@query(
    "melted_tool_usage",
    " UNION ALL ".join(
        f"SELECT maturity, '{c}' AS tool, {c} AS count FROM ({_CORRELATION})"
        for c in ("projects_using_syft", "projects_using_trivy", "projects_using_cosign")
    ),
)
def melted_tool_usage(g):
    return analyses.melt_tool_usage(analyses.maturity_correlation(g.project_summary))


@query(
    "exploration_table",
    "SELECT s.nameWithOwner, s.description, "
    + ", ".join(f"s.{c}" for c in analyses.EXPLORATION)
    + ", p.maturity, p.category, p.subcategory FROM agg_repo_summary s "
    "LEFT JOIN base_cncf_project_repos pr ON s.nameWithOwner = pr.owner || '/' || pr.name "
    "LEFT JOIN base_cncf_projects p ON pr.project_name = p.project_name",
)
def exploration_table(g):
    return analyses.exploration_table(g.summary, g.project_repos, g.projects)


@query(
    "signers_without_sbom",
    "SELECT nameWithOwner FROM agg_repo_summary WHERE uses_cosign AND NOT has_sbom_artifact",
)
def signers_without_sbom(g):
    return analyses.signers_without_sbom(g.summary)


@query(
    "format_distribution",
    f"SELECT {sum_if('has_spdx_sbom')} AS spdx_count, {sum_if('has_cyclonedx_sbom')} AS cyclonedx_count "
    "FROM agg_repo_summary",
)
def format_distribution(g):
    return analyses.format_distribution(g.summary)


@query(
    "audited_projects",
    "SELECT display_name, maturity, security_audit_count, latest_audit_date, latest_audit_vendor "
    "FROM projects_all WHERE has_security_audits",
)
def audited_projects(g):
    return analyses.audited_projects(g.project_summary)


@query(
    "projects_missing_sboms",
    "SELECT display_name, maturity, category, total_repos, homepage_url FROM projects_all "
    "WHERE repos_with_sbom = 0 AND maturity IN ('graduated', 'incubating')",
)
def projects_missing_sboms(g):
    return analyses.projects_missing_sboms(g.project_summary)


@query(
    "sbom_count_per_repo",
    "SELECT nameWithOwner, count(*) AS sbom_count FROM agg_artifact_patterns WHERE is_sbom GROUP BY nameWithOwner",
)
def sbom_count_per_repo(g):
    return analyses.sbom_count_per_repo(g.patterns)


@query(
    "asset_breakdown",
    "SELECT p.nameWithOwner, l.tagName, p.asset_id, p.asset_name, p.is_sbom, p.is_signature, p.is_attestation "
    "FROM agg_artifact_patterns p JOIN base_releases l ON p.release_id = l.id",
)
def asset_breakdown(g):
    return analyses.asset_breakdown(g.patterns, g.releases)


@query("stored_models", "SELECT * FROM projects_all")
def stored_models(g):
    """All models one after the other, each stored before the next reads it."""
    tables, skipped = models.run_stored(g.spark, g.base_tables())
    if skipped:
        raise RuntimeError(f"models left out: {skipped}")
    return tables["agg_cncf_project_summary"]
