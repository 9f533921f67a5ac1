"""Normalisation, insight documents, sources, sinks and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry import schemas
from attestry.functions import values as V
from attestry.functions.yamljson import spread
from attestry.operators import insights, inventory, landscape, latest
from attestry.operators import normalise as N
from attestry.operators.detect import detect_tools
from attestry.plans import models, run
from attestry.session import work_dir
from attestry.sources import readers, writers
from attestry.streaming import ingest
from workload.prelude import tool_union
from workload.registry import query

# Insight documents -------------------------------------------------------------

# The twins read a document by casts to typed structs; all places of a record become one list of (label, JSON) pairs, which
# is unnested once. The labels and the names of the output columns are fixed values.
_SHAPE = (
    '{"header": {"schema-version": "VARCHAR", "last-updated": "VARCHAR"}, "project": {"name": "VARCHAR"}, '
    '"repository": {"url": "VARCHAR", "release": {"attestations": ["JSON"]}, '
    '"security": {"tools": [{"results": {"adhoc": "JSON", "ci": "JSON", "release": "JSON"}}]}}, '
    '"attestations": ["JSON"], "security-artifacts": {"attestations": ["JSON"]}, "dependencies": {"sbom": ["JSON"]}}'
)
_LABELLED = lambda label, items: f"[{{'label': '{label}', 'part': x}} FOR x IN coalesce({items}, [])]"
_ATTESTATION_PLACES = " || ".join(
    [
        _LABELLED("release", "t.repository.release.attestations"),
        "flatten([[{'label': 'tool_adhoc', 'part': x.results.adhoc}, {'label': 'tool_ci', 'part': x.results.ci}, "
        "{'label': 'tool_release', 'part': x.results.\"release\"}] FOR x IN coalesce(t.repository.security.tools, [])])",
        _LABELLED("top_level", "t.attestations"),
        _LABELLED("security_artifacts", 't."security-artifacts".attestations'),
    ]
)


def _records(places: str, shape: dict[str, str], label: str | None = None) -> str:
    """Rows of a document's records: `shape` maps output columns to fields of the record."""
    fields = ", ".join(f'"{field}": "VARCHAR"' for field in shape.values())
    columns = ([f"p.label AS {label}"] if label else []) + [f'r."{field}" AS {name}' for name, field in shape.items()]
    return (
        'SELECT repo_id, source_url, fetched_at, t.header."schema-version" AS schema_version, '
        'try_cast(t.header."last-updated" AS DATE) AS last_updated, t.repository.url AS repository_url, '
        f"t.project.name AS project_name, {', '.join(columns)} FROM ("
        f"SELECT *, json_transform(p.part, '{{{fields}}}') AS r FROM (SELECT *, unnest({places}) AS p FROM ("
        f"SELECT repo_id, source_url, fetched_at, json_transform(document, '{_SHAPE}') AS t FROM base_si_documents)) "
        "WHERE p.part IS NOT NULL)"
    )


_ATTESTATIONS = _records(
    _ATTESTATION_PLACES,
    {
        "attestation_name": "name", "attestation_location": "location",
        "attestation_predicate_uri": "predicate-uri", "attestation_comment": "comment",
    },
    "attestation_source",
)
_SBOMS = _records(
    _LABELLED("top_level", "t.dependencies.sbom"),
    {"sbom_format": "sbom-format", "sbom_url": "sbom-url", "sbom_file": "sbom-file", "sbom_comment": "comment"},
)


@query("si_attestations", _ATTESTATIONS)
def si_attestations(g):
    return insights.attestations(g.documents)


@query("si_sboms", _SBOMS)
def si_sboms(g):
    return insights.sboms(g.documents)


@query("si_sboms_by_source", f"SELECT *, 'top_level' AS sbom_source FROM ({_SBOMS})")
def si_sboms_by_source(g):
    return insights.sboms(g.documents, with_release_path=True)


def _status(sql: str, noun: str) -> str:
    return (
        "SELECT count(*) AS record_count, count(DISTINCT repo_id) AS repo_count, "
        f"count(*) || ' {noun}(s) from ' || count(DISTINCT repo_id) || ' repo(s)' AS status FROM ({sql})"
    )


@query("si_attestation_status", _status(_ATTESTATIONS, "attestation"))
def si_attestation_status(g):
    return insights.record_status(insights.attestations(g.documents), "attestation")


@query("si_sbom_status", _status(_SBOMS, "SBOM"))
def si_sbom_status(g):
    return insights.record_status(insights.sboms(g.documents), "SBOM")


@query(
    "insight_versions",
    "SELECT CASE schema_version WHEN '1.0.0' THEN 'v1' WHEN '2.1.0' THEN 'v2' ELSE 'unknown' END "
    "AS version_class, count(*) AS document_count FROM base_si_documents GROUP BY 1",
)
def insight_versions(g):
    return N.insight_version_classes(g.documents)


@query(
    "insight_version_kinds",
    "SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' WHEN o_orderpriority LIKE '1%' THEN 'v1' "
    "WHEN o_orderpriority LIKE '2%' THEN 'v2' ELSE 'other' END AS version_class, count(*) AS document_count "
    "FROM orders GROUP BY 1",
)
def insight_version_kinds(g):
    """Versions of all classes: majors beyond the known ones, and none."""
    major = F.substring("o_orderpriority", 1, 1)
    version = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(major, F.lit(".3.1")))
    return N.insight_version_classes(g.table("orders").select(version.alias("schema_version")))


@query(
    "sboms_of_releases",
    f"SELECT *, 'top_level' AS sbom_source FROM ({_SBOMS}) UNION ALL "
    "SELECT repo_id, source_url, fetched_at, json_extract_string(document, '$.header.schema-version'), "
    "try_cast(json_extract_string(document, '$.header.last-updated') AS DATE), json_extract_string(document, '$.repository.url'), "
    "json_extract_string(document, '$.project.name'), 'SPDX', NULL, repo_id || '.spdx', NULL, 'release' "
    "FROM base_si_documents WHERE json_exists(document, '$.repository.release')",
)
def sboms_of_releases(g):
    """SBOM lists in both places a document can hold them."""
    listed = F.concat(
        F.lit('"release":{"dependencies":{"sbom":[{"sbom-format":"SPDX","sbom-file":"'), "repo_id", F.lit('.spdx"}]},')
    )
    documents = g.documents.withColumn("document", F.replace("document", F.lit('"release":{"att'), F.concat(listed, F.lit('"att'))))
    return insights.sboms(documents, with_release_path=True)


@query(
    "sbom_export",
    "SELECT split_part(source_url, '/', 4) AS owner, split_part(source_url, '/', 5) AS repo, source_url, "
    "fetched_at, schema_version, last_updated, repository_url, project_name, sbom_format, sbom_file, "
    f"sbom_url, sbom_comment FROM ({_SBOMS})",
)
def sbom_export(g):
    return writers.sbom_export(insights.sboms(g.documents))


@query(
    "attestation_export",
    "SELECT split_part(source_url, '/', 4) AS owner, split_part(source_url, '/', 5) AS repo, source_url, "
    "fetched_at, schema_version, last_updated, repository_url, project_name, attestation_source, "
    "attestation_name, attestation_location, attestation_predicate_uri, attestation_comment "
    f"FROM ({_ATTESTATIONS})",
)
def attestation_export(g):
    return writers.attestation_export(insights.attestations(g.documents))


@query(
    "upserted_documents",
    "SELECT repo_id, source_url, CASE WHEN o_orderstatus = 'F' THEN '9.9.9' ELSE schema_version END "
    "AS schema_version, CASE WHEN o_orderstatus = 'F' THEN fetched_at + INTERVAL 1 DAY ELSE fetched_at END "
    "AS fetched_at FROM base_si_documents JOIN orders "
    "ON split_part(source_url, '/', 5) = 'repo' || o_orderkey",
)
def upserted_documents(g):
    """The documents, and newer versions of those with version 1.0.0."""
    newer = g.documents.filter("schema_version = '1.0.0'").withColumns(
        {
            "schema_version": F.lit("9.9.9"),
            "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return latest.upsert_documents(g.documents, newer).drop("document")


@query(
    "upserted_in_place",
    "SELECT repo_id, source_url, CASE WHEN o_orderstatus = 'F' THEN '9.9.9' ELSE schema_version END "
    "AS schema_version, CASE WHEN o_orderstatus = 'F' THEN fetched_at + INTERVAL 1 DAY ELSE fetched_at END "
    "AS fetched_at FROM base_si_documents JOIN orders "
    "ON split_part(source_url, '/', 5) = 'repo' || o_orderkey UNION ALL "
    "SELECT 'S' || s_suppkey, 'https://github.com/s/' || s_suppkey, '1.0.0', TIMESTAMP '2024-01-01' FROM supplier",
)
def upserted_in_place(g):
    """The documents stored, then newer ones, older ones and new ones merged into that table."""
    path = work_dir(g.spark, "documents")
    latest.upsert_in_place(g.documents, path, 16)
    newer = g.documents.filter("schema_version = '1.0.0'").withColumns(
        {"schema_version": F.lit("9.9.9"), "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 DAY")}
    )
    older = g.documents.filter("schema_version <> '1.0.0'").withColumns(
        {"schema_version": F.lit("0.0.0"), "fetched_at": F.col("fetched_at") - F.expr("INTERVAL 1 DAY")}
    )
    new = g.table("supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("repo_id"),
        F.concat(F.lit("https://github.com/s/"), "s_suppkey").alias("source_url"),
        F.lit("1.0.0").alias("schema_version"),
        F.lit("{}").alias("document"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("fetched_at"),
    )
    latest.upsert_in_place(newer.unionByName(older), path, 16)
    latest.upsert_in_place(new, path, 16)
    return g.spark.read.parquet(path).drop("document", "part")


# Nested responses ----------------------------------------------------------------


def _tables(g):
    return N.normalise(g.log)


def _release_tables(g):
    return N.normalise(g.release_log)


def _workflow_tables(g):
    return N.normalise(g.workflow_log)


@query(
    "normal_repositories",
    "SELECT repo_id AS id, CASE WHEN extended THEN 'Repository' END AS __typename, c_name AS name, "
    "nwo AS nameWithOwner, CASE WHEN extended THEN 'https://github.com/' || nwo END AS url, "
    "CASE WHEN extended THEN c_mktsegment END AS description, "
    "CASE WHEN extended THEN c_acctbal > 0 END AS hasVulnerabilityAlertsEnabled, "
    "CASE WHEN extended THEN lower(c_mktsegment) END AS license_key, "
    "CASE WHEN extended THEN c_mktsegment END AS license_name, NULL::VARCHAR AS license_spdxId, "
    "CASE WHEN extended THEN 'main' END AS defaultBranch_name FROM answered",
)
def normal_repositories(g):
    return _tables(g)["base_repositories"]


_RULE_NULLS = ", ".join(f"false AS {c}" for c in N.RULE_COLUMNS[:7])


@query(
    "normal_branch_rules",
    f"SELECT repo_id || '_default' AS id, 'BranchProtectionRule' AS __typename, repo_id AS repository_id, "
    f"{_RULE_NULLS}, c_nationkey::INT AS requiredApprovingReviewCount, 'main' AS pattern, "
    "true AS isDefaultBranch FROM answered WHERE extended AND c_acctbal > 0 UNION ALL "
    f"SELECT repo_id || '_rule_' || (n - 1), 'BranchProtectionRule', repo_id, "
    f"{', '.join(['false'] * 7)}, n::INT, CASE n WHEN 1 THEN 'release/*' ELSE 'v*' END, false "
    "FROM answered CROSS JOIN (VALUES (1), (2)) v(n) WHERE extended AND c_mktsegment <> 'HOUSEHOLD'",
)
def normal_branch_rules(g):
    return _tables(g)["base_branch_protection_rules"]


@query(
    "normal_releases",
    "SELECT l.id, 'Release' AS __typename, l.repository_id, l.name, l.tagName, l.url, l.createdAt "
    "FROM base_releases l JOIN answered ON l.repository_id = repo_id",
)
def normal_releases(g):
    # without a zone, as the given tables have it
    return _release_tables(g)["base_releases"].withColumn(
        "createdAt", F.col("createdAt").cast("timestamp_ntz")
    )


@query(
    "normal_assets",
    "SELECT a.id, 'ReleaseAsset' AS __typename, a.release_id, a.name, a.downloadUrl FROM base_release_assets a "
    "JOIN base_releases l ON a.release_id = l.id JOIN answered ON l.repository_id = repo_id",
)
def normal_assets(g):
    return _release_tables(g)["base_release_assets"]


@query(
    "normal_workflows",
    "SELECT repository_id || '_' || f.id || '-' || filename AS id, 'WorkflowFile' AS __typename, "
    "repository_id, f.id || '-' || filename AS filename, content FROM event_workflows f "
    "JOIN answered ON repository_id = repo_id WHERE extended",
)
def normal_workflows(g):
    return _workflow_tables(g)["base_workflows"]


@query(
    "normal_security_policies",
    "SELECT repo_id || ':SECURITY.md' AS id, 'SecurityMarkdown' AS __typename, repo_id AS repository_id, "
    "'SECURITY.md' AS path, '# Policy of ' || c_name AS content FROM answered "
    "WHERE c_mktsegment = 'BUILDING'",
)
def normal_security_policies(g):
    return _tables(g)["base_security_md"]


_YAML = "'header:' || chr(10) || '  schema-version: 2.0.0' || chr(10) || 'project:' || chr(10) || '  name: ' || c_name || chr(10)"
_BAD_YAML = "'a: [1, 2' || chr(10) || 'b: }'"


@query(
    "normal_repo_files",
    "SELECT repository_id || ':' || path AS id, repository_id, path, type, content, "
    "CASE WHEN path LIKE '.github/workflows/%' THEN regexp_extract(content, '^name: (.*)', 1) "
    "WHEN path ILIKE 'security-insights.yml' THEN regexp_extract(content, '  name: (.*)', 1) END AS named, "
    "CASE WHEN path ILIKE 'security-insights.yml' THEN '2.0.0' WHEN path LIKE '%dependabot.yml' THEN '2' END AS version, "
    "CASE WHEN path LIKE '.github/workflows/%' THEN regexp_extract(content, 'uses: (.*?)( #.*)?(\n|$)', 1) END AS first_step, "
    "type = 'yml' AND path <> '.github/security-insights.yml' AS parses, "
    "CASE WHEN type = 'markdown' THEN [content] END AS markdown_headings FROM ("
    "SELECT repo_id AS repository_id, 'SECURITY.md' AS path, 'markdown' AS type, '# Policy of ' || c_name AS content "
    "FROM answered WHERE c_mktsegment = 'BUILDING' UNION ALL "
    f"SELECT repo_id, 'SECURITY-INSIGHTS.yml', 'yml', {_YAML} FROM answered WHERE c_mktsegment = 'MACHINERY' UNION ALL "
    f"SELECT repo_id, 'security-insights.yml', 'yml', {_YAML} FROM answered "
    "WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY') UNION ALL "
    f"SELECT repo_id, '.github/security-insights.yml', 'yml', {_BAD_YAML} FROM answered "
    "WHERE c_mktsegment = 'BUILDING' UNION ALL "
    "SELECT repo_id, '.github/dependabot.yml', 'yml', 'version: 2' || chr(10) FROM answered "
    "WHERE c_mktsegment = 'MACHINERY' UNION ALL "
    "SELECT repository_id, '.github/workflows/' || f.id || '-' || filename, 'yml', content "
    "FROM event_workflows f JOIN answered ON repository_id = repo_id WHERE extended)",
)
def normal_repo_files(g):
    """Files with fields of their parsed documents and their headings."""
    files = _tables(g)["base_repo_files"].unionByName(_workflow_tables(g)["base_repo_files"])
    of = lambda *paths: F.coalesce(*[F.try_variant_get("parsed_json", p, "string") for p in paths])
    return N.with_parsed_content(files).select(
        "id", "repository_id", "path", "type", "content",
        of("$.project.name", "$.name").alias("named"),
        of("$.header['schema-version']", "$.version").alias("version"),
        of("$.jobs.main.steps[0].uses").alias("first_step"),
        F.col("parsed_json").isNotNull().alias("parses"),
        "markdown_headings",
    )


@query(
    "normal_insights",
    "SELECT repo_id, 'https://github.com/' || nwo || '/blob/HEAD/' || CASE c_mktsegment "
    "WHEN 'MACHINERY' THEN 'SECURITY-INSIGHTS.yml' ELSE 'security-insights.yml' END AS source_url, "
    "'2.0.0' AS schema_version, c_name AS project FROM answered "
    "WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY')",
)
def normal_insights(g):
    good, _ = N.split_insights(N.land_insights(N.insight_texts(g.log)))
    return good.select(
        "repo_id", "source_url", "schema_version",
        F.get_json_object("document", "$.project.name").alias("project"),
    )


@query(
    "bad_insights",
    "SELECT repo_id, 'https://github.com/' || nwo || '/blob/HEAD/.github/security-insights.yml' AS source_url, "
    f"{_BAD_YAML} AS content FROM answered WHERE c_mktsegment = 'BUILDING'",
)
def bad_insights(g):
    _, bad = N.split_insights(N.land_insights(N.insight_texts(g.log)))
    return bad


@query(
    "normal_row_counts",
    "SELECT 'base_repositories' AS table_name, count(*) AS row_count FROM answered UNION ALL "
    "SELECT 'base_branch_protection_rules', (count(*) FILTER (WHERE c_acctbal > 0) + "
    "2 * count(*) FILTER (WHERE c_mktsegment <> 'HOUSEHOLD')) FROM answered WHERE extended UNION ALL "
    "SELECT 'base_releases', count(*) FROM base_releases JOIN answered ON repository_id = repo_id UNION ALL "
    "SELECT 'base_release_assets', count(*) FROM base_release_assets a JOIN base_releases l ON a.release_id = l.id "
    "JOIN answered ON l.repository_id = repo_id UNION ALL "
    "SELECT 'base_security_md', count(*) FROM answered WHERE c_mktsegment = 'BUILDING' UNION ALL "
    "SELECT 'base_workflows', count(*) FROM event_workflows JOIN answered ON repository_id = repo_id WHERE extended UNION ALL "
    "SELECT 'base_repo_files', ((SELECT count(*) FROM event_workflows JOIN answered ON repository_id = repo_id "
    "WHERE extended) + count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) * 2 "
    "+ count(*) FILTER (WHERE c_mktsegment = 'FURNITURE') + count(*) FILTER (WHERE c_mktsegment = 'MACHINERY')) FROM answered UNION ALL "
    "SELECT 'base_si_documents', count(*) FROM answered WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY')",
)
def normal_row_counts(g):
    """All eight tables written; their rows are counted by the writes."""
    tables, flows, releases = _tables(g), _workflow_tables(g), _release_tables(g)
    good, _ = N.split_insights(N.land_insights(N.insight_texts(g.log)))
    counts = writers.write_all(
        {
            "base_repositories": tables["base_repositories"],
            "base_branch_protection_rules": tables["base_branch_protection_rules"],
            "base_releases": releases["base_releases"],
            "base_release_assets": releases["base_release_assets"],
            "base_security_md": tables["base_security_md"],
            "base_workflows": flows["base_workflows"],
            "base_repo_files": tables["base_repo_files"].unionByName(flows["base_repo_files"]),
            "base_si_documents": good,
        },
        work_dir(g.spark, "counted"),
    )
    return writers.count_table(g.spark, counts)


@query(
    "newest_releases",
    "SELECT id, repository_id, name, tagName, url, createdAt FROM newest_releases",
)
def newest_releases(g):
    return latest.newest_releases(g.releases, 5).drop("__typename")


@query(
    "first_assets",
    "SELECT id, release_id, name, downloadUrl FROM base_release_assets "
    "QUALIFY row_number() OVER (PARTITION BY release_id ORDER BY id) <= 3",
)
def first_assets(g):
    return latest.first_assets(g.assets, 3).drop("__typename")


@query(
    "latest_responses",
    "SELECT event_type AS query_type, user_id::VARCHAR AS repo, event_id::VARCHAR AS response_id FROM events "
    "QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) = 1",
)
def latest_responses(g):
    return latest.latest_responses(g.event_log).select(
        F.col("metadata.queryType").alias("query_type"),
        F.col("metadata.repo").alias("repo"),
        F.col("response.repository.id").alias("response_id"),
    )


@query(
    "latest_stored_responses",
    "SELECT event_type AS query_type, user_id::VARCHAR AS repo, event_id::VARCHAR AS response_id FROM events "
    "QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) = 1",
)
def latest_stored_responses(g):
    """The log stored as columns; responses are read for the newest rows only."""
    path = work_dir(g.spark, "stored-log")
    g.event_log.write.parquet(path)
    return latest.latest_stored_responses(g.spark.read.parquet(path)).select(
        F.col("metadata.queryType").alias("query_type"),
        F.col("metadata.repo").alias("repo"),
        F.col("response.repository.id").alias("response_id"),
    )


@query(
    "response_log_table",
    "SELECT event_type AS query_type, user_id::VARCHAR AS repo, event_id::VARCHAR AS response_id FROM events",
)
def response_log_table(g):
    """The log written as JSON lines, read back, and made a flat table."""
    path = work_dir(g.spark, "log")
    writers.append_responses(g.event_log, path)
    good, _ = readers.split_responses(readers.read_responses(g.spark, path))
    return writers.responses_to_table(good).select(
        "query_type", "repo", F.col("response.repository.id").alias("response_id")
    )


@query(
    "response_tables_by_type",
    "SELECT event_type AS query_type, count(*) AS responses, count(DISTINCT user_id) AS repos, "
    "max(event_id)::BIGINT AS last_id FROM events GROUP BY event_type",
)
def response_tables_by_type(g):
    """The log as one table folder per query type; each type is read from its own folder."""
    path = work_dir(g.spark, "by-type")
    writers.write_response_table(g.event_log, path)
    table = g.spark.read.parquet(path)
    return table.groupBy("query_type").agg(
        F.count("*").alias("responses"),
        F.count_distinct("repo").alias("repos"),
        F.max(F.col("response.repository.id").cast("long")).alias("last_id"),
    )


@query(
    "described_columns",
    "SELECT column_name, column_comment, row_count FROM (VALUES "
    + ", ".join(f"('{c}', '{schemas.COLUMN_COMMENTS[c]}')" for c in ("repository_id", "tagName", "createdAt") if c in schemas.COLUMN_COMMENTS)
    + ") v(column_name, column_comment), (SELECT count(*) AS row_count FROM base_releases)",
)
def described_columns(g):
    """Column descriptions as another reader finds them in the stored files, next to the rows that they describe."""
    path = work_dir(g.spark, "described")
    writers.write_parquet(g.releases, path)
    back = g.spark.read.parquet(path)
    told = [(f.name, f.metadata["comment"]) for f in back.schema.fields if "comment" in f.metadata]
    names = F.explode(
        F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(c).alias("column_comment")) for n, c in told])
    )
    return back.agg(F.count("*").alias("row_count")).select(names.alias("c"), "row_count").select(
        "c.column_name", "c.column_comment", "row_count"
    )


@query(
    "repo_summary_csv",
    "SELECT owner, count(*) AS repos, sum(total_assets)::BIGINT AS assets, "
    "count(*) FILTER (WHERE uses_signer) AS signing FROM agg_repo_summary GROUP BY owner",
)
def repo_summary_csv(g):
    """The repository summary as a CSV file with a header, read back by its column names."""
    path = work_dir(g.spark, "summary-csv")
    writers.write_csv(g.summary, path)
    back = g.spark.read.option("header", True).option("escape", '"').csv(path)
    return back.groupBy("owner").agg(
        F.count("*").alias("repos"),
        F.sum(F.col("total_assets").cast("long")).alias("assets"),
        F.count_if(F.col("uses_signer") == "true").alias("signing"),
    )


@query(
    "run_base_tables",
    "SELECT 'base_repositories' AS table_name, count(*) AS row_count FROM answered UNION ALL "
    "SELECT 'base_security_md', count(*) FROM answered WHERE c_mktsegment = 'BUILDING' UNION ALL "
    "SELECT 'base_si_documents', count(*) FROM answered WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY') UNION ALL "
    "SELECT 'bad_insights', count(*) FROM answered WHERE c_mktsegment = 'BUILDING' UNION ALL "
    "SELECT 'bad_log_lines', 0",
)
def run_base_tables(g):
    """The log as a file of JSON lines, through the run's first half."""
    path = work_dir(g.spark, "run")
    writers.append_responses(g.log, path)
    tables, bad = run.base_tables(g.spark, path)
    names = ["base_repositories", "base_security_md", "base_si_documents"]
    return N.row_counts({n: tables[n] for n in names} | bad)


# Project lists and landscape -------------------------------------------------------

def _targets_sql(where: str, projects: str = "true", plain: bool = True) -> str:
    rich = (
        f"SELECT l.owner, l.name, l.project_name FROM base_cncf_project_repos l "
        f"JOIN base_cncf_projects p USING (project_name) WHERE ({where}) AND ({projects})"
    )
    return rich + (
        " UNION ALL SELECT 'suppliers', s_name, NULL FROM supplier" if plain else ""
    )


def _target_rows(targets):
    return targets.select("owner", "name", F.col("project.project_name").alias("project_name"))


@query("targets_primary", _targets_sql('l."primary"'))
def targets_primary(g):
    return _target_rows(N.explode_targets(g.project_list, "primary"))


@query("targets_all", _targets_sql("true"))
def targets_all(g):
    return _target_rows(N.explode_targets(g.project_list, "all"))


@query(
    "targets_by_maturity",
    _targets_sql("true", "p.maturity IS NULL OR p.maturity IN ('graduated', 'sandbox')"),
)
def targets_by_maturity(g):
    targets = N.explode_targets(g.project_list, "all")
    return _target_rows(N.keep_maturity(targets, ["graduated", "sandbox"]))


@query(
    "last_projects",
    "SELECT project_name, display_name, maturity, category, has_security_audits, security_audit_count "
    "FROM base_cncf_projects",
)
def last_projects(g):
    """Each project listed twice; the second record, with the real name, stays."""
    first = g.project_list.withColumns({"display_name": F.lit("old"), "seq": F.lit(1)})
    both = first.unionByName(g.project_list.withColumn("seq", F.lit(2)))
    return N.projects(both, "seq").select(
        "project_name", "display_name", "maturity", "category", "has_security_audits",
        "security_audit_count",
    )


@query(
    "project_bridge",
    'SELECT project_name, owner, name, "primary", \'main\' AS branch FROM base_cncf_project_repos',
)
def project_bridge(g):
    return N.project_repos(g.project_list.filter("repos IS NOT NULL"))


def _array_files(g, rows, key, purpose, size=200):
    """Rows as files that each hold one JSON array of up to `size` keys in a row."""
    path = work_dir(g.spark, purpose)
    arrays = rows.groupBy(F.floor(F.col(key) / size)).agg(F.collect_list(F.struct(*[c for c in rows.columns if c != key])).alias("rows"))
    arrays.select(F.to_json("rows")).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query(
    "json_array_rows",
    "SELECT c_name AS name, NULL::VARCHAR AS absent, c_mktsegment AS segment, [c_nationkey, c_custkey] AS numbers FROM customer "
    "UNION ALL SELECT s_name, NULL, NULL, NULL FROM supplier",
)
def json_array_rows(g):
    """Files of JSON arrays read with one schema and stacked; fields that a record lacks are NULL."""
    schema = T.StructType.fromDDL("name string, absent string, segment string, numbers array<long>")
    full = g.table("customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.array("c_nationkey", "c_custkey").alias("numbers"),
    )
    bare = g.table("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    read = lambda rows: readers.read_json_array(g.spark, _array_files(g, rows, "key", "json-array"), schema)
    return readers.union_by_name([read(full), read(bare).select("name")])


@query(
    "project_list_targets",
    _targets_sql("true") + " UNION ALL SELECT 'unusable', r_name, NULL FROM region",
)
def project_list_targets(g):
    """The project list from its files, in both shapes, and the entries that are neither."""
    notes = g.table("region").select(F.lit(None).cast("string").alias("owner"), F.col("r_name").alias("name"))
    entries = g.project_list.unionByName(notes, allowMissingColumns=True)
    path = _array_files(g, entries.withColumn("key", F.monotonically_increasing_id()), "key", "project-list")
    usable, rest = readers.split_project_list(readers.read_project_list(g.spark, path))
    odd = rest.select(F.lit("unusable").alias("owner"), "name", F.lit(None).cast("string").alias("project_name"))
    return _target_rows(N.explode_targets(usable, "all")).unionByName(odd)


@query(
    "landscape_files",
    "SELECT replace(s_name, '#', '') AS project_name, 'cat-' || s_nationkey AS category, 'tag1,tag2' AS tag_associations, "
    "s_name AS latest_audit_vendor FROM supplier WHERE s_acctbal > 0",
)
def landscape_files(g):
    """Landscape documents from their YAML files, one file for each supplier."""
    path = work_dir(g.spark, "landscape")
    pad = F.concat(F.lit("# landscape\n"), F.to_json("doc"))
    files = spread(g.landscape.select(pad)).write.option("maxRecordsPerFile", 1).option("lineSep", "\n")
    files.options(**writers.MANY_FILES).text(path)
    items = landscape.landscape_items(readers.read_landscape(g.spark, path).select("doc"))
    return landscape.project_records(items).select(
        "project_name", "category", "tag_associations", "latest_audit_vendor"
    )


_ITEMS = (
    "SELECT *, s_acctbal < 5000 AS own FROM supplier WHERE s_acctbal > 0"
)


@query(
    "landscape_projects",
    "SELECT replace(s_name, '#', '') AS project_name, s_name AS display_name, 'incubating' AS maturity, "
    "'cat-' || s_nationkey AS category, 'sub' AS subcategory, 2 AS security_audit_count, "
    "'2023-01-01' AS latest_audit_date, s_name AS latest_audit_vendor, 'tag1,tag2' AS tag_associations, "
    "CASE WHEN own THEN 'org' || s_nationkey || '/' || s_suppkey || '/true;' ELSE '' END || "
    "'extra/' || s_suppkey || '/false;' AS refs "
    f"FROM ({_ITEMS})",
)
def landscape_projects(g):
    records = landscape.project_records(landscape.landscape_items(g.landscape))
    refs = F.transform(
        "repos",
        lambda r: F.concat(
            r["owner"], F.lit("/"), r["name"], F.lit("/"), r["primary"].cast("string"), F.lit(";")
        ),
    )
    return records.select(
        "project_name", "display_name", "maturity", "category", "subcategory",
        "security_audit_count", "latest_audit_date", "latest_audit_vendor", "tag_associations",
        F.array_join(refs, "").alias("refs"),
    )


@query(
    "landscape_repos_by_maturity",
    "SELECT 'incubating' AS maturity, 'org' || s_nationkey AS owner, s_suppkey::VARCHAR AS name "
    f"FROM ({_ITEMS}) WHERE own",
)
def landscape_repos_by_maturity(g):
    """Written per maturity level and read back."""
    path = work_dir(g.spark, "maturity")
    repos = landscape.repos_by_maturity(landscape.landscape_items(g.landscape))
    landscape.write_repos_by_maturity(repos, path)
    return g.spark.read.schema("owner string, name string, maturity string").json(path)


@query(
    "named_projects",
    "SELECT project_name, category FROM base_cncf_projects WHERE display_name IN "
    "('Project NATION_1-BUILDING', 'Project NATION_2-MACHINERY', 'Project NATION_3-FURNITURE')",
)
def named_projects(g):
    names = [
        "Project NATION_1-BUILDING", "Project NATION_2-MACHINERY", "Project NATION_3-FURNITURE",
    ]
    return landscape.named_projects(g.projects, names).select("project_name", "category")


@query(
    "maturity_spellings",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'graduated' WHEN '2-HIGH' THEN 'incubating' "
    "WHEN '3-MEDIUM' THEN 'incubating' WHEN '5-LOW' THEN 'archived' END AS maturity FROM orders",
)
def maturity_spellings(g):
    spelled = F.expr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Graduated' WHEN '2-HIGH' THEN 'Incubation' "
        "WHEN '3-MEDIUM' THEN 'INCUBATING' WHEN '5-LOW' THEN 'archived' ELSE 'other' END"
    )
    return g.table("orders").select("o_orderkey", V.normal_maturity(spelled).alias("maturity"))


# Line inventories ------------------------------------------------------------------


@query(
    "markdown_headings",
    "SELECT doc_id, (pos - 1)::INT AS ordinal, heading FROM (SELECT doc_id, "
    "unnest(h) AS heading, generate_subscripts(h, 1) AS pos FROM (SELECT doc_id, "
    "regexp_extract_all(replace(text, chr(10), chr(10) || '## '), '(?m)^#+\\s.+') AS h FROM documents))",
)
def markdown_headings(g):
    marked = g.table("documents").select(
        "doc_id", F.replace("text", F.lit("\n"), F.lit("\n## ")).alias("text")
    )
    return inventory.headings(marked, "doc_id", "text")


_LINES = (
    "SELECT doc_id, (pos - 1)::INT AS ordinal, line, regexp_extract(line, '^[A-Z]+') AS instruction FROM ("
    "SELECT doc_id, unnest(h) AS line, generate_subscripts(h, 1) AS pos FROM (SELECT doc_id, "
    "[y FOR y IN [regexp_replace(x, '^\\s+|\\s+$', '', 'g') FOR x IN string_split(text, chr(10))] "
    "IF regexp_matches(y, '^[A-Z]+')] AS h FROM documents))"
)


@query("instruction_lines", _LINES)
def instruction_lines(g):
    return inventory.instructions(g.table("documents"), "doc_id", "text")


@query(
    "instruction_counts",
    f"SELECT instruction, count(*) AS line_count FROM ({_LINES}) GROUP BY instruction",
)
def instruction_counts(g):
    return inventory.instruction_counts(
        inventory.instructions(g.table("documents"), "doc_id", "text")
    )


def _yaml_files(g):
    good = F.concat(
        F.lit("id: "), F.col("doc_id"), F.lit("\nlang: "), F.col("lang"),
        F.lit("\nday: 2024-01-02\nlabels: [a, b]\n"),
    )
    text = F.when(F.col("lang") == "fr", F.lit("id: [1\n")).otherwise(good)
    return g.table("documents").select("doc_id", text.alias("text"))


@query(
    "yaml_documents",
    "SELECT doc_id, doc_id::VARCHAR AS id, lang, '2024-01-02' AS day, 'b' AS second_label FROM documents "
    "WHERE lang <> 'fr'",
)
def yaml_documents(g):
    good, _ = inventory.land_yaml(_yaml_files(g), "doc_id", "text")
    get = lambda p: F.get_json_object("document", p)
    return good.select(
        "doc_id", get("$.id").alias("id"), get("$.lang").alias("lang"), get("$.day").alias("day"),
        get("$.labels[1]").alias("second_label"),
    )


@query(
    "yaml_bad_rows",
    "SELECT doc_id, 'id: [1' || chr(10) AS content FROM documents WHERE lang = 'fr'",
)
def yaml_bad_rows(g):
    _, bad = inventory.land_yaml(_yaml_files(g), "doc_id", "text")
    return bad


@query(
    "url_parts",
    "SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS lang, "
    "split_part(url, '/', 9) AS beyond FROM pages",
)
def url_parts(g):
    url = F.col("url")
    return g.table("pages").select(
        "page_id",
        V.url_part(url, 3).alias("host"),
        V.url_part(url, 4).alias("lang"),
        V.url_part(url, 9).alias("beyond"),
    )


# Sources and sinks -------------------------------------------------------------------


@query(
    "row_and_unique_counts",
    "SELECT count(*) AS row_count, count(DISTINCT l_orderkey || '/' || l_linenumber) AS unique_count FROM lineitem",
)
def row_and_unique_counts(g):
    frame = readers.read_table_view(g.spark, f"{g.folder}/lineitem.parquet", "given_lineitem")
    return readers.row_and_unique_counts(frame, ["l_orderkey", "l_linenumber"])


@query(
    "union_by_name",
    "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier",
)
def union_by_name(g):
    first = g.table("customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    second = g.table("supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return readers.union_by_name([first, second])


@query(
    "wide_artifact_export",
    "SELECT r.id AS repository_id, r.nameWithOwner, r.url AS repository_url, r.description, l.id AS release_id, "
    "l.name AS release_name, l.tagName, l.createdAt, a.id AS artifact_id, a.name AS artifact_name, "
    "a.downloadUrl AS artifact_url FROM base_repositories r LEFT JOIN base_releases l ON l.repository_id = r.id "
    "LEFT JOIN base_release_assets a ON a.release_id = l.id",
)
def wide_artifact_export(g):
    return writers.wide_artifact_export(g.repositories, g.releases, g.assets)


@query(
    "csv_round_trip",
    "SELECT split_part(source_url, '/', 4) AS owner, count(*) AS sboms, "
    f"count(DISTINCT sbom_url) AS urls FROM ({_SBOMS}) GROUP BY 1",
)
def csv_round_trip(g):
    path = work_dir(g.spark, "csv")
    frame = writers.sbom_export(insights.sboms(g.documents))
    writers.write_csv(frame, path)
    # Everything comes back as text from a flat file.
    schema = ", ".join(f"{c} string" for c in frame.columns)
    back = g.spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return back.groupBy("owner").agg(
        F.count("*").alias("sboms"), F.count_distinct("sbom_url").alias("urls")
    )


@query(
    "parquet_round_trip",
    "SELECT repository_id, count(*) AS releases, max(tagName) AS last_tag FROM base_releases GROUP BY repository_id",
)
def parquet_round_trip(g):
    path = work_dir(g.spark, "parquet")
    writers.write_parquet(g.releases, path)
    return (
        g.spark.read.parquet(path)
        .groupBy("repository_id")
        .agg(F.count("*").alias("releases"), F.max("tagName").alias("last_tag"))
    )


@query(
    "current_run",
    "SELECT id, nameWithOwner FROM base_repositories WHERE nameWithOwner IS NOT NULL",
)
def current_run(g):
    """Two dated runs of one table; only the newest is read."""
    root = work_dir(g.spark, "runs")
    old = g.repositories.withColumn("nameWithOwner", F.lit("old"))
    writers.write_run({"base_repositories": old}, root, "2024-01-01T00-00-00")
    writers.write_run({"base_repositories": g.repositories}, root, "2024-02-01T00-00-00")
    return readers.current_run(g.spark, root, "base_repositories").select("id", "nameWithOwner")


@query(
    "combined_runs",
    "SELECT maturity, count(*) AS projects FROM base_cncf_projects WHERE maturity IS NOT NULL GROUP BY maturity",
)
def combined_runs(g):
    """One run folder per maturity level, read together again."""
    root = work_dir(g.spark, "maturity-runs")
    writers.write_parquet(
        g.projects.filter("maturity IS NOT NULL").withColumn("level", F.col("maturity")),
        root,
        ["level"],
    )
    runs = readers.read_runs(g.spark, f"{root}/level=*")
    return runs.groupBy("maturity").agg(F.count("*").alias("projects"))


@query(
    "count_where",
    "SELECT count(*) AS row_count FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 10",
)
def count_where(g):
    return writers.count_where(
        g.spark, f"{g.folder}/lineitem.parquet", "l_returnflag = 'A' AND l_quantity > 10"
    )


@query(
    "text_file_names",
    "SELECT split_part(nameWithOwner, '/', 1) AS owner, split_part(nameWithOwner, '/', 1) || '__' || "
    "replace(r.name, '#', '_') || '__workflows__' || filename AS safe_name, content FROM event_workflows w "
    "JOIN base_repositories r ON w.repository_id = r.id UNION ALL "
    "SELECT split_part(nameWithOwner, '/', 1), split_part(nameWithOwner, '/', 1) || '__' || "
    "replace(r.name, '#', '_') || '__docs__' || source || '.txt', text FROM documents "
    "JOIN base_repositories r ON 'R' || doc_id = r.id WHERE text <> ''",
)
def text_file_names(g):
    docs = g.table("documents").select(
        F.concat(F.lit("R"), F.col("doc_id")).alias("repository_id"),
        F.concat(F.lit("docs/"), F.col("source"), F.lit(".txt")).alias("path"),
        F.col("text").alias("content"),
    )
    return writers.text_files(g.repositories, g.event_workflows, docs)


@query(
    "text_files_by_owner",
    "SELECT split_part(nameWithOwner, '/', 1) AS owner, count(*) AS files, sum(length(content))::BIGINT AS characters "
    "FROM event_workflows w JOIN base_repositories r ON w.repository_id = r.id GROUP BY 1",
)
def text_files_by_owner(g):
    """Workflow texts written under their safe names, one folder per owner, and read back."""
    path = work_dir(g.spark, "files")
    none = g.security_md.filter("false").select("repository_id", "path", "content")
    writers.write_text_files(writers.text_files(g.repositories, g.event_workflows, none), path)
    back = g.spark.read.schema("safe_name string, content string, owner string").parquet(path)
    return back.groupBy("owner").agg(
        F.count("safe_name").alias("files"), F.sum(F.length("content")).alias("characters")
    )


@query(
    "table_profile",
    "SELECT 'base_release_assets' AS table_name, count(*) AS row_count, 5 AS column_count, "
    "'id string, __typename string, release_id string, name string, downloadUrl string' AS columns FROM lineitem UNION ALL "
    "SELECT 'base_releases', count(*), 7, 'id string, __typename string, repository_id string, name string, "
    "tagName string, url string, createdAt timestamp_ntz' FROM orders UNION ALL "
    "SELECT 'base_repositories', count(*), 11, 'id string, __typename string, name string, nameWithOwner string, "
    "url string, description string, hasVulnerabilityAlertsEnabled boolean, license_key string, license_name string, "
    "license_spdxId string, defaultBranch_name string' FROM base_repositories",
)
def table_profile(g):
    tables = {
        "base_release_assets": g.assets,
        "base_releases": g.releases,
        "base_repositories": g.repositories,
    }
    return writers.table_profile(tables)


@query(
    "nested_as_text",
    "SELECT l.id AS release_id, count(*) AS assets FROM answered JOIN base_releases l ON l.repository_id = repo_id "
    "JOIN base_release_assets a ON a.release_id = l.id GROUP BY l.id",
)
def nested_as_text(g):
    """Responses with nested parts as JSON text, counted from that text."""
    release = F.col("response.repository.releases.nodes")[0]
    flat = writers.encode_nested(
        g.release_log.select(
            release["id"].alias("release_id"), release["releaseAssets"]["nodes"].alias("nodes")
        ).filter("nodes IS NOT NULL")
    )
    ids = F.from_json("nodes", "array<struct<id:string>>")
    present = F.filter(ids, lambda n: n["id"].isNotNull())
    return flat.select("release_id", F.size(present).cast("bigint").alias("assets"))


@query(
    "responses_by_repo",
    "SELECT user_id::VARCHAR AS repo, count(*) AS responses, max(event_id) AS last_id FROM events GROUP BY user_id",
)
def responses_by_repo(g):
    """One folder per repository, read back with the folder names."""
    path = work_dir(g.spark, "by-repo")
    writers.write_responses_by_repo(g.event_log, path)
    back = readers.read_responses_by_repo(g.spark, path, schemas.RESPONSE_LOG["response"].dataType)
    return back.groupBy("repo").agg(
        F.count("*").alias("responses"),
        F.max(F.col("response.repository.id").cast("bigint")).alias("last_id"),
    )


@query(
    "saved_sql",
    "SELECT uses_signer, count(*) AS repos, sum(total_releases)::BIGINT AS releases FROM agg_repo_summary "
    "WHERE total_releases >= 2 GROUP BY uses_signer",
)
def saved_sql(g):
    """A statement read from its file, with a value for its parameter."""
    path = f"{models.SAVED}/signer_adoption.sql"
    return writers.run_sql_file(g.spark, path, {"agg_repo_summary": g.summary}, {"min_releases": 2})


@query(
    "saved_models",
    "SELECT 'signer_adoption' AS model, false AS left_out, uses_signer::VARCHAR AS name, count(*) AS value "
    "FROM agg_repo_summary WHERE total_releases >= 1 GROUP BY uses_signer UNION ALL "
    "SELECT 'project_audits', false, project_name, security_audit_count FROM base_cncf_projects "
    "WHERE security_audit_count >= 1 AND maturity = 'graduated' UNION ALL "
    "SELECT 'scorecard_checks', true, NULL, NULL",
)
def saved_models(g):
    """Saved statements as models with parameters; the one whose input is missing is left out and the others run."""
    listed = [
        models.saved_model("scorecard_checks", ("base_scorecard_checks",)),
        models.saved_model("signer_adoption", ("agg_repo_summary",), args={"min_releases": 1}),
        models.saved_model(
            "project_audits", ("base_cncf_projects",), args={"min_audits": 1, "maturity": "graduated"}
        ),
    ]
    given = {"agg_repo_summary": g.summary, "base_cncf_projects": g.projects}
    tables, left_out = models.run_models(given, work_dir(g.spark, "saved"), listed)
    row = lambda frame, model, name, value: frame.select(
        F.lit(model).alias("model"), F.lit(False).alias("left_out"),
        F.col(name).cast("string").alias("name"), F.col(value).cast("long").alias("value"),
    )
    return (
        row(tables["signer_adoption"], "signer_adoption", "uses_signer", "repos")
        .unionByName(row(tables["project_audits"], "project_audits", "project_name", "security_audit_count"))
        .unionByName(
            g.spark.createDataFrame(
                [(name, True, None, None) for name in left_out],
                "model string, left_out boolean, name string, value long",
            )
        )
    )


@query(
    "empty_inputs",
    "SELECT 'agg_artifact_patterns' AS table_name, count(*) AS row_count FROM agg_artifact_patterns UNION ALL "
    "SELECT 'agg_repo_summary', count(*) FROM base_repositories UNION ALL SELECT 'agg_workflow_tools', 0 UNION ALL "
    "SELECT 'agg_si_attestations', 0 UNION ALL SELECT 'agg_cncf_project_summary', 0",
)
def empty_inputs(g):
    """Models over three given tables; the inputs that are not there are empty tables of their types."""
    given = {
        "base_repositories": g.repositories, "base_releases": g.releases, "base_release_assets": g.assets,
    }
    tables, _ = models.run_models(
        models.with_empty_inputs(g.spark, given), work_dir(g.spark, "models")
    )
    names = [
        "agg_artifact_patterns", "agg_repo_summary", "agg_workflow_tools", "agg_si_attestations",
        "agg_cncf_project_summary",
    ]
    return N.row_counts({name: tables[name] for name in names})


@query(
    "dropped_tables",
    "SELECT 'agg_patterns_copy' AS table_name, false AS there, NULL::BIGINT AS row_count UNION ALL "
    "SELECT 'agg_summary_view', false, NULL UNION ALL SELECT 'base_releases_copy', true, count(*) FROM base_releases",
)
def dropped_tables(g):
    """A stored table and a view of one prefix dropped; a table of another prefix stays."""
    mark = F.lit(None).cast("long").alias("row_count")
    prefix = f"run{uuid.uuid4().hex}_"
    made = {"agg_patterns_copy": g.patterns, "base_releases_copy": g.releases}
    for name, frame in made.items():
        frame.write.option("path", work_dir(g.spark, name)).saveAsTable(prefix + name)
    g.projects.createOrReplaceTempView(f"{prefix}agg_summary_view")
    gone = writers.drop_tables(g.spark, f"{prefix}agg_")
    left = g.spark.table(f"{prefix}base_releases_copy")
    out = left.agg(F.count("*").alias("row_count")).select(
        F.lit("base_releases_copy").alias("table_name"), F.lit(True).alias("there"), "row_count"
    )
    for name in gone:
        out = out.unionByName(
            g.spark.range(1).select(
                F.lit(name.removeprefix(prefix)).alias("table_name"),
                F.lit(g.spark.catalog.tableExists(name)).alias("there"), mark,
            )
        )
    return out


# Streams ---------------------------------------------------------------------------------


def _event_stream(g):
    """The events as a stream; a pattern takes a table of one file as well as one of many."""
    schema = g.table("events").schema
    return g.spark.readStream.schema(schema).parquet(f"{g.folder}/events.parque[t]")


@query(
    "stream_log_ingest",
    "SELECT event_type AS query_type, user_id::VARCHAR AS repo, event_id::VARCHAR AS response_id FROM events",
)
def stream_log_ingest(g):
    """A JSON-lines log taken in as a stream, one Parquet table out."""
    source, sink = work_dir(g.spark, "log"), work_dir(g.spark, "log-table")
    writers.append_responses(g.event_log, source)
    table = writers.responses_to_table(ingest.stream_responses(g.spark, source))
    ingest.run_to_table(table, sink)
    return g.spark.read.parquet(sink).select(
        "query_type", "repo", F.col("response.repository.id").alias("response_id")
    )


@query("stream_without_repeats", "SELECT event_id, user_id, event_type FROM events")
def stream_without_repeats(g):
    """Every event arrives twice and is kept once."""
    events = _event_stream(g)
    sink = work_dir(g.spark, "distinct")
    kept = ingest.drop_repeats(events.union(events), ["event_id"])
    ingest.run_to_table(kept.select("event_id", "user_id", "event_type"), sink)
    return g.spark.read.parquet(sink)


@query(
    "stream_log_without_repeats",
    "SELECT event_type AS query_type, 'org' AS owner, user_id::VARCHAR AS repo, "
    "strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*)::BIGINT AS records FROM events GROUP BY ALL",
)
def stream_log_without_repeats(g):
    """The log in several batches: its newer half, all of it in four parts, and the older half again, which is long past by
    then. Every record stays once by query type, repository and time, none for being late."""
    source, sink = work_dir(g.spark, "log"), work_dir(g.spark, "log-once")
    middle = g.event_log.agg(F.percentile_approx(F.col("metadata.timestamp").cast("timestamp").cast("double"), 0.5)).scalar()
    at = F.col("metadata.timestamp").cast("timestamp").cast("double")
    writers.append_responses(g.event_log.filter(at > middle), source)
    writers.append_responses(g.event_log.repartition(4), source)
    writers.append_responses(g.event_log.filter(at <= middle), source)
    stream = ingest.with_event_time(ingest.stream_responses(g.spark, source, 2))
    ingest.run_to_table(ingest.drop_repeats(stream, [*ingest.LOG_KEYS, "ts"]), sink)
    return (
        g.spark.read.parquet(sink)
        .groupBy(
            F.col("queryType").alias("query_type"), "owner", "repo", F.date_format("ts", "yyyy-MM-dd").alias("day")
        )
        .agg(F.count("*").alias("records"))
    )


@query(
    "stream_latest_snapshot",
    "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def stream_latest_snapshot(g):
    snapshot = ingest.LatestSnapshot(
        work_dir(g.spark, "snapshot"), ["user_id", "event_type"], ["ts", "event_id"]
    )
    return snapshot.run(_event_stream(g)).select("user_id", "event_type", "event_id", "value")


@query(
    "stream_tools",
    tool_union("event_workflows", "id AS workflow_id, repository_id", "content"),
)
def stream_tools(g):
    """Tool detection on the stream of workflows, as in batch."""
    from workload.given import Given

    streamed = Given(g.spark, g.folder)
    streamed.table = lambda name: _event_stream(g)
    flows = streamed.event_workflows.select(
        F.col("id").alias("workflow_id"), "repository_id", "content"
    )
    sink = work_dir(g.spark, "stream-tools")
    ingest.run_to_table(detect_tools(flows, "content"), sink)
    return g.spark.read.parquet(sink)
