"""Nested responses and project lists to relational base tables.

Every step here is a projection, filter or generator: no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry import schemas
from attestry.functions import values as V
from attestry.functions.yamljson import spread, yaml_to_json

EXTENDED = "GetRepoDataExtendedInfo"
LEGACY = "GetRepoDataArtifacts"

RULE_COLUMNS = [field.name for field in schemas.RULE_FIELDS]

# Repository files asked for by path (path, type, response field).
REPO_FILES = [
    ("SECURITY.md", "markdown", "securityPolicy"),
    ("SECURITY-INSIGHTS.yml", "yml", "insightsFileRootUpper"),
    ("security-insights.yml", "yml", "insightsFileRootLower"),
    (".github/SECURITY-INSIGHTS.yml", "yml", "insightsFileGithubUpper"),
    (".github/security-insights.yml", "yml", "insightsFileGithubLower"),
    (".github/dependabot.yml", "yml", "dependabot"),
]
# Insight file variants in order of preference.
INSIGHT_FILES = [(p, f) for p, _, f in REPO_FILES if f.startswith("insights")]


def _repos(responses: DataFrame) -> DataFrame:
    return responses.select(F.col("response.repository").alias("r")).filter(F.col("r").isNotNull())


def _typename(value: Column, default: str) -> Column:
    return V.first_filled(value, F.lit(default)).alias("__typename")


def _present(nodes: Column) -> Column:
    return F.filter(nodes, lambda n: n.isNotNull())


def repositories(responses: DataFrame) -> DataFrame:
    """One row per response with a repository; licence and branch flattened."""
    return _repos(responses).select(
        F.col("r.id").alias("id"),
        _typename(F.col("r.__typename"), "Repository"),
        F.col("r.name").alias("name"),
        F.col("r.nameWithOwner").alias("nameWithOwner"),
        F.col("r.url").alias("url"),
        F.col("r.description").alias("description"),
        F.col("r.hasVulnerabilityAlertsEnabled").alias("hasVulnerabilityAlertsEnabled"),
        V.blank_to_null(F.col("r.licenseInfo.key")).alias("license_key"),
        V.blank_to_null(F.col("r.licenseInfo.name")).alias("license_name"),
        V.blank_to_null(F.col("r.licenseInfo.spdxId")).alias("license_spdxId"),
        V.blank_to_null(F.col("r.defaultBranchRef.name")).alias("defaultBranch_name"),
    )


def legacy_repositories(responses: DataFrame) -> DataFrame:
    """The short form kept by the older query: identity only."""
    return _repos(responses).select(
        F.col("r.id").alias("id"),
        F.col("r.name").alias("name"),
        F.col("r.nameWithOwner").alias("nameWithOwner"),
    )


def branch_protection_rules(responses: DataFrame) -> DataFrame:
    """The default branch's rule and the numbered further rules of a repository.

    The number counts the rules left after NULL entries are dropped.
    """
    per_repo = _repos(responses).select(
        F.col("r.id").alias("repository_id"),
        F.col("r.defaultBranchRef.branchProtectionRule").alias("default_rule"),
        _present(F.col("r.branchProtectionRules.nodes")).alias("further"),
    )

    def columns(rule_id: Column, is_default: bool) -> list[Column]:
        return [
            rule_id.alias("id"),
            _typename(F.col("rule.__typename"), "BranchProtectionRule"),
            F.col("repository_id"),
            *[F.col(f"rule.{c}").alias(c) for c in RULE_COLUMNS],
            F.lit(is_default).alias("isDefaultBranch"),
        ]

    default = (
        per_repo.filter(F.col("default_rule").isNotNull())
        .withColumn("rule", F.col("default_rule"))
        .select(*columns(F.concat("repository_id", F.lit("_default")), True))
    )
    further = per_repo.select("repository_id", F.posexplode("further").alias("pos", "rule")).select(
        *columns(F.concat(F.col("repository_id"), F.lit("_rule_"), F.col("pos")), False)
    )
    return default.unionByName(further)


def _release_nodes(responses: DataFrame) -> DataFrame:
    return _repos(responses).select(
        F.col("r.id").alias("repository_id"),
        F.explode(_present(F.col("r.releases.nodes"))).alias("rel"),
    )


def releases(responses: DataFrame, legacy: bool = False) -> DataFrame:
    """One row per release; the older query's absent names become ''."""
    name = F.col("rel.name")
    return _release_nodes(responses).select(
        F.col("rel.id").alias("id"),
        _typename(F.col("rel.__typename"), "Release"),
        F.col("repository_id"),
        (F.coalesce(name, F.lit("")) if legacy else name).alias("name"),
        F.col("rel.tagName").alias("tagName"),
        F.col("rel.url").alias("url"),
        F.try_to_timestamp(F.col("rel.createdAt")).alias("createdAt"),
    )


def release_assets(responses: DataFrame) -> DataFrame:
    """One row per release artifact."""
    return (
        _release_nodes(responses)
        .select(
            F.col("rel.id").alias("release_id"),
            F.explode(_present(F.col("rel.releaseAssets.nodes"))).alias("a"),
        )
        .select(
            F.col("a.id").alias("id"),
            _typename(F.col("a.__typename"), "ReleaseAsset"),
            F.col("release_id"),
            F.col("a.name").alias("name"),
            F.col("a.downloadUrl").alias("downloadUrl"),
        )
    )


def _workflow_entries(responses: DataFrame) -> DataFrame:
    return (
        _repos(responses)
        .filter(F.col("r.workflows.__typename") == "Tree")
        .select(F.col("r.id").alias("repository_id"), F.explode("r.workflows.entries").alias("e"))
        .filter(F.col("e.object.__typename") == "Blob")
    )


def workflows(responses: DataFrame) -> DataFrame:
    """One row per workflow file (entries that are folders are left out)."""
    return _workflow_entries(responses).select(
        F.concat_ws("_", "repository_id", "e.name").alias("id"),
        F.lit("WorkflowFile").alias("__typename"),
        F.col("repository_id"),
        F.col("e.name").alias("filename"),
        F.col("e.object.text").alias("content"),
    )


def security_policies(responses: DataFrame) -> DataFrame:
    """One row per repository with a security policy text."""
    return (
        _repos(responses)
        .filter(
            (F.col("r.securityPolicy.__typename") == "Blob")
            & V.blank_to_null(F.col("r.securityPolicy.text")).isNotNull()
        )
        .select(
            F.concat(F.col("r.id"), F.lit(":SECURITY.md")).alias("id"),
            F.lit("SecurityMarkdown").alias("__typename"),
            F.col("r.id").alias("repository_id"),
            F.lit("SECURITY.md").alias("path"),
            F.col("r.securityPolicy.text").alias("content"),
        )
    )


def repo_files(responses: DataFrame) -> DataFrame:
    """The known files of a repository and its workflows, one row per file."""
    fixed = _repos(responses).select(
        F.col("r.id").alias("repository_id"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(path).alias("path"),
                        F.lit(kind).alias("type"),
                        F.col(f"r.{field}.__typename").alias("node"),
                        F.col(f"r.{field}.text").alias("content"),
                    )
                    for path, kind, field in REPO_FILES
                ]
            )
        ).alias("f"),
    ).select("repository_id", "f.path", "f.type", "f.node", "f.content")
    path = F.concat(F.lit(".github/workflows/"), F.col("e.name"))
    flows = _workflow_entries(responses).select(
        "repository_id",
        path.alias("path"),
        F.when(F.col("e.name").rlike(r"\.(yml|yaml)$"), "yml").otherwise("text").alias("type"),
        F.col("e.object.__typename").alias("node"),
        F.col("e.object.text").alias("content"),
    )
    return (
        fixed.unionByName(flows)
        .filter(
            (F.col("node") == "Blob") & V.blank_to_null(F.col("content")).isNotNull()
        )
        .select(
            F.concat_ws(":", "repository_id", "path").alias("id"),
            "repository_id",
            "path",
            "type",
            "content",
        )
    )


def with_parsed_content(files: DataFrame) -> DataFrame:
    """Repository files with what their kind holds: a YAML file its document as a VARIANT, Markdown its headings.

    ``parsed_json`` is NULL for other kinds and for YAML that does not parse; ``markdown_headings`` is NULL for other kinds.
    """
    kind, content = F.col("type"), F.col("content")
    return spread(files).withColumns(
        {
            "parsed_json": F.try_parse_json(yaml_to_json(F.when(kind == "yml", content))),
            "markdown_headings": F.when(
                kind == "markdown", F.regexp_extract_all(content, F.lit(r"(?m)^#+\s.+"), F.lit(0))
            ),
        }
    )


def insight_texts(responses: DataFrame) -> DataFrame:
    """The first insight file found per repository, with its web address."""
    found = F.coalesce(
        *[
            F.when(
                (F.col(f"r.{field}.__typename") == "Blob")
                & V.blank_to_null(F.col(f"r.{field}.text")).isNotNull(),
                F.struct(F.lit(path).alias("path"), F.col(f"r.{field}.text").alias("text")),
            )
            for path, field in INSIGHT_FILES
        ]
    )
    return (
        _repos(responses)
        .select(F.col("r.id").alias("repo_id"), F.col("r.nameWithOwner"), found.alias("f"))
        .filter(F.col("f").isNotNull())
        .select(
            "repo_id",
            F.concat(
                F.lit("https://github.com/"),
                F.col("nameWithOwner"),
                F.lit("/blob/HEAD/"),
                F.col("f.path"),
            ).alias("source_url"),
            F.col("f.path").alias("path"),
            F.col("f.text").alias("content"),
        )
    )


def schema_version(document: Column) -> Column:
    """Version named in the header, in either spelling, else ``unknown``."""
    return V.first_filled(
        F.get_json_object(document, "$.header.schema-version"),
        F.get_json_object(document, "$.header.schemaVersion"),
        F.lit("unknown"),
    )


def land_insights(texts: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """YAML insight texts as JSON documents; ``document`` is NULL on bad YAML."""
    when = F.current_timestamp() if fetched_at is None else fetched_at
    return spread(texts.select("repo_id", "source_url", "content")).select(
        "repo_id",
        "source_url",
        yaml_to_json(F.col("content")).alias("document"),
        when.alias("fetched_at"),
        "content",
    )


def split_insights(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed documents and the bad rows with their text."""
    good = landed.filter(F.col("document").isNotNull()).select(
        "repo_id",
        "source_url",
        schema_version(F.col("document")).alias("schema_version"),
        "document",
        "fetched_at",
    )
    bad = landed.filter(F.col("document").isNull()).select("repo_id", "source_url", "content")
    return good, bad


def insight_version_classes(documents: DataFrame) -> DataFrame:
    """Documents per major version: v1, v2, other, unknown."""
    major = F.split_part(F.col("schema_version"), F.lit("."), F.lit(1))
    label = (
        F.when(F.coalesce(F.col("schema_version"), F.lit("unknown")) == "unknown", "unknown")
        .when(major == "1", "v1")
        .when(major == "2", "v2")
        .otherwise("other")
    )
    return documents.groupBy(label.alias("version_class")).agg(
        F.count("*").alias("document_count")
    )


# Project lists ---------------------------------------------------------------


def explode_targets(entries: DataFrame, scope: str = "primary") -> DataFrame:
    """One row per repository to look at, with its project record if there is one."""
    if scope not in ("primary", "all"):
        raise ValueError(f"unknown repository scope: {scope}")
    listed = F.col("repos").isNotNull()
    wanted = F.filter(
        F.col("repos"), lambda r: r["primary"] if scope == "primary" else r.isNotNull()
    )
    own = F.array(
        F.struct(
            F.col("owner"),
            F.col("name"),
            F.lit(None).cast("boolean").alias("primary"),
            F.lit(None).cast("string").alias("branch"),
        )
    )
    project = F.when(listed, F.struct(*schemas.PROJECT_COLUMNS, "repos"))
    return entries.select(
        F.explode(F.when(listed, wanted).otherwise(own)).alias("t"), project.alias("project")
    ).select("t.owner", "t.name", "project")


def keep_maturity(targets: DataFrame, levels: list[str] | None) -> DataFrame:
    """Keep the given maturity levels; targets without a level always stay."""
    if not levels:
        return targets
    level = V.blank_to_null(F.col("project.maturity"))
    return targets.filter(level.isNull() | level.isin(levels))


def projects(entries: DataFrame, sequence: str) -> DataFrame:
    """One record per project name, the last in sequence, without its repositories."""
    from attestry.operators.latest import last_project_records

    rich = entries.filter(F.col("repos").isNotNull() & F.col("project_name").isNotNull())
    return last_project_records(rich.select(*schemas.PROJECT_COLUMNS, "repos", sequence), sequence)


def project_repos(project_records: DataFrame) -> DataFrame:
    """Bridge rows of project and repository."""
    return project_records.select("project_name", F.explode("repos").alias("r")).select(
        "project_name", "r.owner", "r.name", "r.primary", "r.branch"
    )


# Dispatch --------------------------------------------------------------------

Normaliser = Callable[[DataFrame], dict[str, DataFrame]]


def normalise_extended(responses: DataFrame) -> dict[str, DataFrame]:
    return {
        "base_repositories": repositories(responses),
        "base_branch_protection_rules": branch_protection_rules(responses),
        "base_releases": releases(responses),
        "base_release_assets": release_assets(responses),
        "base_workflows": workflows(responses),
        "base_security_md": security_policies(responses),
        "base_repo_files": repo_files(responses),
    }


def normalise_legacy(responses: DataFrame) -> dict[str, DataFrame]:
    return {
        "base_repositories": legacy_repositories(responses),
        "base_releases": releases(responses, legacy=True),
        "base_release_assets": release_assets(responses),
    }


NORMALISERS: dict[str, Normaliser] = {EXTENDED: normalise_extended, LEGACY: normalise_legacy}


def register_normaliser(query_type: str, normaliser: Normaliser) -> None:
    """Add or replace the normaliser of one query type."""
    NORMALISERS[query_type] = normaliser


def normalise(log: DataFrame) -> dict[str, DataFrame]:
    """Base tables of a mixed response log, routed by each record's query type."""
    merged: dict[str, DataFrame] = {}
    for query_type, normaliser in NORMALISERS.items():
        part = log.filter(F.col("metadata.queryType") == query_type)
        for name, frame in normaliser(part).items():
            known = merged.get(name)
            merged[name] = (
                frame if known is None else known.unionByName(frame, allowMissingColumns=True)
            )
    for name, frame in merged.items():
        if name in schemas.TABLES:
            fields = schemas.TABLES[name].fields
            have = set(frame.columns)
            merged[name] = frame.select(
                *[
                    F.col(f.name) if f.name in have
                    else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in fields
                ]
            )
    return merged


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, by a scan of each; tables that are being written are counted by ``writers.write_all``."""
    parts = [
        frame.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, frame in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
