"""Explicit schemas of every input and base table (no inference at scale)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


BOOL, INT, STAMP = T.BooleanType(), T.IntegerType(), T.TimestampType()


def record(*parts: str | tuple[str, T.DataType]) -> T.StructType:
    """A struct type. A plain text names string fields; a pair has its type."""
    fields = []
    for part in parts:
        if isinstance(part, str):
            fields += [T.StructField(name, T.StringType()) for name in part.split()]
        else:
            fields += [T.StructField(name, part[1]) for name in part[0].split()]
    return T.StructType(fields)


def listed(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


RULE_FIELDS = record(
    (
        "allowsDeletions allowsForcePushes dismissesStaleReviews isAdminEnforced "
        "requiresStatusChecks requiresStrictStatusChecks requiresCodeOwnerReviews",
        BOOL,
    ),
    ("requiredApprovingReviewCount", INT),
    "pattern",
).fields
_RULE = T.StructType([T.StructField("__typename", T.StringType()), *RULE_FIELDS])
_BLOB = record("__typename id text")
_ASSET = record("__typename id name downloadUrl")
_RELEASE = record(
    "__typename id name tagName url createdAt",
    ("releaseAssets", record(("nodes", listed(_ASSET)))),
)
_ENTRY = record("name", ("object", _BLOB))
_REPOSITORY = record(
    "__typename id name nameWithOwner url description",
    ("hasVulnerabilityAlertsEnabled", BOOL),
    ("licenseInfo", record("key name spdxId")),
    ("defaultBranchRef", record("name", ("branchProtectionRule", _RULE))),
    ("branchProtectionRules", record(("nodes", listed(_RULE)))),
    ("releases", record(("nodes", listed(_RELEASE)))),
    ("workflows", record("__typename", ("entries", listed(_ENTRY)))),
    (
        "securityPolicy dependabot insightsFileRootUpper insightsFileRootLower "
        "insightsFileGithubUpper insightsFileGithubLower",
        _BLOB,
    ),
)

#: One line of the raw response log.
RESPONSE_LOG = record(
    ("metadata", record("queryType timestamp owner repo", ("inputs", record("owner name")))),
    ("response", record(("repository", _REPOSITORY))),
)

_PROJECT_FIELDS = record(
    "project_name display_name description maturity category subcategory date_accepted "
    "date_incubating date_graduated date_archived homepage_url repo_url package_manager_url "
    "docker_url documentation_url blog_url url_for_bestpractices clomonitor_name "
    "summary_business_use_case summary_integrations summary_personas summary_tags "
    "summary_use_case summary_release_rate dev_stats_url",
    ("has_security_audits", BOOL),
    ("security_audit_count", INT),
    "latest_audit_date latest_audit_vendor crunchbase twitter parent_project tag_associations "
    "annual_review_date annual_review_url license default_branch",
).fields
_REPO_REF = record("owner name", ("primary", BOOL), "branch")

#: A project list: both the simple ``{owner,name}`` and the rich shape.
PROJECT_LIST = T.StructType(
    [*record("owner name").fields, *_PROJECT_FIELDS, *record(("repos", listed(_REPO_REF))).fields]
)

_EXTRA = record(
    "accepted incubating graduated archived package_manager_url docker_url documentation_url "
    "blog_url clomonitor_name summary_business_use_case summary_integrations summary_integration "
    "summary_personas summary_tags summary_use_case summary_release_rate dev_stats_url",
    ("audits", listed(record("date vendor"))),
    "parent_project",
    ("tag", listed(T.StringType())),
    "annual_review_date annual_review_url",
)
_ITEM = record(
    "name description project repo_url branch homepage_url docker_url url_for_bestpractices "
    "crunchbase twitter license",
    ("additional_repos", listed(record("repo_url branch"))),
    ("extra", _EXTRA),
)
_CATEGORY = record(
    "name", ("subcategories", listed(record("name", ("items", listed(_ITEM)))))
)

#: A landscape document, under either of its two root keys.
LANDSCAPE = record(("landscape categories", listed(_CATEGORY)))

#: An insight document. Lists stay arrays of raw JSON text so that one odd
#: element does not void its neighbours; a value that is no list reads as NULL.
_TEXTS = listed(T.StringType())
INSIGHTS = record(
    ("header", record("schema-version last-updated")),
    ("project", record("name")),
    (
        "repository",
        record(
            "url",
            ("release", record(("attestations", _TEXTS), ("dependencies", record(("sbom", _TEXTS))))),
            ("security", record(("tools", _TEXTS))),
        ),
    ),
    ("attestations", _TEXTS),
    ("security-artifacts", record(("attestations", _TEXTS))),
    ("dependencies", record(("sbom", _TEXTS))),
)
INSIGHT_TOOL = record(("results", record("adhoc ci release")))
ATTESTATION = record("name location predicate-uri comment")
SBOM_ENTRY = record("sbom-format sbom-url sbom-file comment")

#: Base tables.
TABLES: dict[str, T.StructType] = {
    "base_repositories": record(
        "id __typename name nameWithOwner url description",
        ("hasVulnerabilityAlertsEnabled", BOOL),
        "license_key license_name license_spdxId defaultBranch_name",
    ),
    "base_branch_protection_rules": T.StructType(
        [
            *record("id __typename repository_id").fields,
            *RULE_FIELDS,
            T.StructField("isDefaultBranch", BOOL),
        ]
    ),
    "base_releases": record("id __typename repository_id name tagName url", ("createdAt", STAMP)),
    "base_release_assets": record("id __typename release_id name downloadUrl"),
    "base_workflows": record("id __typename repository_id filename content"),
    "base_security_md": record("id __typename repository_id path content"),
    "base_repo_files": record("id repository_id path type content"),
    "base_si_documents": record(
        "repo_id source_url schema_version document", ("fetched_at", STAMP)
    ),
    "base_cncf_projects": T.StructType(_PROJECT_FIELDS),
    "base_cncf_project_repos": record("project_name owner name", ("primary", BOOL), "branch"),
}

PROJECT_COLUMNS = TABLES["base_cncf_projects"].fieldNames()

#: Column descriptions, stored as column metadata in Parquet and catalogues.
COLUMN_COMMENTS = {
    "repository_id": "Identifier of the repository",
    "owner": "Account that owns the repository",
    "repo": "Name of the repository",
    "nameWithOwner": "Owner and repository name, separated by a slash",
    "asset_name": "File name of the release artifact",
    "is_sbom": "True if the artifact is a software bill of materials",
    "sbom_format": "Format of the bill of materials, by name priority",
    "is_signature": "True if the artifact is a detached signature or public key",
    "is_attestation": "True if the artifact is an attestation",
    "is_vex": "True if the artifact is a vulnerability exploitability document",
    "is_slsa_provenance": "True if the artifact is build provenance",
    "tool_category": "Kind of security tool found in the workflow",
    "tool_name": "Security tool found in the workflow",
    "total_releases": "Number of releases",
    "total_assets": "Number of release artifacts",
    "total_workflows": "Number of workflow files",
    "sbom_adoption_rate": "Share with at least one bill of materials, 0 to 1",
}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A base table without rows but with its full schema."""
    return spark.createDataFrame([], TABLES[name])
