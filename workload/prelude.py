"""The same base tables and models as plain SQL, for the checking engine.

Keyword tests are written here as word-bounded regular expressions and counts as
COUNT(DISTINCT ...), not in the way the Spark plans compute them.
"""

from __future__ import annotations

import re

from attestry.functions import rules as R
from attestry.plans import project_summary as PS
from attestry.plans import repo_summary as RS
from workload import given as G


def lit(text: str) -> str:
    """A SQL string literal; line breaks are spelled with chr(10)."""
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def pattern(term: str) -> str:
    body = "[^a-z]+".join(re.findall("[a-z]+", term.lower()))
    return f"(?i)(^|[^a-z]){body}($|[^a-z])"


def match(column: str, query: str, mode: str = "phrase") -> str:
    terms = re.split(r"\s+OR\s+", query)
    if mode == "any_token":
        terms = [w for t in terms for w in re.findall("[a-z]+", t.lower()) if w != "or"]
    tests = " OR ".join(f"regexp_matches({column}, {lit(pattern(t))})" for t in terms)
    return f"coalesce({tests}, false)"


def flag_sql(flag: str, column: str) -> str:
    if flag in R.ARTIFACT_KEYWORDS:
        return match(column, R.ARTIFACT_KEYWORDS[flag])
    ends = "|".join(R.ARTIFACT_EXTENSIONS[flag])
    return f"regexp_matches({column}, '(?i)\\.({ends})$')"


def format_sql(column: str) -> str:
    whens = " ".join(f"WHEN {match(column, q)} THEN '{label}'" for label, q in R.SBOM_FORMATS)
    return f"CASE {whens} END"


def tool_union(source: str, keep: str, text: str, rules=R.TOOL_RULES, all_matches=False, mode="phrase"):
    """One SELECT per category (first match) or per rule (all matches)."""
    parts = []
    if all_matches:
        for r in rules:
            parts.append(
                f"SELECT {keep}, '{r.category}' AS tool_category, '{r.tool}' AS tool_name "
                f"FROM {source} WHERE {match(text, r.query, mode)}"
            )
    else:
        for category in R.categories(rules):
            mine = [r for r in rules if r.category == category]
            whens = " ".join(f"WHEN {match(text, r.query, mode)} THEN '{r.tool}'" for r in mine)
            some = " OR ".join(match(text, r.query, mode) for r in mine)
            parts.append(
                f"SELECT {keep}, '{category}' AS tool_category, CASE {whens} END AS tool_name "
                f"FROM {source} WHERE {some}"
            )
    return " UNION ALL ".join(parts)


def rate(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part}::DOUBLE / {whole}::DOUBLE ELSE 0.0::DOUBLE END"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return f"round(100.0::DOUBLE * ({part}) / ({whole}), {digits})"


def sum_if(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)::BIGINT"


def _suffix() -> str:
    whens = " ".join(
        f"WHEN '{flag}' THEN [{', '.join(lit(e) for e in ends)}][l_linenumber]"
        for flag, ends in G.SUFFIXES.items()
    )
    return f"CASE WHEN l_discount > 0.085 THEN CASE l_returnflag {whens} END ELSE {lit(G.PLAIN)} END"


def _steps() -> str:
    steps = ", ".join(lit(s) for s in G.STEPS)
    return f"coalesce(([{steps}])[json_extract_string(props, '$.k')::INT + 1], {lit(G.CHECKOUT)})"


_LEVEL = "CASE n_regionkey " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in G.LEVELS.items()) + " END"
_PROJECT = "n_name || '-' || c_mktsegment"
_ONE = (
    """'{"name":"rel-' || o_orderkey || '","location":"https://a.example/' || o_orderkey || """
    """'","predicate-uri":"https://slsa.dev/' || o_orderstatus || '"}'"""
)
_TWO = """'{"name":"' || o_orderpriority || '","comment":"second"}'"""
_DOCUMENT = f"""'{{"header":{{' ||
  CASE o_orderstatus WHEN 'F' THEN '"schema-version":"1.0.0",'
                     WHEN 'O' THEN '"schema-version":"2.1.0",' ELSE '' END ||
  '"last-updated":"' || CASE WHEN o_orderstatus = 'P' THEN 'soon' ELSE o_orderdate::DATE::VARCHAR END ||
  '"}},"project":{{"name":"proj-' || o_custkey || '"}},"repository":{{' ||
  CASE o_orderstatus WHEN 'O' THEN '"release":{{"attestations":[' || {_ONE} || ',' || {_TWO} || ']}},'
                     WHEN 'F' THEN '"release":{{"attestations":' || {_ONE} || '}},' ELSE '' END ||
  '"url":"https://github.com/o/' || o_orderkey || '","security":{{"tools":[{{"results":{{"adhoc":' || {_TWO} ||
  '}}}},{{"results":{{"ci":' || {_ONE} || ',"release":' || {_TWO} || '}}}}]}}}},' ||
  CASE WHEN o_orderpriority < '3' THEN '"attestations":[' || {_TWO} || '],' ELSE '' END ||
  '"security-artifacts":{{"attestations":[' || {_ONE} || ']}}' ||
  CASE WHEN o_orderstatus <> 'O' THEN ',"dependencies":{{"sbom":[{{"sbom-format":"SPDX","sbom-url":"https://s.example/' ||
    o_orderkey || '","comment":"' || o_orderpriority || '"}},{{"sbom-file":"bom-' || o_orderkey || '.json"}}]}}' ELSE '' END || '}}'"""

_REPO_FLAGS = ", ".join(
    [f"bool_or(sbom_format = '{f}') AS {c}" for c, f in RS.FORMAT_FLAGS.items()]
    + [f"bool_or({f}) AS {c}" for c, f in RS.ARTIFACT_FLAGS_OF_REPO.items()]
)
_TOOL_FLAGS = ", ".join(
    [f"bool_or(tool_category = '{v}') AS {c}" for c, v in RS.CATEGORY_FLAGS.items()]
    + [f"bool_or(tool_name = '{v}') AS {c}" for c, v in RS.TOOL_FLAGS.items()]
)
_SCANNERS = ", ".join(f"'{c}'" for c in R.SCANNER_CATEGORIES)
_REPO_COLUMNS = ", ".join(
    [f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("total_releases", "total_assets", "total_workflows")]
    + [f"coalesce({c}, false) AS {c}" for c in [*RS.FORMAT_FLAGS, *RS.ARTIFACT_FLAGS_OF_REPO]]
    + [f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("sbom_artifact_count", "signature_artifact_count")]
    + [f"coalesce({c}, false) AS {c}" for c in [*RS.CATEGORY_FLAGS, *RS.TOOL_FLAGS]]
    + [
        f"coalesce({c}, 0)::BIGINT AS {c}"
        for c in (
            "sbom_generator_count", "signer_count", "scanner_count", "releases_with_sbom_count",
            "releases_with_signatures_count",
        )
    ]
)
_SCORE = " + ".join(f"CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for c in RS.MATURITY_SIGNALS)
_KEY = "pr.owner || '/' || pr.name"



def _rollup(fold_case: bool) -> str:
    fold = "lower" if fold_case else ""
    return (
        f"SELECT pr.project_name, count(DISTINCT {_KEY}) AS total_repos, "
        f'count(DISTINCT CASE WHEN pr."primary" THEN {_KEY} END) AS primary_repos, '
        + ", ".join(f"sum(coalesce(s.{n}, 0))::BIGINT AS {c}" for c, n in PS.REPO_SUMS.items())
        + ", "
        + ", ".join(
            f"count(DISTINCT CASE WHEN s.{f} THEN {_KEY} END) AS {c}" for c, f in PS.REPO_COUNTS.items()
        )
        + ", min(s.first_sbom_date) AS earliest_sbom_date, "
        "min(s.first_release_with_sbom) AS earliest_release_with_sbom, "
        "sum(s.security_maturity_score) / nullif(count(s.security_maturity_score), 0) "
        "AS security_maturity_score FROM base_cncf_project_repos pr LEFT JOIN base_repositories r "
        f"ON {fold}(pr.owner) = {fold}(split_part(r.nameWithOwner, '/', 1)) "
        f"AND {fold}(pr.name) = {fold}(split_part(r.nameWithOwner, '/', 2)) "
        "LEFT JOIN scored s ON r.id = s.repository_id GROUP BY pr.project_name"
    )


def _projects(rollup: str) -> str:
    return (
        "SELECT "
        + ", ".join(f"p.{c}" for c in [*PS.IDENTITY, *PS.ATTRIBUTES])
        + ", "
        + ", ".join(
            f"coalesce({c}, 0)::BIGINT AS {c}"
            for c in ["total_repos", "primary_repos", *PS.REPO_SUMS, *PS.REPO_COUNTS]
        )
        + f", {rate('coalesce(repos_with_sbom, 0)', 'coalesce(total_repos, 0)')} AS sbom_adoption_rate, "
        "earliest_sbom_date, earliest_release_with_sbom, security_maturity_score "
        f"FROM base_cncf_projects p LEFT JOIN {rollup} u ON p.project_name = u.project_name"
    )


CTES: dict[str, str] = {
    "owners": (
        "SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey"
    ),
    "base_repositories": (
        "SELECT 'R' || c_custkey AS id, c_name AS name, n_name || '/' || c_name AS nameWithOwner, "
        "'https://github.com/' || n_name || '/' || c_name AS url, "
        "c_mktsegment || ' software of ' || r_name AS description FROM owners"
    ),
    "base_releases": (
        "SELECT 'L' || o_orderkey AS id, 'R' || o_custkey AS repository_id, o_orderpriority AS name, "
        "'v' || o_orderdate::DATE::VARCHAR AS tagName, "
        "'https://github.com/releases/' || o_orderkey AS url, o_orderdate AS createdAt FROM orders"
    ),
    "base_release_assets": (
        "SELECT 'A-' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id, "
        f"'L' || l_orderkey AS release_id, 'pkg-' || l_partkey || {_suffix()} AS name, "
        f"'https://downloads.example.org/' || l_orderkey || '/pkg-' || l_partkey || {_suffix()} "
        "AS downloadUrl FROM lineitem"
    ),
    "event_workflows": (
        "SELECT 'W' || event_id AS id, 'R' || user_id AS repository_id, event_type || '.yml' AS filename, "
        f"'name: ' || event_type || {lit(G.FLOW_HEAD)} || {_steps()} AS content FROM events"
    ),
    "base_workflows": (
        "SELECT * FROM event_workflows UNION ALL SELECT 'D' || doc_id, 'R' || doc_id, "
        "source || '.yml', text FROM documents"
    ),
    "base_si_documents": (
        "SELECT 'R' || o_custkey AS repo_id, 'https://github.com/own' || o_custkey || '/repo' || "
        "o_orderkey || '/blob/HEAD/security-insights.yml' AS source_url, "
        "CASE o_orderstatus WHEN 'F' THEN '1.0.0' WHEN 'O' THEN '2.1.0' ELSE 'unknown' END "
        f"AS schema_version, ({_DOCUMENT})::JSON AS document, o_orderdate AS fetched_at FROM orders"
    ),
    "base_cncf_projects": (
        f"SELECT {_PROJECT} AS project_name, 'Project ' || {_PROJECT} AS display_name, "
        f"c_mktsegment || ' of ' || r_name AS description, {_LEVEL} AS maturity, "
        "c_mktsegment AS category, r_name AS subcategory, '2020-01-01' AS date_accepted, "
        "NULL::VARCHAR AS date_incubating, NULL::VARCHAR AS date_graduated, "
        "'https://' || lower(n_name) || '.example.org/' AS homepage_url, "
        "'https://github.com/' || n_name || '/' || min(c_custkey) AS repo_url, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'https://packages.example.org/' END AS package_manager_url, "
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'https://images.example.org/' END AS docker_url, "
        "CASE WHEN n_regionkey < 2 THEN 'https://badge.example.org/' END AS url_for_bestpractices, "
        "count(*) FILTER (WHERE c_acctbal < -900) > 0 AS has_security_audits, "
        "(count(*) FILTER (WHERE c_acctbal < -900))::INT AS security_audit_count, "
        "CASE WHEN count(*) FILTER (WHERE c_acctbal < -900) > 0 THEN '2024-02-02' END AS latest_audit_date, "
        "CASE WHEN count(*) FILTER (WHERE c_acctbal < -900) > 0 THEN r_name END AS latest_audit_vendor, "
        "NULL::VARCHAR AS clomonitor_name, NULL::VARCHAR AS dev_stats_url, NULL::VARCHAR AS blog_url, "
        "NULL::VARCHAR AS crunchbase, NULL::VARCHAR AS twitter "
        "FROM owners GROUP BY n_name, n_regionkey, r_name, c_mktsegment"
    ),
    "base_cncf_project_repos": (
        f"SELECT {_PROJECT} AS project_name, "
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN lower(n_name) ELSE n_name END AS owner, "
        'c_name AS name, c_acctbal > 5000 AS "primary" FROM owners'
    ),
    "agg_artifact_patterns": (
        "SELECT a.id AS asset_id, a.release_id, l.repository_id, split_part(r.nameWithOwner, '/', 1) AS owner, "
        "r.name AS repo, r.nameWithOwner, a.name AS asset_name, a.downloadUrl AS download_url, "
        f"{format_sql('a.name')} AS sbom_format, "
        + ", ".join(f"{flag_sql(f, 'a.name')} AS {f}" for f in R.ARTIFACT_FLAGS)
        + " FROM base_release_assets a JOIN base_releases l ON a.release_id = l.id "
        "JOIN base_repositories r ON l.repository_id = r.id"
    ),
    "hits": tool_union(
        "base_workflows", "id AS workflow_id, repository_id, filename AS workflow_name", "content"
    ),
    "agg_workflow_tools": (
        "SELECT h.*, split_part(r.nameWithOwner, '/', 1) AS owner, r.name AS repo, r.nameWithOwner "
        "FROM hits h JOIN base_repositories r ON h.repository_id = r.id"
    ),
    "artifact_stats": (
        f"SELECT repository_id, count(*) AS total_assets, {_REPO_FLAGS}, "
        f"{sum_if('is_sbom')} AS sbom_artifact_count, {sum_if('is_signature')} AS signature_artifact_count "
        "FROM agg_artifact_patterns GROUP BY repository_id"
    ),
    "workflow_stats": (
        f"SELECT repository_id, {_TOOL_FLAGS}, "
        "count(DISTINCT CASE WHEN tool_category = 'sbom-generator' THEN workflow_id END) AS sbom_generator_count, "
        "count(DISTINCT CASE WHEN tool_category = 'signer' THEN workflow_id END) AS signer_count, "
        f"count(DISTINCT CASE WHEN tool_category IN ({_SCANNERS}) THEN workflow_id END) AS scanner_count "
        "FROM agg_workflow_tools GROUP BY repository_id"
    ),
    "release_stats": (
        "SELECT l.repository_id, count(DISTINCT l.id) AS total_releases, "
        "count(DISTINCT CASE WHEN p.is_sbom THEN l.id END) AS releases_with_sbom_count, "
        "count(DISTINCT CASE WHEN p.is_signature THEN l.id END) AS releases_with_signatures_count, "
        "min(CASE WHEN p.is_sbom THEN l.tagName END) AS first_release_with_sbom, "
        "min(CASE WHEN p.is_sbom THEN l.createdAt END) AS first_sbom_date "
        "FROM base_releases l LEFT JOIN agg_artifact_patterns p ON l.id = p.release_id "
        "GROUP BY l.repository_id"
    ),
    "flow_counts": (
        "SELECT repository_id, count(*) AS total_workflows FROM base_workflows GROUP BY repository_id"
    ),
    "agg_repo_summary": (
        "SELECT r.id AS repository_id, split_part(r.nameWithOwner, '/', 1) AS owner, r.name AS repo, "
        f"r.nameWithOwner, r.description, r.url, {_REPO_COLUMNS}, "
        f"{rate('coalesce(releases_with_sbom_count, 0)', 'coalesce(total_releases, 0)')} AS sbom_adoption_rate, "
        "first_release_with_sbom, first_sbom_date, "
        # release tags here are dates, so the smallest tag is the earliest one
        "first_release_with_sbom AS first_sbom_tag_by_date "
        "FROM base_repositories r LEFT JOIN artifact_stats a ON r.id = a.repository_id "
        "LEFT JOIN workflow_stats w ON r.id = w.repository_id "
        "LEFT JOIN release_stats s ON r.id = s.repository_id "
        "LEFT JOIN flow_counts f ON r.id = f.repository_id"
    ),
    "scored": f"SELECT *, {_SCORE} AS security_maturity_score FROM agg_repo_summary",
    "rollup": _rollup(False),
    "agg_cncf_project_summary": _projects("rollup"),
    "rollup_folded": _rollup(True),
    "projects_folded": _projects("rollup_folded"),
    "newest_releases": (
        "SELECT * FROM base_releases QUALIFY row_number() OVER "
        "(PARTITION BY repository_id ORDER BY createdAt DESC, id) <= 5"
    ),
    # repositories that answered, and by which query
    "answered": (
        "SELECT *, 'R' || c_custkey AS repo_id, n_name || '/' || c_name AS nwo, "
        "c_mktsegment <> 'AUTOMOBILE' AS extended FROM owners WHERE c_acctbal >= -900"
    ),
    "projects_all": "SELECT * FROM agg_cncf_project_summary",
}


def with_prelude(select: str) -> str:
    """A statement over the CTEs it names, directly or through other CTEs."""
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                need(CTES[name])

    need(select)
    parts = [f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + select
