"""Keyword search, classification and tool detection."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from attestry.functions import rules as R
from attestry.functions import text as X
from attestry.operators import classify, detect, search
from attestry.plans import analyses, summaries
from attestry.session import work_dir
from workload.prelude import format_sql, flag_sql, match, tool_union
from workload.registry import query

LICENSES = "license OR licensed OR apache"
TOKENS = "token OR mit"
TEXT_RULES = [
    R.ToolRule("license", "mit", "mit license"),
    R.ToolRule("license", "apache", "apache"),
    R.ToolRule("license", "any", "license OR licensed"),
    R.ToolRule("secret", "token", "token"),
]


@query(
    "keyword_flags",
    f"SELECT doc_id, {match('text', LICENSES)} AS is_license, {match('text', 'mit license')} AS is_mit, "
    f"{match('text', TOKENS)} AS is_token FROM documents",
)
def keyword_flags(g):
    w = F.col("w")
    return g.table("documents").select("doc_id", X.words(F.col("text")).alias("w")).select(
        "doc_id",
        X.matches(w, LICENSES).alias("is_license"),
        X.matches(w, "mit license").alias("is_mit"),
        X.matches(w, TOKENS).alias("is_token"),
    )


@query(
    "keyword_any_token",
    f"SELECT doc_id, lang FROM documents WHERE {match('text', 'mit-license OR apache', 'any_token')}",
)
def keyword_any_token(g):
    return search.keyword_search(g.table("documents"), ["text"], "mit-license OR apache").select(
        "doc_id", "lang"
    )


@query(
    "page_keywords",
    f"SELECT page_id, {match('html', 'track OR nav')} AS scripted, {match('html', 'ad en')} AS advert "
    "FROM pages",
)
def page_keywords(g):
    w = F.col("w")
    return g.table("pages").select("page_id", X.words(F.col("html")).alias("w")).select(
        "page_id",
        X.matches(w, "track OR nav").alias("scripted"),
        X.matches(w, "ad en").alias("advert"),
    )


def _words_sql(column: str) -> str:
    return f"[x FOR x IN regexp_split_to_array(lower({column}), '[^a-z]+') IF x <> '']"


def _scores_sql(queries: dict[str, str], key: str, text: str, source: str) -> str:
    """The key and a BM25 score for each query."""
    terms = list(dict.fromkeys(w for q in queries.values() for w in X.word_list(q)))
    tf = ", ".join(f"len([x FOR x IN w IF x = '{t}'])::DOUBLE AS tf_{t}" for t in terms)
    df = ", ".join(f"count(*) FILTER (WHERE tf_{t} > 0)::DOUBLE AS df_{t}" for t in terms)

    def part(t):
        return (
            f"CASE WHEN tf_{t} > 0 THEN ln((n - df_{t} + 0.5::DOUBLE) / (df_{t} + 0.5::DOUBLE) + 1) * tf_{t} "
            f"* 2.2::DOUBLE / (tf_{t} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len_ / avg_)) ELSE 0 END"
        )

    def score(q):
        words = X.word_list(q)
        hit = " OR ".join(f"tf_{t} > 0" for t in words)
        return f"CASE WHEN {hit} THEN round({' + '.join(part(t) for t in words)}, 6) END"

    scores = ", ".join(f"{score(q)} AS {name}" for name, q in queries.items())
    return (
        f"SELECT {key}, " + scores + " FROM ("
        f"SELECT {key}, len(w)::DOUBLE AS len_, " + tf + " FROM ("
        f"SELECT {key}, {_words_sql(text)} AS w FROM {source})) "
        "CROSS JOIN (SELECT count(*)::DOUBLE AS n, avg(len(w)) AS avg_, " + df + " FROM ("
        "SELECT w, " + tf + f" FROM (SELECT {_words_sql(text)} AS w FROM {source})))"
    )


def _bm25_sql(queries: dict[str, str]) -> str:
    some = " OR ".join(f"{name} IS NOT NULL" for name in queries)
    order = ", ".join(f"{name} DESC NULLS LAST" for name in queries)
    return (
        "SELECT doc_id, " + ", ".join(queries) + f" FROM ({_scores_sql(queries, 'doc_id', 'text', 'documents')}) "
        f"WHERE {some} ORDER BY {order}, doc_id LIMIT 50"
    )


RANKED = {"license_score": LICENSES, "token_score": TOKENS}


@query("ranked_search", _bm25_sql(RANKED))
def ranked_search(g):
    docs = g.table("documents").select("doc_id", "text")
    return search.ranked_search(docs, "doc_id", "text", RANKED, limit=50, digits=6)


SOUGHT = {"sbom_score": "sbom OR spdx OR cyclonedx", "tool_score": "syft OR trivy OR cdxgen OR anchore"}
SOUGHT_WHERE = "sbom OR spdx OR cyclonedx OR syft OR trivy OR cdxgen"


@query(
    "workflow_search",
    "SELECT nameWithOwner, filename, w.id AS workflow_id, sbom_score, tool_score, description FROM ("
    + _scores_sql(SOUGHT, "id", "content", "base_workflows")
    + ") s JOIN base_workflows w ON s.id = w.id JOIN base_repositories r ON w.repository_id = r.id "
    f"WHERE list_has_any({_words_sql('content')}, {X.word_list(SOUGHT_WHERE)}) "
    "ORDER BY sbom_score DESC NULLS LAST, tool_score DESC NULLS LAST, nameWithOwner, filename, w.id LIMIT 50",
)
def workflow_search(g):
    """Two scores, and a filter of its own that one word of the second score is not in."""
    return search.workflow_search(g.workflows, g.repositories, SOUGHT, SOUGHT_WHERE, digits=6)


@query(
    "all_scores",
    _bm25_sql(RANKED).replace(" LIMIT 50", ""),
)
def all_scores(g):
    docs = g.table("documents").select("doc_id", "text")
    scored = search.bm25_scores(docs, "text", RANKED).drop("text")
    return scored.filter("license_score IS NOT NULL OR token_score IS NOT NULL").withColumns(
        {n: F.round(n, 6) for n in RANKED}
    )


def _postings_sql(table: str, source: str, key: str, fields: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, id, '{f}' AS field, term, count(*) AS tf FROM ("
        f"SELECT {key}::VARCHAR AS id, unnest({_words_sql(f)}) AS term FROM {source}) GROUP BY id, term"
        for f in fields
    )


@query(
    "term_index",
    _postings_sql("base_repositories", "base_repositories", "id", ["description", "nameWithOwner"])
    + " UNION ALL "
    + _postings_sql("base_releases", "base_releases", "id", ["name"])
    + " UNION ALL "
    + _postings_sql("conversations", "conversations", "conv_id || '-' || turn", ["text"]),
)
def term_index(g):
    talks = g.table("conversations").withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    return (
        search.term_index(
            g.repositories, "base_repositories", "id", ["description", "nameWithOwner"]
        )
        .unionByName(search.term_index(g.releases, "base_releases", "id", ["name"]))
        .unionByName(search.term_index(talks, "conversations", "key", ["text"]))
    )


@query(
    "term_statistics",
    "SELECT table_name, field, term, count(*) AS texts, sum(tf)::BIGINT AS occurrences FROM ("
    + _postings_sql("base_workflows", "base_workflows", "id", ["content", "filename"])
    + " UNION ALL "
    + _postings_sql("base_release_assets", "base_release_assets", "id", ["name"])
    + " UNION ALL "
    + _postings_sql("pages", "pages", "page_id", ["html"])
    + ") GROUP BY table_name, field, term",
)
def term_statistics(g):
    postings = (
        search.term_index(g.workflows, "base_workflows", "id", ["content", "filename"])
        .unionByName(search.term_index(g.assets, "base_release_assets", "id", ["name"]))
        .unionByName(search.term_index(g.table("pages"), "pages", "page_id", ["html"]))
    )
    return postings.groupBy("table_name", "field", "term").agg(
        F.count("*").alias("texts"), F.sum("tf").alias("occurrences")
    )


def _saved_index(g):
    """The index of all documents' words, saved in buckets under a name of its own."""
    path = work_dir(g.spark, "term-index")
    name = os.path.basename(path).replace("-", "_")
    search.save_term_index(
        search.term_index(g.table("documents"), "documents", "doc_id", ["text"]), name, path, buckets=16, salts=4
    )
    return g.spark.table(name)


@query(
    "term_lookup",
    "SELECT table_name, id, field, sum(tf)::BIGINT AS hits FROM ("
    + _postings_sql("documents", "documents", "doc_id", ["text"])
    + ") WHERE term IN ('license', 'apache', 'mit') GROUP BY table_name, id, field",
)
def term_lookup(g):
    return search.term_hits(_saved_index(g), "license OR apache OR mit")


@query(
    "term_join",
    "SELECT q.id AS query, term, count(*) AS texts, sum(d.tf)::BIGINT AS hits FROM ("
    + _postings_sql("benchmark", "benchmark", "item_id", ["text"])
    + ") q JOIN ("
    + _postings_sql("documents", "documents", "doc_id", ["text"])
    + ") d USING (term) GROUP BY q.id, term",
)
def term_join(g):
    """Every benchmark item as a query of its words: in how many documents each of them stands, and how often."""
    items = search.term_index(g.table("benchmark"), "benchmark", "item_id", ["text"])
    known = search.term_totals(_saved_index(g))
    return search.match_terms(known, items.select(F.col("id").alias("query"), "term")).select(
        "query", "term", "texts", "hits"
    )


@query(
    "description_search",
    "SELECT id, description FROM base_repositories WHERE "
    + match("description || chr(10) || nameWithOwner", "machinery OR asia", "any_token"),
)
def description_search(g):
    return search.keyword_search(
        g.repositories, ["description", "nameWithOwner"], "machinery OR asia"
    ).select("id", "description")


@query(
    "extension_flags",
    f"SELECT id, {flag_sql('is_signature', 'name')} AS is_signature, "
    f"{flag_sql('is_sigstore_bundle', 'name')} AS is_sigstore_bundle FROM base_release_assets",
)
def extension_flags(g):
    return g.assets.selectExpr(
        "id", *[f"{X.extension_sql('name', e)} AS {f}" for f, e in R.ARTIFACT_EXTENSIONS.items()]
    )


PART_NAME = "replace(p_name, ' ', '-') || '.' || lower(p_type)"


@query(
    "classified_parts",
    f"SELECT p_partkey, {PART_NAME} AS name, {format_sql(PART_NAME)} AS sbom_format, "
    + ", ".join(f"{flag_sql(f, PART_NAME)} AS {f}" for f in R.ARTIFACT_FLAGS)
    + " FROM part",
)
def classified_parts(g):
    named = g.table("part").select("p_partkey", F.expr(PART_NAME).alias("name"))
    return classify.classify_assets(named)


_ARTIFACT_COLUMNS = (
    "asset_id, release_id, repository_id, owner, repo, nameWithOwner, asset_name, download_url, "
    "sbom_format, " + ", ".join(R.ARTIFACT_FLAGS)
)


@query("artifact_patterns", f"SELECT {_ARTIFACT_COLUMNS} FROM agg_artifact_patterns")
def artifact_patterns(g):
    return g.patterns


@query(
    "sbom_format_counts",
    "SELECT sbom_format, count(*) AS row_count FROM agg_artifact_patterns "
    "WHERE sbom_format IS NOT NULL GROUP BY sbom_format",
)
def sbom_format_counts(g):
    return summaries.value_counts(g.patterns, "sbom_format")


_TOOL_COLUMNS = (
    "workflow_id, repository_id, owner, repo, nameWithOwner, workflow_name, tool_category, tool_name"
)


@query("workflow_tools", f"SELECT {_TOOL_COLUMNS} FROM agg_workflow_tools")
def workflow_tools(g):
    return g.tools


def _joined(hits: str) -> str:
    return (
        f"SELECT h.*, split_part(r.nameWithOwner, '/', 1) AS owner, r.name AS repo, r.nameWithOwner "
        f"FROM ({hits}) h JOIN base_repositories r ON h.repository_id = r.id"
    )


_KEEP = "id AS workflow_id, repository_id, filename AS workflow_name"


@query(
    "workflow_tools_all_matches",
    _joined(tool_union("base_workflows", _KEEP, "content", all_matches=True)),
)
def workflow_tools_all_matches(g):
    return detect.workflow_tools(g.workflows, g.repositories, all_matches=True)


@query(
    "workflow_tools_any_token",
    _joined(tool_union("base_workflows", _KEEP, "content", mode="any_token")),
)
def workflow_tools_any_token(g):
    return detect.workflow_tools(g.workflows, g.repositories, mode="any_token")


@query(
    "workflow_tools_optional_rules",
    _joined(tool_union("base_workflows", _KEEP, "content", rules=R.OPTIONAL_TOOL_RULES)),
)
def workflow_tools_optional_rules(g):
    return detect.workflow_tools(g.workflows, g.repositories, rules=R.OPTIONAL_TOOL_RULES)


@query(
    "text_rule_hits",
    tool_union("documents", "doc_id, lang", "text", rules=TEXT_RULES, all_matches=True),
)
def text_rule_hits(g):
    docs = g.table("documents").select("doc_id", "lang", "text")
    return detect.detect_tools(docs, "text", TEXT_RULES, all_matches=True)


@query(
    "tool_pattern_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS tool, count(DISTINCT repository_id) AS repos, count(id) AS workflows "
        f"FROM base_workflows WHERE {match('content', q)}"
        for name, q in R.GENERATOR_PATTERNS.items()
    ),
)
def tool_pattern_counts(g):
    return detect.pattern_counts(
        g.workflows, "id", "repository_id", "content", R.GENERATOR_PATTERNS
    )


_PUBLISH = (
    f"SELECT r.nameWithOwner, w.filename, {match('content', R.GENERATES_SBOM)} AS generates_sbom, "
    f"{match('content', R.UPLOADS_ARTIFACT)} AS uploads_artifact, "
    f"{match('content', R.CREATES_RELEASE)} AS creates_release, "
    f"CASE WHEN {match('content', R.UPLOADS_ARTIFACT)} OR {match('content', R.CREATES_RELEASE)} "
    "THEN '✅ Publishes' ELSE '❌ No Publishing' END AS publishing_status "
    "FROM base_workflows w JOIN base_repositories r ON w.repository_id = r.id "
    f"WHERE {match('content', R.GENERATES_SBOM)}"
)


@query("publish_status", _PUBLISH)
def publish_status(g):
    return detect.publish_status(g.workflows, g.repositories)


@query(
    "publish_status_counts",
    f"SELECT publishing_status, count(*) AS row_count FROM ({_PUBLISH}) GROUP BY publishing_status",
)
def publish_status_counts(g):
    return summaries.value_counts(
        detect.publish_status(g.workflows, g.repositories), "publishing_status"
    )


_STEPS = (
    "SELECT w.id, r.nameWithOwner, w.filename, CASE "
    + " ".join(f"WHEN contains(content, '{t}') THEN '{t}'" for t in R.STEP_TEXTS)
    + " ELSE 'other' END AS detected_tool, "
    + ", ".join(f"contains(content, '{t}') AS {n}" for n, t in R.UPLOAD_TEXTS.items())
    + " FROM base_workflows w JOIN base_repositories r ON w.repository_id = r.id WHERE "
    + match("content", R.GENERATES_SBOM)
)


@query("step_patterns", f"SELECT * EXCLUDE (id) FROM ({_STEPS})")
def step_patterns(g):
    return detect.step_patterns(g.workflows, g.repositories)


@query(
    "tool_upload_matrix",
    "SELECT detected_tool, "
    + ", ".join(f"sum({n}::INT)::BIGINT AS {n}" for n in R.UPLOAD_TEXTS)
    + f" FROM ({_STEPS}) GROUP BY detected_tool",
)
def tool_upload_matrix(g):
    return detect.tool_upload_matrix(detect.step_patterns(g.workflows, g.repositories))


@query(
    "sample_texts",
    "SELECT r.nameWithOwner, w.filename, CASE WHEN length(content) > 60 THEN content[1:60] || "
    "chr(10) || chr(10) || '... (truncated) ...' ELSE content END AS excerpt "
    "FROM base_workflows w JOIN base_repositories r ON w.repository_id = r.id "
    f"WHERE {match('content', 'syft OR anchore/sbom-action')} "
    "ORDER BY r.nameWithOwner, w.filename, w.id LIMIT 3",
)
def sample_texts(g):
    return detect.sample_texts(
        g.workflows, g.repositories, "syft OR anchore/sbom-action", rows=3, chars=60
    )


_GAP = (
    "SELECT c.nameWithOwner, c.description, c.url, CASE WHEN a.repository_id IS NOT NULL "
    "THEN '✅ Has Artifacts' ELSE '❌ Missing Artifacts' END AS artifact_status FROM ("
    "SELECT DISTINCT r.id, r.nameWithOwner, r.description, r.url FROM base_workflows w "
    f"JOIN base_repositories r ON w.repository_id = r.id WHERE {match('content', R.GENERATES_SBOM_WIDE)}) c "
    "LEFT JOIN (SELECT DISTINCT repository_id FROM agg_artifact_patterns WHERE is_sbom) a "
    "ON c.id = a.repository_id"
)


def _gap(g):
    return detect.publication_gap(
        detect.generator_repos(g.workflows, g.repositories),
        classify_by_repo(g),
    )


def classify_by_repo(g):
    """Artifact signals with the repository, without the identity columns."""
    owned = g.releases.select(F.col("id").alias("release_id"), "repository_id")
    return classify.classify_assets(g.assets.select("release_id", "name")).join(owned, "release_id")


@query("publication_gap", _GAP)
def publication_gap(g):
    return _gap(g)


@query(
    "publication_gap_counts",
    f"SELECT artifact_status, count(*) AS row_count FROM ({_GAP}) GROUP BY artifact_status",
)
def publication_gap_counts(g):
    return summaries.value_counts(_gap(g), "artifact_status")


@query("unpublished_repos", f"SELECT * FROM ({_GAP}) WHERE artifact_status LIKE '%Missing%'")
def unpublished_repos(g):
    return detect.unpublished(_gap(g))


@query(
    "known_sboms",
    "SELECT nameWithOwner, asset_name, sbom_format, download_url FROM agg_artifact_patterns WHERE is_sbom",
)
def known_sboms(g):
    return analyses.known_sboms(g.patterns)
