"""Security tools in workflow texts.

All rules are tried in one pass over the text; the text itself is dropped
before anything is joined or shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions import rules as R
from attestry.functions import text as X
from attestry.functions import values as V


def _hits_sql(rules: list[R.ToolRule], all_matches: bool, mode: str) -> str:
    """Array of (category, tool); ``tool`` is NULL where nothing matched."""

    def found(rule: R.ToolRule) -> str:
        return f"WHEN {X.listed_match_sql('_known', '_words', rule.query, mode)} THEN '{rule.tool}'"

    if all_matches:
        groups = [(r.category, [r]) for r in rules]
    else:
        groups = [(c, [r for r in rules if r.category == c]) for c in R.categories(rules)]
    structs = [
        f"named_struct('tool_category', '{category}', "
        f"'tool_name', CASE {' '.join(found(r) for r in mine)} END)"
        for category, mine in groups
    ]
    return f"inline(array({', '.join(structs)}))"


def detect_tools(
    texts: DataFrame,
    text: str,
    rules: list[R.ToolRule] = R.TOOL_RULES,
    all_matches: bool = False,
    mode: str = "phrase",
) -> DataFrame:
    """One row per (text, category) with the first matching tool of the category,
    or one per matching rule with ``all_matches``. No shuffle; works on streams.

    Texts without a single word of any rule leave before the rules are tried.
    """
    keep = [f"`{c}`" for c in texts.columns if c != text]
    known = X.known_words_sql("_words", [r.query for r in rules], mode)
    return (
        X.with_words(texts, text)
        .selectExpr(*keep, "_words", f"explode(array({known})) AS _known")
        .filter("size(_known) > 0")
        .selectExpr(*keep, _hits_sql(rules, all_matches, mode))
        .filter("tool_name IS NOT NULL")
    )


def workflow_tools(
    workflows: DataFrame,
    repositories: DataFrame,
    rules: list[R.ToolRule] = R.TOOL_RULES,
    all_matches: bool = False,
    mode: str = "phrase",
) -> DataFrame:
    """Detections with repository identity; only hits take part in the join."""
    hits = detect_tools(
        workflows.select(
            F.col("id").alias("workflow_id"),
            "repository_id",
            F.col("filename").alias("workflow_name"),
            "content",
        ),
        "content",
        rules,
        all_matches,
        mode,
    )
    owners = repositories.select(
        F.col("id").alias("repository_id"),
        V.owner_of(F.col("nameWithOwner")).alias("owner"),
        F.col("name").alias("repo"),
        "nameWithOwner",
    )
    return hits.join(owners, "repository_id").select(
        "workflow_id", "repository_id", "owner", "repo", "nameWithOwner", "workflow_name",
        "tool_category", "tool_name",
    )


def pattern_counts(
    texts: DataFrame, key: str, group: str, text: str, patterns: dict[str, str]
) -> DataFrame:
    """Per named search: distinct groups and texts that match, most groups first."""
    rules = [R.ToolRule("pattern", name, query) for name, query in patterns.items()]
    hits = detect_tools(texts.select(key, group, text), text, rules, all_matches=True)
    counted = hits.groupBy("tool_name").agg(
        F.count_distinct(group).alias("repos"), F.count(F.col(key)).alias("workflows")
    )
    listed = ", ".join(f"'{n}'" for n in patterns)
    names = texts.sparkSession.range(1).selectExpr(f"explode(array({listed})) AS tool_name")
    return (
        names.join(counted, "tool_name", "left")
        .select(
            F.col("tool_name").alias("tool"),
            F.coalesce("repos", F.lit(0)).alias("repos"),
            F.coalesce("workflows", F.lit(0)).alias("workflows"),
        )
        .orderBy(F.desc("repos"), "tool")
    )


def publish_status(workflows: DataFrame, repositories: DataFrame) -> DataFrame:
    """Workflows that make an SBOM: do they upload it or cut a release?"""
    hits = X.with_words(workflows, "content").selectExpr(
        "id",
        "repository_id",
        "filename",
        f"{X.match_sql('_words', R.GENERATES_SBOM)} AS generates_sbom",
        f"{X.match_sql('_words', R.UPLOADS_ARTIFACT)} AS uploads_artifact",
        f"{X.match_sql('_words', R.CREATES_RELEASE)} AS creates_release",
    )
    owners = repositories.select(F.col("id").alias("repository_id"), "nameWithOwner")
    return (
        hits.filter("generates_sbom")
        .join(owners, "repository_id")
        .orderBy(
            F.desc("uploads_artifact"), F.desc("creates_release"), "nameWithOwner", "filename", "id"
        )
        .select(
            "nameWithOwner",
            "filename",
            "generates_sbom",
            "uploads_artifact",
            "creates_release",
            F.when(F.col("uploads_artifact") | F.col("creates_release"), "✅ Publishes")
            .otherwise("❌ No Publishing")
            .alias("publishing_status"),
        )
    )


def step_patterns(workflows: DataFrame, repositories: DataFrame) -> DataFrame:
    """First verbatim tool text and upload methods of SBOM-making workflows."""
    whens = " ".join(f"WHEN contains(content, '{t}') THEN '{t}'" for t in R.STEP_TEXTS)
    steps = (
        X.with_words(workflows, "content")
        .filter(X.match_sql("_words", R.GENERATES_SBOM))
        .selectExpr(
            "repository_id",
            "filename",
            f"CASE {whens} ELSE 'other' END AS detected_tool",
            *[f"contains(content, '{t}') AS {name}" for name, t in R.UPLOAD_TEXTS.items()],
        )
    )
    owners = repositories.select(F.col("id").alias("repository_id"), "nameWithOwner")
    return steps.join(owners, "repository_id").select(
        "nameWithOwner", "filename", "detected_tool", *R.UPLOAD_TEXTS
    )


def tool_upload_matrix(steps: DataFrame) -> DataFrame:
    """Upload methods counted per tool."""
    return steps.groupBy("detected_tool").agg(
        *[F.sum(F.col(c).cast("int")).alias(c) for c in R.UPLOAD_TEXTS]
    )


def sample_texts(
    workflows: DataFrame, repositories: DataFrame, query: str, rows: int = 3, chars: int = 1500
) -> DataFrame:
    """A few matching workflows, their text cut for display.

    The cut is made before the join, so long texts stay where they are.
    """
    excerpt = (
        f"IF(length(content) > {chars}, "
        f"concat(substring(content, 1, {chars}), '\n\n... (truncated) ...'), content) AS excerpt"
    )
    hits = (
        X.with_words(workflows, "content")
        .filter(X.match_sql("_words", query))
        .selectExpr("id", "repository_id", "filename", excerpt)
    )
    owners = repositories.select(F.col("id").alias("repository_id"), "nameWithOwner")
    return (
        hits.join(owners, "repository_id")
        .orderBy("nameWithOwner", "filename", "id")
        .limit(rows)
        .select("nameWithOwner", "filename", "excerpt")
    )


def generator_repos(workflows: DataFrame, repositories: DataFrame) -> DataFrame:
    """Repositories with a workflow that makes an SBOM, one row each."""
    making = (
        X.with_words(workflows, "content")
        .filter(X.match_sql("_words", R.GENERATES_SBOM_WIDE))
        .select("repository_id")
        .distinct()
    )
    owners = repositories.select(
        F.col("id").alias("repository_id"), "nameWithOwner", "description", "url"
    )
    return making.join(owners, "repository_id")


def publication_gap(generators: DataFrame, patterns: DataFrame) -> DataFrame:
    """Does a repository that makes an SBOM also release one?"""
    released = (
        patterns.filter("is_sbom")
        .select("repository_id", F.lit(True).alias("_released"))
        .distinct()
    )
    return (
        generators.join(released, "repository_id", "left")
        .select(
            "nameWithOwner",
            "description",
            "url",
            F.when(F.col("_released"), "✅ Has Artifacts")
            .otherwise("❌ Missing Artifacts")
            .alias("artifact_status"),
        )
        .orderBy("artifact_status", "nameWithOwner")
    )


def unpublished(gap: DataFrame) -> DataFrame:
    """The repositories of the gap that make SBOMs but release none."""
    return gap.filter(F.col("artifact_status") == "❌ Missing Artifacts")
