"""Release artifacts to signal columns, by file name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions import rules as R
from attestry.functions import text as X
from attestry.functions import values as V


def _flag_sql(flag: str, name: str, words_column: str) -> str:
    if flag in R.ARTIFACT_KEYWORDS:
        return X.match_sql(words_column, R.ARTIFACT_KEYWORDS[flag])
    return f"({X.extension_sql(name, R.ARTIFACT_EXTENSIONS[flag])})"


def _format_sql(words_column: str) -> str:
    """Format by priority of the name's words; NULL when none is named.

    ``cdx`` alone names a format although it does not make the file an SBOM.
    """
    whens = [f"WHEN {X.match_sql(words_column, q)} THEN '{label}'" for label, q in R.SBOM_FORMATS]
    return f"CASE {' '.join(whens)} END"


def classify_assets(assets: DataFrame, name: str = "name") -> DataFrame:
    """Add the signal columns to a table with a file-name column. No shuffle."""
    flags = [f"{_flag_sql(f, name, '_words')} AS {f}" for f in R.ARTIFACT_FLAGS]
    return X.with_words(assets, name).selectExpr(
        *[f"`{c}`" for c in assets.columns],
        flags[0],
        f"{_format_sql('_words')} AS sbom_format",
        *flags[1:],
    )


def artifact_patterns(
    assets: DataFrame, releases: DataFrame, repositories: DataFrame
) -> DataFrame:
    """Classified artifacts with their release and repository identity.

    The two smaller tables join first, so the artifacts cross the network once,
    on the release key; a release holding a third of them is split at run time
    (see ``session.RUNTIME_CONF``).
    """
    owners = repositories.select(
        F.col("id").alias("repository_id"),
        V.owner_of(F.col("nameWithOwner")).alias("owner"),
        F.col("name").alias("repo"),
        "nameWithOwner",
    )
    owned = releases.select(F.col("id").alias("release_id"), "repository_id").join(
        owners, "repository_id"
    )
    files = assets.select(
        F.col("id").alias("asset_id"),
        "release_id",
        F.col("name").alias("asset_name"),
        F.col("downloadUrl").alias("download_url"),
    )
    return classify_assets(
        files.join(owned, "release_id").select(
            "asset_id", "release_id", "repository_id", "owner", "repo", "nameWithOwner",
            "asset_name", "download_url",
        ),
        "asset_name",
    )
