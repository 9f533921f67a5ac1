"""Small value rules: identities, names, labels, dates and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def owner_of(name_with_owner: Column) -> Column:
    return F.split_part(name_with_owner, F.lit("/"), F.lit(1))


def repo_of(name_with_owner: Column) -> Column:
    return F.split_part(name_with_owner, F.lit("/"), F.lit(2))


def url_part(url: Column, position: int) -> Column:
    return F.split_part(url, F.lit("/"), F.lit(position))


def category_label(category: Column) -> Column:
    """``sbom-generator`` -> ``Sbom Generator``."""
    return F.initcap(F.replace(category, F.lit("-"), F.lit(" ")))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def normal_maturity(level: Column) -> Column:
    """Fold case and the two spellings of incubation; unknown levels are NULL."""
    low = F.lower(level)
    return (
        F.when(low.isin("incubation", "incubating"), "incubating")
        .when(low.isin("graduated", "sandbox", "archived"), low)
    )


def safe_part(value: Column) -> Column:
    """Replace every character that does not belong in a file name."""
    return F.regexp_replace(value, "[^a-zA-Z0-9-_.]", "_")


def safe_path(path: Column) -> Column:
    """Slashes become ``__``, but not those inside the final extension."""
    has_ext = F.contains(path, F.lit("."))
    ext = F.concat(F.lit("."), F.substring_index(path, ".", -1))
    base = F.substring(path, F.lit(1), F.length(path) - F.length(ext))
    flat = lambda c: F.replace(c, F.lit("/"), F.lit("__"))
    return F.when(has_ext, F.concat(flat(base), ext)).otherwise(flat(path))


def file_type(path: Column) -> Column:
    """Kind of a repository file by its ending."""
    low = F.lower(path)
    return (
        F.when(low.rlike(r"\.(yml|yaml)$"), "yml")
        .when(low.rlike(r"\.(md|markdown)$"), "markdown")
        .when(low.rlike(r"(^|/)dockerfile$"), "dockerfile")
        .otherwise("text")
    )


def github_ref(url: Column) -> Column:
    """Owner and name of a repository URL; NULL when the URL is not one.

    A trailing slash or a deeper path is no match.
    """
    pattern = r"github\.com/([^/]+)/([^/]+)$"
    return F.when(
        url.rlike(pattern),
        F.struct(
            F.regexp_extract(url, pattern, 1).alias("owner"),
            F.regexp_extract(url, pattern, 2).alias("name"),
        ),
    )


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``100 * part / whole`` rounded; NULL for an empty whole."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def count_if(condition: Column) -> Column:
    """How many rows hold; 0 for none."""
    return F.count(F.when(condition, F.lit(1)))


def sum_flag(condition: Column) -> Column:
    """How many rows hold; NULL over no rows at all, as SUM is."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))
