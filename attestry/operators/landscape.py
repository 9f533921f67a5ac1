"""Landscape documents to project records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions import values as V


def landscape_items(documents: DataFrame) -> DataFrame:
    """Category -> subcategory -> item, one row per item, from either root key."""
    root = F.coalesce("doc.landscape", "doc.categories")
    return (
        documents.select(F.explode(root).alias("c"))
        .select(F.col("c.name").alias("category"), F.explode("c.subcategories").alias("s"))
        .select(
            "category", F.col("s.name").alias("subcategory"), F.explode("s.items").alias("item")
        )
    )


def repository_refs(repo_url: Column, branch: Column, additional: Column) -> Column:
    """The primary repository and the additional ones; URLs of another kind drop out."""

    def ref(url: Column, on_branch: Column, primary: bool) -> Column:
        parts = V.github_ref(url)
        return F.when(
            parts.isNotNull(),
            F.struct(
                parts["owner"].alias("owner"),
                parts["name"].alias("name"),
                F.lit(primary).alias("primary"),
                on_branch.alias("branch"),
            ),
        )

    own = F.array(ref(repo_url, branch, True))
    more = F.transform(additional, lambda a: ref(a["repo_url"], a["branch"], False))
    empty = F.filter(own, lambda _: F.lit(False))
    return F.filter(F.concat(own, F.coalesce(more, empty)), lambda r: r.isNotNull())


def project_records(items: DataFrame) -> DataFrame:
    """Project records of the items that are projects with a known repository."""
    item = lambda f: F.col(f"item.{f}")
    extra = lambda f: F.col(f"item.extra.{f}")
    audits = F.coalesce(F.size(extra("audits")), F.lit(0))
    audits = F.when(extra("audits").isNull(), 0).otherwise(audits)
    last_audit = F.try_element_at(extra("audits"), F.lit(-1))
    records = items.select(
        F.regexp_replace(item("name"), "[^a-zA-Z0-9-_. ]", "").alias("project_name"),
        item("name").alias("display_name"),
        item("description").alias("description"),
        V.normal_maturity(item("project")).alias("maturity"),
        "category",
        "subcategory",
        extra("accepted").alias("date_accepted"),
        extra("incubating").alias("date_incubating"),
        extra("graduated").alias("date_graduated"),
        extra("archived").alias("date_archived"),
        item("homepage_url").alias("homepage_url"),
        item("repo_url").alias("repo_url"),
        extra("package_manager_url").alias("package_manager_url"),
        V.first_filled(extra("docker_url"), item("docker_url")).alias("docker_url"),
        extra("documentation_url").alias("documentation_url"),
        extra("blog_url").alias("blog_url"),
        item("url_for_bestpractices").alias("url_for_bestpractices"),
        extra("clomonitor_name").alias("clomonitor_name"),
        extra("summary_business_use_case").alias("summary_business_use_case"),
        V.first_filled(extra("summary_integrations"), extra("summary_integration")).alias(
            "summary_integrations"
        ),
        extra("summary_personas").alias("summary_personas"),
        extra("summary_tags").alias("summary_tags"),
        extra("summary_use_case").alias("summary_use_case"),
        extra("summary_release_rate").alias("summary_release_rate"),
        extra("dev_stats_url").alias("dev_stats_url"),
        (audits > 0).alias("has_security_audits"),
        audits.cast("int").alias("security_audit_count"),
        last_audit["date"].alias("latest_audit_date"),
        last_audit["vendor"].alias("latest_audit_vendor"),
        item("crunchbase").alias("crunchbase"),
        item("twitter").alias("twitter"),
        extra("parent_project").alias("parent_project"),
        F.array_join(extra("tag"), ",").alias("tag_associations"),
        extra("annual_review_date").alias("annual_review_date"),
        extra("annual_review_url").alias("annual_review_url"),
        item("license").alias("license"),
        item("branch").alias("default_branch"),
        repository_refs(item("repo_url"), item("branch"), item("additional_repos")).alias("repos"),
        V.blank_to_null(item("project")).alias("_project"),
    )
    return records.filter(F.col("_project").isNotNull() & (F.size("repos") > 0)).drop("_project")


def repos_by_maturity(items: DataFrame) -> DataFrame:
    """Primary repositories of every project item with its maturity level."""
    ref = V.github_ref(F.col("item.repo_url"))
    return (
        items.select(V.normal_maturity(F.col("item.project")).alias("maturity"), ref.alias("ref"))
        .filter(F.col("maturity").isin("sandbox", "incubating", "graduated"))
        .filter(F.col("ref").isNotNull())
        .select("maturity", "ref.owner", "ref.name")
    )


def write_repos_by_maturity(repos: DataFrame, path: str) -> None:
    """One folder of JSON lines per maturity level."""
    repos.write.mode("overwrite").partitionBy("maturity").json(path)


def named_projects(records: DataFrame, names: list[str]) -> DataFrame:
    """The records with one of the given display names."""
    return records.filter(F.col("display_name").isin(names))
