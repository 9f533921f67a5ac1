"""A whole run: log and project list in, base tables, models and exports out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators import latest
from attestry.operators import normalise as N
from attestry.plans import models
from attestry.session import configure, work_dir
from attestry.sources import readers, writers

Tables = dict[str, DataFrame]


def wanted_responses(log: DataFrame, targets: DataFrame) -> DataFrame:
    """The log records of the listed repositories."""
    keys = targets.select("owner", F.col("name").alias("repo")).distinct()
    named = log.select("*", F.col("metadata.owner").alias("owner"), F.col("metadata.repo").alias("repo"))
    return named.join(keys, ["owner", "repo"], "left_semi").drop("owner", "repo")


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def base_tables(
    spark: SparkSession,
    log_path: str,
    projects_path: str | None = None,
    repo_scope: str = "primary",
    maturity: list[str] | None = None,
    fetched_at: Column | None = None,
) -> tuple[Tables, Tables]:
    """Base tables of a log, and the rows that could not be used.

    Only the newest response of a repository counts, and one of the fuller query
    before one of the older query, so a repository has one row. With a
    project list, only its repositories in the given scope and maturity do. The
    log is parsed once and stored as columns, the newest responses of it and the
    landed insight texts once each; all tables are read from those.
    """
    log, bad_lines = readers.split_responses(
        _stored(readers.read_responses(spark, log_path), "log")
    )
    log = latest.latest_stored_responses(log, prefer=[N.EXTENDED, N.LEGACY])
    tables: Tables = {}
    bad: Tables = {"bad_log_lines": bad_lines}
    if projects_path is not None:
        entries, bad_entries = readers.split_project_list(
            readers.read_project_list(spark, projects_path)
        )
        bad["bad_project_entries"] = bad_entries
        targets = N.keep_maturity(N.explode_targets(entries, repo_scope), maturity)
        log = wanted_responses(log, targets)
        # The list is one JSON array, so its rows are numbered in input order.
        records = N.projects(entries.withColumn("_seq", F.monotonically_increasing_id()), "_seq")
        tables["base_cncf_projects"] = records.drop("repos")
        tables["base_cncf_project_repos"] = N.project_repos(records)
    log = _stored(log, "newest")
    tables.update(N.normalise(log))
    tables["base_repo_files"] = N.with_parsed_content(tables["base_repo_files"])
    landed = _stored(N.land_insights(N.insight_texts(log), fetched_at), "insights")
    tables["base_si_documents"], bad["bad_insights"] = N.split_insights(landed)
    return tables, bad


def analyse(
    spark: SparkSession,
    log_path: str,
    out: str,
    projects_path: str | None = None,
    repo_scope: str = "primary",
    maturity: list[str] | None = None,
) -> tuple[Tables, list[str]]:
    """Build, store and export everything; returns the tables and the models left out.

    Base tables are written first and read back, so that every model starts from
    stored columns rather than from the nested log.
    """
    configure(spark)
    out = out.rstrip("/")
    base, bad = base_tables(spark, log_path, projects_path, repo_scope, maturity)
    counts = writers.write_all(base, f"{out}/parquet") | writers.write_all(bad, f"{out}/bad_rows")
    writers.write_csv(writers.count_table(spark, counts).coalesce(1), f"{out}/csv/row-counts")
    stored = {name: spark.read.parquet(f"{out}/parquet/{name}") for name in base}
    policies = stored["base_security_md"].select("repository_id", "path", "content")
    files = writers.text_files(stored["base_repositories"], stored["base_workflows"], policies)
    writers.write_text_files(files, f"{out}/files")
    tables, skipped = models.run_models(stored, f"{out}/parquet")
    if "base_si_sboms" in tables:
        sboms = writers.sbom_export(tables["base_si_sboms"])
        writers.write_csv(sboms, f"{out}/csv/security-insights-sboms")
        attestations = writers.attestation_export(tables["agg_si_attestations"])
        writers.write_csv(attestations, f"{out}/csv/security-insights-attestations")
    if "agg_repo_summary" in tables:
        writers.write_csv(tables["agg_repo_summary"], f"{out}/csv/repo-summary")
    return tables, skipped
