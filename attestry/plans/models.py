"""The models of a run, in order, and how to run them.

A model names the tables it reads and returns the tables it makes. Models whose
inputs are missing are left out and the rest go on.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from attestry import schemas
from attestry.operators import classify, detect, insights
from attestry.plans import project_summary, repo_summary, summaries
from attestry.session import work_dir
from attestry.sources.writers import run_sql_file, write_parquet

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    build: Callable[[Tables], Tables]


def _summaries(t: Tables) -> Tables:
    summary, tools = t["agg_repo_summary"], t["agg_workflow_tools"]
    return {
        "agg_executive_summary": summaries.executive_summary(summary),
        "agg_tool_summary": summaries.tool_summary(tools, summary),
        "agg_repo_summary_sorted": summaries.repo_summary_sorted(summary),
        "agg_sbom_summary": summaries.sbom_summary(summary),
        "agg_advanced_artifacts": summaries.advanced_artifacts(t["agg_artifact_patterns"]),
        "agg_tool_category_summary": summaries.tool_category_summary(tools),
        "agg_repo_detail": summaries.repo_detail(summary),
    }


MODELS: list[Model] = [
    Model(
        "artifact_patterns",
        ("base_release_assets", "base_releases", "base_repositories"),
        lambda t: {
            "agg_artifact_patterns": classify.artifact_patterns(
                t["base_release_assets"], t["base_releases"], t["base_repositories"]
            )
        },
    ),
    Model(
        "insight_records",
        ("base_si_documents",),
        lambda t: {
            "agg_si_attestations": insights.attestations(t["base_si_documents"]),
            "base_si_sboms": insights.sboms(t["base_si_documents"]),
        },
    ),
    Model(
        "workflow_tools",
        ("base_workflows", "base_repositories"),
        lambda t: {
            "agg_workflow_tools": detect.workflow_tools(
                t["base_workflows"], t["base_repositories"]
            )
        },
    ),
    Model(
        "repo_summary",
        (
            "base_repositories", "base_releases", "base_workflows", "agg_artifact_patterns",
            "agg_workflow_tools",
        ),
        lambda t: {
            "agg_repo_summary": repo_summary.with_maturity_score(
                repo_summary.repo_summary(
                    t["base_repositories"],
                    t["base_releases"],
                    t["agg_artifact_patterns"],
                    t["base_workflows"],
                    t["agg_workflow_tools"],
                )
            )
        },
    ),
    Model(
        "summaries",
        ("agg_repo_summary", "agg_workflow_tools", "agg_artifact_patterns"),
        _summaries,
    ),
    Model(
        "project_summary",
        ("base_cncf_projects", "base_cncf_project_repos", "agg_repo_summary"),
        lambda t: {
            "agg_cncf_project_summary": project_summary.project_summary(
                t["base_cncf_projects"], t["base_cncf_project_repos"], t["agg_repo_summary"]
            )
        },
    ),
]


def register_model(
    name: str, inputs: tuple[str, ...], build: Callable[[Tables], Tables]
) -> None:
    """Add a model at the end, or replace the one of that name."""
    MODELS[:] = [m for m in MODELS if m.name != name] + [Model(name, tuple(inputs), build)]


SAVED = os.path.join(os.path.dirname(os.path.abspath(__file__)), "saved")


def saved_model(
    name: str, inputs: tuple[str, ...], path: str | None = None, args: dict | None = None
) -> Model:
    """A model whose one table ``name`` a saved SQL statement makes from its inputs, with values for its parameters.

    Without a path it is the statement of that name in this package.
    """
    path = path or os.path.join(SAVED, f"{name}.sql")

    def build(tables: Tables) -> Tables:
        some = tables[inputs[0]]
        return {name: run_sql_file(some.sparkSession, path, {i: tables[i] for i in inputs}, args)}

    return Model(name, tuple(inputs), build)


def with_empty_inputs(spark: SparkSession, tables: Tables) -> Tables:
    """Fill absent base tables with empty typed ones, so that no model is left out."""
    return {
        **{name: schemas.empty_table(spark, name) for name in schemas.TABLES},
        **tables,
    }


def run_models(
    tables: Tables, save_to: str | None = None, listed: list[Model] | None = None
) -> tuple[Tables, list[str]]:
    """Run every model, or every listed one, whose inputs are there.

    With ``save_to`` each result is written as Parquet and read back, so later
    models read a stored table instead of recomputing it, and a lost executor
    costs no more than the step at hand. Returns all tables and the names of
    the models left out.
    """
    done, skipped = dict(tables), []
    for model in MODELS if listed is None else listed:
        if not all(name in done for name in model.inputs):
            skipped.append(model.name)
            continue
        for name, frame in model.build(done).items():
            if save_to is not None:
                path = f"{save_to.rstrip('/')}/{name}"
                write_parquet(frame, path)
                frame = frame.sparkSession.read.parquet(path)
            done[name] = frame
    return done, skipped


def run_stored(spark: SparkSession, tables: Tables) -> tuple[Tables, list[str]]:
    """``run_models`` with the results kept in the shared work folder."""
    return run_models(tables, work_dir(spark, "models"))


def register_views(tables: Tables) -> None:
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
