"""Insight records, models and analyses on small hand-checked tables."""

import json

import pytest
from pyspark.sql import functions as F

from attestry import schemas
from attestry.operators import insights
from attestry.plans import analyses, models, project_summary, repo_summary, summaries

DOCS = [
    ("full", {
        "header": {"schema-version": "2.0.0", "last-updated": "2024-03-04"},
        "project": {"name": "p"},
        "repository": {
            "url": "u",
            "release": {"attestations": [{"name": "a1", "predicate-uri": "x"}, None, 7, {"name": "a2"}],
                        "dependencies": {"sbom": [{"sbom-format": "SPDX"}]}},
            "security": {"tools": [{"results": {"adhoc": {"name": "t1"}}}, "odd",
                                   {"results": {"ci": {"name": "t2"}, "release": {"name": "t3", "comment": "c"}}}, {}]},
        },
        "attestations": [{"name": "top", "location": "here"}],
        "security-artifacts": {"attestations": [{"name": "art"}]},
        "dependencies": {"sbom": [{"sbom-url": "s"}, {"sbom-file": "f", "comment": "k"}]},
    }),
    ("object", {"header": {"last-updated": "soon"}, "attestations": {"name": "no list"}}),
    ("number", {"header": {"schema-version": 2.0}, "attestations": [{"name": 5}]}),
    ("odd", {"repository": "text", "attestations": [{"name": "kept"}]}),
    ("empty", {}),
]


@pytest.fixture(scope="module")
def documents(spark):
    data = [(k, f"https://github.com/o/{k}/blob/HEAD/x.yml", json.dumps(d)) for k, d in DOCS]
    frame = spark.createDataFrame(data, "repo_id string, source_url string, document string")
    return frame.withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))


def test_attestations(documents, rows):
    got = rows(insights.attestations(documents), "repo_id", "attestation_source", "attestation_name")
    assert got == sorted(
        [
            ("full", "release", "a1"), ("full", "release", None), ("full", "release", "a2"),
            ("full", "tool_adhoc", "t1"), ("full", "tool_ci", "t2"), ("full", "tool_release", "t3"),
            ("full", "top_level", "top"), ("full", "security_artifacts", "art"),
            ("number", "top_level", "5"), ("odd", "top_level", "kept"),
        ],
        key=repr,
    )
    one = insights.attestations(documents).filter("attestation_name = 'a1'").first()
    assert (one["schema_version"], str(one["last_updated"]), one["attestation_predicate_uri"]) == ("2.0.0", "2024-03-04", "x")


def test_sboms(documents, rows):
    assert rows(insights.sboms(documents), "sbom_url", "sbom_file") == [("s", None), (None, "f")]
    both = insights.sboms(documents, with_release_path=True)
    assert rows(both, "sbom_source", "sbom_format") == [
        ("release", "SPDX"), ("top_level", None), ("top_level", None),
    ]
    status = insights.record_status(insights.sboms(documents), "SBOM").first()
    assert status["status"] == "2 SBOM(s) from 1 repo(s)"
    none = insights.record_status(insights.sboms(documents.filter("repo_id = 'empty'")), "SBOM").first()
    assert none["status"] == "no SBOMs found"


@pytest.fixture(scope="module")
def base(spark):
    make = lambda name, data, cols: spark.createDataFrame(data, cols)
    repos = make("r", [("R1", "one", "o/one"), ("R2", "two", "o/two"), ("R3", "three", "o/three")],
                 "id string, name string, nameWithOwner string").withColumns(
        {"url": F.lit("u"), "description": F.lit(None).cast("string")})
    releases = make("l", [
        ("L1", "R1", "v10", "2024-01-01"), ("L2", "R1", "v9", "2024-02-01"), ("L3", "R1", "v11", "2024-03-01"),
        ("L3", "R1", "v11", "2024-03-01"), ("L4", "R2", "v1", "2023-01-01"), ("L9", "R9", "v1", "2023-01-01"),
    ], "id string, repository_id string, tagName string, createdAt string").withColumn(
        "createdAt", F.col("createdAt").cast("timestamp"))
    assets = make("a", [
        ("A1", "L1", "x.spdx.json"), ("A2", "L1", "x.sig"), ("A3", "L2", "sbom.cdx.json"), ("A4", "L3", "x.zip"),
        ("A5", "L4", "x.asc"), ("A6", "L4", "x.vex"), ("A7", "L8", "lost.spdx"), ("A8", "L9", "orphan.spdx"),
    ], "id string, release_id string, name string").withColumn("downloadUrl", F.lit("d"))
    flows = make("w", [
        ("W1", "R1", "a.yml", "syft . && trivy image && docker scout"), ("W2", "R1", "b.yml", "uses: codeql snyk"),
        ("W3", "R2", "c.yml", "cosign sign"), ("W4", "R2", "d.yml", None), ("W5", "R9", "e.yml", "syft"),
    ], "id string, repository_id string, filename string, content string")
    bridge = make("b", [
        ("P", "o", "one", True), ("P", "o", "one", True), ("P", "o", "two", False), ("P", "o", "never", False),
        ("Q", "O", "THREE", True),
    ], "project_name string, owner string, name string, primary boolean")
    project = lambda n, m: tuple([n, f"Project {n}", None, m] + [None] * (len(schemas.PROJECT_COLUMNS) - 4))
    projects = spark.createDataFrame(
        [project("P", "graduated"), project("Q", "sandbox"), project("Z", None)],
        schemas.TABLES["base_cncf_projects"],
    )
    return {
        "base_repositories": repos, "base_releases": releases, "base_release_assets": assets,
        "base_workflows": flows, "base_cncf_projects": projects, "base_cncf_project_repos": bridge,
    }


@pytest.fixture(scope="module")
def run(spark, base, tmp_path_factory):
    return models.run_models(base, str(tmp_path_factory.mktemp("run")))


def test_models_without_inputs_are_left_out(run):
    tables, skipped = run
    assert skipped == ["insight_records"]
    assert {"agg_repo_summary", "agg_cncf_project_summary", "agg_tool_summary"} <= set(tables)


def test_repo_summary(run):
    got = {r["repo"]: r for r in run[0]["agg_repo_summary"].collect()}
    one, two, three = got["one"], got["two"], got["three"]
    assert (one["total_releases"], one["total_assets"], one["total_workflows"]) == (3, 5, 2)
    assert (one["releases_with_sbom_count"], one["releases_with_signatures_count"]) == (2, 1)
    assert one["sbom_adoption_rate"] == pytest.approx(2 / 3)
    # the smallest tag as text, and the tag of the earliest date
    assert (one["first_release_with_sbom"], one["first_sbom_tag_by_date"]) == ("v10", "v10")
    assert str(one["first_sbom_date"])[:10] == "2024-01-01"
    assert (one["sbom_generator_count"], one["scanner_count"], one["signer_count"]) == (1, 2, 0)
    assert one["uses_syft"] and not one["uses_trivy"] and one["uses_container_scanner"]
    assert (two["has_vex_document"], two["has_sbom_artifact"], two["sbom_adoption_rate"]) == (True, False, 0.0)
    assert (two["total_workflows"], two["uses_cosign"], two["first_sbom_date"]) == (2, True, None)
    assert (three["total_releases"], three["has_spdx_sbom"], three["security_maturity_score"]) == (0, False, 0.0)


def test_joined_and_plain_artifacts_count_alike(run, base, rows):
    from attestry.operators.classify import classify_assets

    t = run[0]
    plain = repo_summary.repo_summary(
        t["base_repositories"], t["base_releases"], classify_assets(t["base_release_assets"]),
        t["base_workflows"], t["agg_workflow_tools"],
    )
    assert rows(plain) == rows(t["agg_repo_summary"].drop("security_maturity_score"))


def test_first_tag_by_date_differs_from_smallest_tag(spark):
    releases = spark.createDataFrame(
        [("L1", "R", "v9", "2024-01-01"), ("L2", "R", "v10", "2024-02-01")],
        "id string, repository_id string, tagName string, createdAt string",
    ).withColumn("createdAt", F.col("createdAt").cast("timestamp"))
    from attestry.operators.classify import classify_assets

    patterns = classify_assets(
        spark.createDataFrame([("L1", "a.spdx"), ("L2", "b.spdx")], "release_id string, name string")
    )
    row = repo_summary.artifact_stats(releases, patterns).first()
    assert (row["first_release_with_sbom"], row["first_sbom_tag_by_date"]) == ("v10", "v9")


def test_project_summary(run, base):
    got = {r["project_name"]: r for r in run[0]["agg_cncf_project_summary"].collect()}
    p = got["P"]
    # listed repositories count even when never fetched; a repeated listing counts its sums twice
    assert (p["total_repos"], p["primary_repos"], p["repos_with_sbom"]) == (3, 1, 1)
    assert (p["total_releases"], p["total_sbom_artifacts"]) == (7, 4)
    assert p["sbom_adoption_rate"] == pytest.approx(1 / 3)
    assert (got["Q"]["total_repos"], got["Q"]["repos_using_syft"], got["Q"]["security_maturity_score"]) == (1, 0, None)
    assert (got["Z"]["total_repos"], got["Z"]["sbom_adoption_rate"]) == (0, 0.0)
    folded = project_summary.project_rollup(
        base["base_cncf_project_repos"], run[0]["agg_repo_summary"], case_insensitive=True
    )
    assert folded.filter("project_name = 'Q'").first()["score_count"] == 1


def test_summaries(run, rows):
    t = run[0]
    tools = t["agg_workflow_tools"]
    assert t["agg_executive_summary"].first()["sbom_percentage"] == 33.3
    assert rows(t["agg_tool_summary"].filter("tool_name = 'syft'")) == [("syft", "sbom-generator", 1, 1, 33.3)]
    row = t["agg_sbom_summary"].first()
    assert (row["total_repos"], row["partial_adoption"], row["full_adoption"]) == (1, 1, 0)
    assert t["agg_advanced_artifacts"].first()["repos_with_advanced_artifacts"] == 1
    assert rows(summaries.repos_using_all(tools, ["syft", "codeql"])) == [("o/one",)]
    assert rows(summaries.tool_combinations(t["agg_repo_summary"], 1).select("repo_count")) == [(1,), (1,), (1,)]
    assert rows(analyses.signers_without_sbom(t["agg_repo_summary"])) == [("o/two",)]
    assert dict(rows(analyses.overview(t["agg_repo_summary"])))["Total Repositories"] == "3"
    assert rows(analyses.audited_projects(t["agg_cncf_project_summary"], 20)) == []
    feed = dict(rows(summaries.tools_by_category(tools)))
    assert feed["Sbom Generator"] == "syft: 1 repositories, 1 workflows"


def test_empty_inputs_give_empty_typed_tables(spark):
    tables, skipped = models.run_models(models.with_empty_inputs(spark, {}))
    assert skipped == []
    assert tables["agg_repo_summary"].count() == 0
    row = tables["agg_sbom_summary"].first()
    assert (row["total_repos"], row["spdx_count"]) == (0, None)
    row = tables["agg_executive_summary"].first()
    assert (row["total_repos"], row["sbom_percentage"]) == (0, None)
    assert analyses.format_adoption(tables["agg_cncf_project_summary"]).count() == 2


def test_own_model(base):
    models.register_model(
        "flows", ("base_workflows",), lambda t: {"agg_flows": t["base_workflows"].groupBy("filename").count()}
    )
    try:
        tables, _ = models.run_models({"base_workflows": base["base_workflows"]})
        assert tables["agg_flows"].count() == 5
    finally:
        models.MODELS.pop()
