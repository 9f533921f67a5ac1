"""A whole run from files to files."""

import json

from attestry.plans import run
from test_normalise import LANDSCAPE, line, repository  # noqa: F401
from attestry.operators import normalise as N


def test_whole_run(spark, tmp_path, rows):
    old = repository(nameWithOwner="org/one", description="old")
    new = repository(nameWithOwner="org/one", description="new")
    sandbox = repository(id="R5", name="five", nameWithOwner="org/five")
    lines = [
        line(N.EXTENDED, old, "2024-01-01T00:00:00Z"),
        line(N.EXTENDED, new, "2024-03-01T00:00:00Z"),
        line(N.LEGACY, old, "2024-06-01T00:00:00Z"),
        line(N.EXTENDED, sandbox, name="five"),
        line(N.EXTENDED, repository(id="R7"), name="unlisted"),
        "{broken",
    ]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    projects = [
        {"_comment": "x"},
        {"project_name": "P", "maturity": "graduated", "repos": [{"owner": "org", "name": "one", "primary": True}]},
        {"project_name": "S", "maturity": "sandbox", "repos": [{"owner": "org", "name": "five", "primary": True}]},
    ]
    (tmp_path / "projects.json").write_text(json.dumps(projects))
    out = str(tmp_path / "out")
    tables, skipped = run.analyse(
        spark, str(tmp_path / "log.jsonl"), out, str(tmp_path / "projects.json"), "all", ["graduated"]
    )
    assert skipped == []
    assert rows(tables["base_repositories"], "id", "description") == [("R1", "new")]
    assert tables["agg_repo_summary"].first()["uses_syft"]
    got = {r["project_name"]: r["total_releases"] for r in tables["agg_cncf_project_summary"].collect()}
    assert got == {"P": 2, "S": 0}
    csv = spark.read.option("header", True).csv(f"{out}/csv/repo-summary")
    assert csv.first()["nameWithOwner"] == "org/one"
    assert spark.read.parquet(f"{out}/bad_rows/bad_log_lines").count() == 1
    assert spark.read.parquet(f"{out}/bad_rows/bad_project_entries").count() == 1
    stored = spark.read.parquet(f"{out}/parquet/agg_repo_summary")
    assert stored.schema["owner"].metadata["comment"]


def test_run_without_projects(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text(line(N.LEGACY, repository()))
    tables, skipped = run.analyse(spark, str(tmp_path / "log.jsonl"), str(tmp_path / "out"))
    assert skipped == ["project_summary"]
    assert tables["agg_executive_summary"].first()["total_repos"] == 1
