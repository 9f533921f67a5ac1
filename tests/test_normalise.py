"""Nested records to base tables, on a small log with awkward lines."""

import json

import pytest
from pyspark.sql import functions as F

from attestry import schemas
from attestry.functions import values as V
from attestry.operators import inventory, landscape, latest
from attestry.operators import normalise as N
from attestry.sources import readers


def blob(text):
    return {"__typename": "Blob", "id": "b", "text": text}


def repository(**more):
    base = {
        "id": "R1", "name": "one", "nameWithOwner": "org/one", "url": "https://github.com/org/one",
        "licenseInfo": {"key": "mit", "name": "MIT", "spdxId": ""},
        "defaultBranchRef": {"name": "main", "branchProtectionRule": {"pattern": "main", "allowsDeletions": False}},
        "branchProtectionRules": {"nodes": [None, {"pattern": "a"}, None, {"pattern": "b", "requiredApprovingReviewCount": 2}]},
        "releases": {"nodes": [
            None,
            {"id": "L1", "name": None, "tagName": "v1", "url": "u", "createdAt": "2024-01-02T03:04:05Z",
             "releaseAssets": {"nodes": [None, {"id": "A1", "name": "x.sig", "downloadUrl": "d"}]}},
            {"id": "L2", "name": "two", "tagName": "v2", "url": "u", "createdAt": "never",
             "releaseAssets": {"nodes": None}},
        ]},
        "workflows": {"__typename": "Tree", "entries": [
            {"name": "ci.yml", "object": blob("syft")},
            {"name": "docs", "object": {"__typename": "Tree"}},
            {"name": "run.sh", "object": blob("echo")},
            {"name": "none.yml", "object": blob("")},
        ]},
        "securityPolicy": blob("# Report"),
        "insightsFileRootUpper": blob("header:\n  schema-version: 1.2.0\n"),
        "insightsFileRootLower": blob("header: {}\n"),
    }
    return {**base, **more}


def line(kind, repo, at="2024-05-01T00:00:00Z", owner="org", name="one"):
    meta = {"queryType": kind, "timestamp": at, "owner": owner, "repo": name}
    return json.dumps({"metadata": meta, "response": {"repository": repo}})


@pytest.fixture
def log(spark, tmp_path):
    second = {
        "id": "R2", "name": "two", "nameWithOwner": "org/two",
        "releases": {"nodes": [{"id": "L3", "name": None, "tagName": "v1", "url": "u", "createdAt": "2023-01-01T00:00:00Z",
                                "releaseAssets": {"nodes": [{"id": "A2", "name": "y", "downloadUrl": "d"}]}}]},
    }
    lines = [
        line(N.EXTENDED, repository()),
        line(N.EXTENDED, None, name="gone"),
        line(N.LEGACY, second, name="two"),
        line("Other", repository(id="R9"), name="nine"),
        '{"metadata": {"queryType": "GetRepoDataExt',
    ]
    path = tmp_path / "log.jsonl"
    path.write_text("\n".join(lines) + "\n")
    return readers.read_responses(spark, str(path))


def test_bad_lines_are_kept_apart(log):
    good, bad = readers.split_responses(log.cache())
    assert good.count() == 4
    assert bad.select(readers.CORRUPT).first()[0].startswith('{"metadata": {"queryType": "GetRepoDataExt')


def test_base_tables(log, rows):
    tables = N.normalise(readers.split_responses(log)[0])
    assert set(tables) <= set(schemas.TABLES)
    for name, frame in tables.items():
        assert frame.columns == schemas.TABLES[name].fieldNames(), name
    assert rows(tables["base_repositories"], "id", "__typename", "license_key", "license_spdxId", "defaultBranch_name") == [
        ("R1", "Repository", "mit", None, "main"), ("R2", None, None, None, None),
    ]
    assert rows(tables["base_branch_protection_rules"], "id", "pattern", "isDefaultBranch", "requiredApprovingReviewCount") == [
        ("R1_default", "main", True, None), ("R1_rule_0", "a", False, None), ("R1_rule_1", "b", False, 2),
    ]
    releases = {r["id"]: r for r in tables["base_releases"].collect()}
    assert (releases["L1"]["name"], releases["L3"]["name"]) == (None, "")
    assert releases["L1"]["createdAt"].isoformat().startswith("2024-01-02")
    assert releases["L2"]["createdAt"] is None
    assert rows(tables["base_release_assets"], "id", "release_id") == [("A1", "L1"), ("A2", "L3")]
    assert rows(tables["base_workflows"], "id", "content") == [
        ("R1_ci.yml", "syft"), ("R1_none.yml", ""), ("R1_run.sh", "echo"),
    ]
    assert rows(tables["base_security_md"], "repository_id", "content") == [("R1", "# Report")]
    assert rows(tables["base_repo_files"], "path", "type") == [
        (".github/workflows/ci.yml", "yml"), (".github/workflows/run.sh", "text"),
        ("SECURITY-INSIGHTS.yml", "yml"), ("SECURITY.md", "markdown"), ("security-insights.yml", "yml"),
    ]
    counts = {r["table_name"]: r["row_count"] for r in N.row_counts(tables).collect()}
    assert counts["base_releases"] == 3 and counts["base_repo_files"] == 5


def test_new_normaliser(log, rows):
    N.register_normaliser("Other", lambda part: {"base_repositories": N.legacy_repositories(part)})
    try:
        tables = N.normalise(log)
        assert ("R9",) in rows(tables["base_repositories"], "id")
    finally:
        del N.NORMALISERS["Other"]


def test_insight_file_order_and_version(log, rows):
    texts = N.insight_texts(log.filter("metadata.queryType <> 'Other'"))
    assert rows(texts, "repo_id", "source_url") == [
        ("R1", "https://github.com/org/one/blob/HEAD/SECURITY-INSIGHTS.yml")
    ]
    good, bad = N.split_insights(N.land_insights(texts))
    assert rows(good, "schema_version") == [("1.2.0",)] and bad.count() == 0


def test_version_spellings(spark, rows):
    texts = spark.createDataFrame(
        [
            ("a", "u", "header:\n  schemaVersion: 2.1.0\n"),
            ("b", "u", "header: {}\n"),
            ("c", "u", "x: 1\n"),
            ("d", "u", "a: [1\n"),
            ("e", "u", "a: 1\na: 2\n"),
            ("f", "u", "header:\n  schema-version: 3.0.0\n  last-updated: 2024-05-06\nflag: yes\n"),
        ],
        "repo_id string, source_url string, content string",
    )
    good, bad = N.split_insights(N.land_insights(texts, F.lit("2024-01-01").cast("timestamp")))
    assert rows(good, "repo_id", "schema_version") == [
        ("a", "2.1.0"), ("b", "unknown"), ("c", "unknown"), ("f", "3.0.0"),
    ]
    assert rows(bad, "repo_id") == [("d",), ("e",)]
    text = {r["repo_id"]: json.loads(r["document"]) for r in good.collect()}["f"]
    assert text["header"]["last-updated"] == "2024-05-06" and text["flag"] == "yes"
    assert rows(N.insight_version_classes(good)) == [("other", 1), ("unknown", 2), ("v2", 1)]


def test_latest_response_and_lookup(spark, rows, tmp_path):
    lines = [
        line("Q", {"id": "old"}, "2024-01-01T00:00:00Z"),
        line("Q", {"id": "new"}, "2024-02-01T00:00:00Z"),
        line("P", {"id": "other"}, "2024-01-15T00:00:00Z"),
        line("Q", {"id": "alone"}, "2024-01-01T00:00:00Z", name="two"),
    ]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    log = readers.read_responses(spark, str(tmp_path / "log.jsonl"))
    newest = latest.latest_responses(log)
    assert rows(newest, "response.repository.id") == [("alone",), ("new",), ("other",)]
    assert latest.response_for(log, "org", "one").first()["response"]["repository"]["id"] == "new"
    assert latest.response_for(log, "org", "none").count() == 0


def test_upsert_keeps_newest_and_prefers_arrivals(spark, rows):
    ddl = "repo_id string, source_url string, schema_version string, document string, fetched_at timestamp"
    at = lambda day: f"2024-01-{day:02d} 00:00:00"
    make = lambda data: spark.createDataFrame(data, ddl.replace("timestamp", "string")).withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp")
    )
    stored = make([("a", "u", "1", "{}", at(1)), ("b", "u", "1", "{}", at(5)), ("c", "u", "1", "{}", at(2))])
    arrived = make([("a", "u", "2", "{}", at(1)), ("b", "u", "2", "{}", at(4)), ("d", "u", "2", "{}", at(1))])
    assert rows(latest.upsert_documents(stored, arrived), "repo_id", "schema_version") == [
        ("a", "2"), ("b", "1"), ("c", "1"), ("d", "2"),
    ]


PROJECTS = [
    {"_comment": "an entry that is neither target nor project"},
    {"owner": "sigstore", "name": "cosign"},
    {"project_name": "P", "display_name": "first", "maturity": "sandbox", "repos": [{"owner": "o", "name": "x", "primary": True}]},
    {"project_name": "P", "display_name": "last", "maturity": "graduated", "repos": [
        {"owner": "o", "name": "a", "primary": True}, {"owner": "o", "name": "b", "primary": False}]},
    {"project_name": "Q", "repos": [{"owner": "q", "name": "a", "primary": True, "branch": "dev"}]},
]


def test_project_list(spark, rows, tmp_path):
    path = tmp_path / "projects.json"
    path.write_text(json.dumps(PROJECTS))
    usable, bad = readers.split_project_list(readers.read_project_list(spark, str(path)))
    assert (usable.count(), bad.count()) == (4, 1)
    target = lambda scope: rows(N.explode_targets(usable, scope), "owner", "name")
    assert target("primary") == [("o", "a"), ("o", "x"), ("q", "a"), ("sigstore", "cosign")]
    assert target("all") == [("o", "a"), ("o", "b"), ("o", "x"), ("q", "a"), ("sigstore", "cosign")]
    with pytest.raises(ValueError):
        N.explode_targets(usable, "some")
    kept = N.keep_maturity(N.explode_targets(usable, "all"), ["sandbox"])
    assert rows(kept, "owner", "name") == [("o", "x"), ("q", "a"), ("sigstore", "cosign")]
    assert N.keep_maturity(usable, []) is usable
    records = N.projects(usable.withColumn("seq", F.monotonically_increasing_id()), "seq")
    assert rows(records, "project_name", "display_name") == [("P", "last"), ("Q", None)]
    assert rows(N.project_repos(records)) == [
        ("P", "o", "a", True, None), ("P", "o", "b", False, None), ("Q", "q", "a", True, "dev"),
    ]


LANDSCAPE = """
landscape:
  - name: Obs
    subcategories:
      - name: Tracing
        items:
          - name: "Tool (One)!"
            project: Graduated
            repo_url: https://github.com/org/one
            branch: main
            docker_url: https://d
            additional_repos:
              - repo_url: https://github.com/org/extra
                branch: dev
              - repo_url: https://gitlab.com/org/else
            extra:
              accepted: 2020-01-02
              summary_integration: old name
              audits:
                - date: 2020-05-05
                  vendor: A
                - date: 2021-05-05
                  vendor: B
              tag: [x, y]
          - name: NotAProject
            repo_url: https://github.com/org/none
          - name: Slash
            project: incubation
            repo_url: https://github.com/org/slash/
          - name: Odd
            project: retired
            repo_url: https://github.com/org/odd
      - name: Empty
  - name: Nothing
"""


def test_landscape(spark, rows, tmp_path):
    (tmp_path / "a.yml").write_text(LANDSCAPE)
    (tmp_path / "b.yml").write_text(
        LANDSCAPE.replace("landscape:", "categories:").replace("Graduated", "INCUBATING")
    )
    items = landscape.landscape_items(readers.read_landscape(spark, str(tmp_path)))
    assert items.count() == 8
    records = landscape.project_records(items).cache()
    assert rows(records, "project_name", "maturity") == [
        ("Odd", None), ("Odd", None), ("Tool One", "graduated"), ("Tool One", "incubating"),
    ]
    one = records.filter("maturity = 'graduated'").first()
    assert [(r["owner"], r["name"], r["primary"], r["branch"]) for r in one["repos"]] == [
        ("org", "one", True, "main"), ("org", "extra", False, "dev"),
    ]
    assert (one["has_security_audits"], one["security_audit_count"]) == (True, 2)
    assert (one["latest_audit_date"], one["latest_audit_vendor"]) == ("2021-05-05", "B")
    assert (one["date_accepted"], one["tag_associations"]) == ("2020-01-02", "x,y")
    assert (one["summary_integrations"], one["docker_url"]) == ("old name", "https://d")
    odd = records.filter("project_name = 'Odd'").first()
    assert (odd["has_security_audits"], odd["security_audit_count"], odd["latest_audit_date"]) == (False, 0, None)
    assert set(schemas.PROJECT_COLUMNS) | {"repos"} == set(records.columns)
    assert rows(landscape.repos_by_maturity(items)) == [
        ("graduated", "org", "one"), ("incubating", "org", "one"),
    ]
    assert landscape.named_projects(records, ["Odd"]).count() == 2


def test_inventories(spark, rows):
    files = spark.createDataFrame(
        [(1, "# Heading 1\ntext # no\n## Heading 2\n#none"), (2, "FROM a\n  COPY b c \nrun x\n\nRUN y\nCMD z"), (3, None)],
        "id int, t string",
    )
    assert rows(inventory.headings(files, "id", "t")) == [(1, 0, "# Heading 1"), (1, 1, "## Heading 2")]
    lines = inventory.instructions(files, "id", "t")
    assert rows(lines.filter("id = 2"), "ordinal", "line", "instruction") == [
        (0, "FROM a", "FROM"), (1, "COPY b c", "COPY"), (2, "RUN y", "RUN"), (3, "CMD z", "CMD"),
    ]
    good, bad = inventory.land_yaml(
        spark.createDataFrame([(1, "foo: bar\nlist: [a, b]"), (2, "x: [")], "id int, t string"), "id", "t"
    )
    assert json.loads(good.first()["document"]) == {"foo": "bar", "list": ["a", "b"]}
    assert rows(bad, "id") == [(2,)]


def test_names_and_paths(spark):
    frame = spark.createDataFrame([(".github/security-insights.yml", "a/b c", "sbom-generator")], "p string, o string, c string")
    row = frame.select(
        V.safe_path(F.col("p")), V.safe_part(F.col("o")), V.category_label(F.col("c")),
        V.safe_path(F.lit("a/Makefile")), V.owner_of(F.lit("x")), V.repo_of(F.lit("x")),
        V.file_type(F.lit("a/Dockerfile")), V.file_type(F.lit("README.md")),
    ).first()
    assert tuple(row) == (
        ".github__security-insights.yml", "a_b_c", "Sbom Generator", "a__Makefile", "x", "", "dockerfile", "markdown",
    )


def test_yaml_is_parsed_once_in_many_tasks(spark, rows):
    texts = spark.createDataFrame(
        [(f"R{i}", "u", "a: [1" if i % 10 == 0 else f"a: {i % 3}\n") for i in range(400)], "repo_id string, source_url string, content string"
    ).coalesce(1)
    good, bad = N.split_insights(N.land_insights(texts))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_convert(") == 1  # not once for the filter and once for the result
    # one task would read the whole file otherwise
    assert good.select(F.spark_partition_id()).distinct().count() > 1
    assert {(r.document, r["count"]) for r in good.groupBy("document").count().collect()} == {
        ('{"a": %d}' % k, sum(1 for i in range(400) if i % 10 and i % 3 == k)) for k in range(3)}
    assert bad.count() == 40
