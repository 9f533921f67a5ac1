"""Stored logs, upserts, parsed files, guards, counted and rebalanced writes, saved statements."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_io import plan_of, response

from attestry.operators import latest, search
from attestry.operators import normalise as N
from attestry.plans import models, summaries
from attestry.sources import folders, readers, writers


@pytest.fixture
def stored_log(spark, tmp_path):
    lines = [
        response("2024-01-01T00:00:00Z", "o", "a", "a1", N.EXTENDED), response("2024-03-01T00:00:00Z", "o", "a", "a2", N.LEGACY),
        response("2024-02-01T00:00:00Z", "o", "a", "a3", N.EXTENDED), response("2024-01-01T00:00:00Z", "o", "b", "b1", N.LEGACY),
        response(None, "o", "c", "c1"), response("2024-01-01T00:00:00Z", "o", "c", "c2"), "{broken",
    ]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    log = readers.read_responses(spark, str(tmp_path / "log.jsonl"))
    log.repartition(3).write.parquet(str(tmp_path / "log"))
    return readers.split_responses(spark.read.schema(log.schema).parquet(str(tmp_path / "log")))[0]


@pytest.mark.parametrize("prefer", [None, [N.EXTENDED, N.LEGACY]])
def test_latest_of_a_stored_log(stored_log, rows, prefer):
    names = ("metadata.queryType", "response.repository.id")
    got = latest.latest_stored_responses(stored_log, prefer)
    assert rows(got, *names) == rows(latest.latest_responses(stored_log, prefer), *names)
    assert got.schema == stored_log.schema


def test_ranking_of_a_stored_log_leaves_responses_behind(spark, stored_log):
    """Below the window, the scan reads no response and none is shuffled; responses are read for the semi join only."""
    told = plan_of(latest.latest_stored_responses(stored_log))
    ranked = told[told.index("Window [") :]
    assert "Exchange hashpartitioning(_type" in ranked
    assert "response" not in ranked and "LeftSemi" in told


def test_equal_times_the_row_stored_last_wins(spark, tmp_path, rows):
    log = spark.createDataFrame(
        [(("Q", "2024", "o", "a"), i) for i in range(9)],
        "metadata struct<queryType:string,timestamp:string,owner:string,repo:string>, response int",
    )
    log.coalesce(1).write.parquet(str(tmp_path / "t"))
    assert rows(latest.latest_stored_responses(spark.read.parquet(str(tmp_path / "t"))), "response") == [(8,)]


KEYED = "repo_id string, source_url string, schema_version string, document string, fetched_at timestamp"


def documents(spark, version, keys, day):
    data = [(f"R{k}", f"u{k}", version, "{}") for k in keys]
    frame = spark.createDataFrame(data, ", ".join(KEYED.split(", ")[:4]))
    return frame.withColumn("fetched_at", F.lit(day).cast("timestamp"))


def files_of(path):
    return {p.parent.name: {q.name for q in p.parent.iterdir()} for p in Path(path).glob("part=*/*.parquet")}


def test_upsert_in_place_leaves_other_folders_alone(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    latest.upsert_in_place(documents(spark, "1", range(200), "2024-01-01"), path, 8)
    before = files_of(path)
    assert len(before) == 8
    latest.upsert_in_place(documents(spark, "2", [3], "2024-02-01").unionByName(documents(spark, "0", [3], "2020-01-01")), path, 8)
    after = files_of(path)
    assert sum(before[name] != after[name] for name in before) == 1 and set(before) == set(after)
    table = spark.read.parquet(path)
    assert table.count() == 200 and rows(table.filter("schema_version <> '1'"), "repo_id", "schema_version") == [("R3", "2")]
    latest.upsert_in_place(documents(spark, "0", [3, 4], "2020-01-01"), path, 8)
    latest.upsert_in_place(documents(spark, "9", [], "2025-01-01"), path, 8)
    assert rows(spark.read.parquet(path), "schema_version").count(("0",)) == 0
    # With equal times the arriving row wins, as in the batch form.
    latest.upsert_in_place(documents(spark, "3", [3], "2024-02-01"), path, 8)
    assert rows(spark.read.parquet(path).filter("repo_id = 'R3'"), "schema_version") == [("3",)]


def test_first_upsert_keeps_one_row_a_key(spark, tmp_path):
    twice = documents(spark, "1", [1, 2], "2024-01-01").unionByName(documents(spark, "2", [1], "2024-02-01"))
    latest.upsert_in_place(twice, str(tmp_path / "t"), 4)
    assert sorted(r.schema_version for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["1", "2"]


def test_parsed_files(spark, tmp_path):
    files = spark.createDataFrame(
        [("a", "yml", "on: push\njobs:\n  - {n: 1, day: 2024-01-02}\n"), ("b", "yml", "a: [1"), ("c", "markdown", "# One\ntext\n## Two\n"),
         ("d", "markdown", "none"), ("e", "text", "# no: yaml"), ("f", "yml", None)], "id string, type string, content string")
    N.with_parsed_content(files).write.parquet(str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f"))
    assert dict(back.dtypes)["parsed_json"] == "variant"
    got = {r.id: r for r in back.select(
        "id", "markdown_headings", F.to_json("parsed_json").alias("json"),
        F.try_variant_get("parsed_json", "$.jobs[0].n", "int").alias("n")).collect()}
    assert (got["a"].n, json.loads(got["a"].json)) == (1, {"on": "push", "jobs": [{"n": 1, "day": "2024-01-02"}]})
    assert [got[k].json for k in "bcdef"] == [None] * 5
    assert [got[k].markdown_headings for k in "acde"] == [None, ["# One", "## Two"], [], None]


def test_status_rows_of_empty_tables(spark, rows):
    some = spark.createDataFrame([(3,)], "total_repos long")
    assert rows(summaries.sbom_summary_status(some)) == [("✓ Created agg_sbom_summary", 3)]
    assert rows(summaries.sbom_summary_status(some.filter("total_repos > 9"))) == [("✓ Created agg_sbom_summary (no SBOMs)", 0)]
    unknown = spark.createDataFrame([(None,)], "repos_with_advanced_artifacts long")
    assert rows(summaries.advanced_artifacts_status(unknown)) == [("✓ Created agg_advanced_artifacts", 0)]
    assert rows(summaries.advanced_artifacts_status(unknown.limit(0))) == [("✓ Created agg_advanced_artifacts (none detected)", 0)]


def test_writes_count_their_rows(spark, tmp_path, rows):
    frames = {"one": spark.range(7), "none": spark.range(0), "many": spark.range(1000).repartition(5)}
    counts = writers.write_all(frames, str(tmp_path))
    assert counts == {"one": 7, "none": 0, "many": 1000}
    assert rows(writers.count_table(spark, counts)) == [("many", 1000), ("none", 0), ("one", 7)]


@pytest.fixture
def small_parts(spark):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_folders_are_written_by_several_tasks(spark, tmp_path, small_parts):
    names = F.expr("CASE WHEN id < 4000 THEN 'hot' ELSE string(id % 50) END")
    log = spark.range(5000).select(
        F.struct(F.lit("o").alias("owner"), names.alias("repo")).alias("metadata"),
        F.struct(F.sha2(F.col("id").cast("string"), 256).alias("text")).alias("response"))
    writers.write_responses_by_repo(log.repartition(8), str(tmp_path / "by"))
    assert len(list((tmp_path / "by/owner=o/repo=hot").glob("*.json"))) > 2
    hot, all_files = (len(list((tmp_path / "by/owner=o").glob(f"{x}/*.json"))) for x in ("repo=hot", "repo=*"))
    assert hot > (all_files - hot) / 50  # more files than a small repository has
    assert spark.read.json(str(tmp_path / "by")).count() == 5000
    files = spark.range(5000).select(names.alias("owner"), F.col("id").cast("string").alias("safe_name"), F.sha2(F.col("id").cast("string"), 256).alias("content"))
    writers.write_text_files(files.repartition(8), str(tmp_path / "files"))
    assert len(list((tmp_path / "files/owner=hot").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "files")).distinct().count() == 5000


def test_saved_statements(spark, tmp_path, rows):
    (tmp_path / "some.sql").write_text("-- of some size\nSELECT id FROM base_numbers WHERE id >= :least AND 'x' <> :other;\n")
    numbers = spark.range(5)
    got = writers.run_sql_file(spark, str(tmp_path / "some.sql"), {"base_numbers": numbers}, {"least": 3, "other": "'; DROP"})
    assert rows(got) == [(3,), (4,)]
    assert rows(writers.run_sql_file(spark, f"file://{tmp_path}/some.sql", {"base_numbers": numbers}, {"least": 4, "other": ""})) == [(4,)]
    listed = [
        models.saved_model("lost", ("base_absent",), str(tmp_path / "some.sql")),
        models.saved_model("kept", ("base_numbers",), str(tmp_path / "some.sql"), {"least": 2, "other": ""}),
    ]
    tables, left_out = models.run_models({"base_numbers": numbers}, str(tmp_path / "out"), listed)
    assert left_out == ["lost"] and rows(tables["kept"]) == [(2,), (3,), (4,)]
    assert os.path.isdir(tmp_path / "out/kept")
    assert {f"{m}.sql" for m in ("signer_adoption", "project_audits", "scorecard_checks")} <= set(os.listdir(models.SAVED))


def test_workflow_search(spark):
    flows = spark.createDataFrame(
        [("1", "R1", "a.yml", "sbom sbom syft"), ("2", "R1", "b.yml", "anchore only"), ("3", "R2", "c.yml", "trivy"),
         ("4", "R9", "d.yml", "sbom"), ("5", "R2", "e.yml", None), ("6", "R2", "f.yml", "spdx " + "word " * 30)],
        "id string, repository_id string, filename string, content string")
    repos = spark.createDataFrame([("R1", "o/1", "x"), ("R2", "o/2", None)], "id string, nameWithOwner string, description string")
    scores = {"sbom": "sbom OR spdx", "tool": "syft OR trivy OR anchore"}
    got = search.workflow_search(flows, repos, scores, "sbom OR spdx OR syft OR trivy").collect()
    assert [r.filename for r in got] == ["a.yml", "f.yml", "c.yml"]
    assert got[2].sbom is None and got[2].tool > 0
    plain = {r.id: r for r in search.bm25_scores(flows, "content", scores).collect()}
    assert got[0].sbom == pytest.approx(plain["1"].sbom) and got[0].tool == pytest.approx(plain["1"].tool)


def test_upserts_deal_rows_by_key_only(spark, tmp_path):
    """Dealt a second time, by folder, each folder would be one task's work and every document would move twice."""
    name, path = "spark.sql.adaptive.coalescePartitions.enabled", str(tmp_path / "t")
    spread_out = lambda: all(len([f for f in files if f.endswith(".parquet")]) > 1 for files in files_of(path).values())
    spark.conf.set(name, "false")
    try:
        latest.upsert_in_place(documents(spark, "1", range(200), "2024-01-01"), path, 4)
        assert spread_out()
        latest.upsert_in_place(documents(spark, "2", range(0, 200, 2), "2024-02-01"), path, 4)
    finally:
        spark.conf.set(name, "true")
    assert spread_out()
    got = spark.read.parquet(path)
    assert got.count() == 200 and got.filter("schema_version = '2'").count() == 100


def test_small_folders_are_written_by_all_tasks(spark, tmp_path, rows):
    repo = F.expr("IF(id % 40 = 0, NULL, string(id % 40))")
    log = spark.range(80).select(
        F.struct(F.lit("o").alias("owner"), repo.alias("repo")).alias("metadata"), F.struct(F.col("id").alias("n")).alias("response"))
    writers.write_responses_by_repo(log.coalesce(1), str(tmp_path / "by"))
    files = list((tmp_path / "by").glob("owner=o/repo=*/*.json"))
    assert len(files) == 40 and len({f.name.split("-")[1] for f in files}) > 1  # numbers of the tasks
    back = spark.read.schema("response struct<n: long>, owner string, repo string").json(str(tmp_path / "by"))
    assert rows(back.select("repo", "response.n")) == rows(log.select("metadata.repo", "response.n"))


def test_repository_folders_are_made_without_hadoops_disk(spark, tmp_path, rows, monkeypatch):
    """Hadoop's local file system starts processes for each folder and file, and leaves a checksum beside each."""
    names = ["a", "b/c", "x=y z", "\u00fc%41", "#1 '\"*:?\\\\{}[]^", "t\ta\u007fb", "..", "", None, "__HIVE_DEFAULT_PARTITION__", "A"]
    data = [(o, r, n if n % 5 else None) for n, (o, r) in enumerate((o, r) for o in names for r in names + names[:2])]
    schema = "metadata struct<owner: string, repo: string>, response struct<n: long, t: string, u: string>"
    log = spark.createDataFrame([((o, r), None if n is None else (n, "l\n\u2028\"", None)) for o, r, n in data], schema)
    folders_in = lambda at: {str(x.parent.relative_to(at)) for x in at.glob("*/*/part-*")}
    monkeypatch.setattr(folders, "READ_BYTES", 30)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        (tmp_path / "by").mkdir()
        (tmp_path / "by/old").write_text("replaced")
        writers.write_responses_by_repo(log.repartition(3), str(tmp_path / "by"))
        back = readers.read_responses_by_repo(spark, str(tmp_path / "by"), log.schema["response"].dataType)
        got = rows(back.select("owner", "repo", "response"))
        with monkeypatch.context() as other:
            other.setattr(folders, "local_path", lambda *_: None)
            writers.write_responses_by_repo(log, str(tmp_path / "spark"))
            want = rows(readers.read_responses_by_repo(spark, str(tmp_path / "spark"), log.schema["response"].dataType).select("owner", "repo", "response"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(data) and got == want
    assert folders_in(tmp_path / "by") == folders_in(tmp_path / "spark")
    assert not [x.name for x in (tmp_path / "by").glob("*/*/*") if not x.name.startswith("part-")]
    assert {x.name for x in tmp_path.iterdir()} == {"by", "spark"} and not (tmp_path / "by/old").exists()
    by_spark = spark.read.schema("response struct<n: long, t: string, u: string>, owner string, repo string").json(str(tmp_path / "by"))
    assert rows(by_spark.select("owner", "repo", "response")) == want
    writers.write_responses_by_repo(log.limit(0), str(tmp_path / "by"))
    assert readers.read_responses_by_repo(spark, str(tmp_path / "by"), log.schema["response"].dataType).count() == 0
