"""Sinks, run folders, table upkeep and streams."""

import json
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from attestry import schemas
from attestry.operators import search
from attestry.operators.detect import detect_tools
from attestry.plans import models
from attestry.session import RUNTIME_CONF, work_dir
from attestry.sources import readers, writers
from attestry.streaming import ingest


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_parquet_keeps_descriptions_and_compression(spark, tmp_path):
    frame = spark.createDataFrame([("R", 1)], "repository_id string, other int")
    path = str(tmp_path / "t")
    writers.write_parquet(frame, path)
    back = spark.read.parquet(path)
    assert back.schema["repository_id"].metadata["comment"] == schemas.COLUMN_COMMENTS["repository_id"]
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(path))


def test_csv_quotes(spark, tmp_path):
    frame = spark.createDataFrame([('say "hi", you', "é")], "a string, b string")
    writers.write_csv(frame, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert [tuple(r) for r in back.collect()] == [('say "hi", you', "é")]


def test_runs(spark, tmp_path, rows):
    root = str(tmp_path / "runs")
    writers.write_run({"t": spark.range(2).toDF("id")}, root, "2024-01-01")
    writers.write_run({"t": spark.range(5, 6).toDF("id")}, root, "2024-02-01")
    writers.write_run({"t": spark.range(7, 8).toDF("id")}, root, "2024-02-01")
    assert rows(readers.current_run(spark, root, "t"), "id") == [(7,)]
    # Files of older runs are not opened.
    (tmp_path / "runs/t/run_ts=2023-01-01").mkdir()
    (tmp_path / "runs/t/run_ts=2023-01-01/broken.parquet").write_text("no table")
    assert rows(readers.current_run(spark, root, "t"), "id") == [(7,)]
    (tmp_path / "runs/t/run_ts=2023-01-01/broken.parquet").unlink()
    with pytest.raises(ValueError):
        readers.current_run(spark, root, "none")
    both = readers.read_runs(spark, f"{root}/t/run_ts=*")
    assert both.count() == 3 and "run_ts=" in both.first()["source_file"]
    assert writers.count_where(spark, f"{root}/t/run_ts=*", "id > 0").first()[0] == 2


def test_sql_file_views_and_drop(spark, tmp_path, rows):
    path = tmp_path / "q.sql"
    path.write_text("SELECT count(*) AS n FROM agg_small;\n")
    tables = {"agg_small": spark.range(3), "base_small": spark.range(2)}
    assert writers.run_sql_file(spark, str(path), tables).first()["n"] == 3
    models.register_views(tables)
    assert "agg_small" in writers.drop_tables(spark)
    names = [t.name for t in spark.catalog.listTables()]
    assert "agg_small" not in names and "base_small" in names
    profile = {r["table_name"]: r for r in writers.table_profile(tables).collect()}
    assert profile["agg_small"]["row_count"] == 3 and profile["agg_small"]["columns"] == "id bigint"


def test_wide_export_keeps_childless_rows(spark, rows):
    repos = spark.createDataFrame(
        [("R1", "o/1", "u", "d"), ("R2", "o/2", "u", "d"), ("R3", "o/3", "u", "d")],
        "id string, nameWithOwner string, url string, description string")
    releases = spark.createDataFrame(
        [("L1", "R1", "n", "v1", "t"), ("L2", "R2", "n", "v2", "t")],
        "id string, repository_id string, name string, tagName string, createdAt string")
    assets = spark.createDataFrame([("A1", "L1", "x", "d"), ("A2", "L1", "y", "d")],
                                   "id string, release_id string, name string, downloadUrl string")
    wide = writers.wide_artifact_export(repos, releases, assets)
    assert rows(wide, "repository_id", "release_id", "artifact_id") == [
        ("R1", "L1", "A1"), ("R1", "L1", "A2"), ("R2", "L2", None), ("R3", None, None)]
    nested = spark.range(1).select(F.array(F.lit(1)).alias("a"), F.struct(F.lit(2).alias("x")).alias("s"), "id")
    assert tuple(writers.encode_nested(nested).first()) == ("[1]", '{"x":2}', 0)


def test_view_reader_and_counts(spark, tmp_path):
    spark.range(4).selectExpr("id % 2 AS a", "id AS b").write.parquet(str(tmp_path / "v"))
    frame = readers.read_table_view(spark, str(tmp_path / "v"))
    assert tuple(readers.row_and_unique_counts(frame, ["a"]).first()) == (4, 2)
    assert spark.sql("SELECT count(*) FROM data").first()[0] == 4


def test_term_index_in_buckets(spark, tmp_path, rows):
    texts = spark.createDataFrame([(1, "MIT license, mit"), (2, "apache"), (3, None), (4, "permit")], "id int, t string")
    postings = search.term_index(texts, "docs", "id", ["t"])
    assert rows(postings, "id", "term", "tf") == [
        ("1", "license", 1), ("1", "mit", 2), ("2", "apache", 1), ("4", "permit", 1)]
    search.save_term_index(postings, "terms_of_test", str(tmp_path / "index"), buckets=8, salts=2)
    index = spark.table("terms_of_test")
    try:
        found = search.term_hits(index, "mit OR apache")
        assert rows(found, "id", "hits") == [("1", 2), ("2", 1)]
        # Shown in the plan only where the scan is forced to keep its buckets.
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        told = plan_of(search.term_hits(spark.table("terms_of_test"), "mit OR apache"))
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        assert "SelectedBucketsCount: 1 out of 8" in told or "SelectedBucketsCount: 2 out of 8" in told
        wanted = spark.createDataFrame([("a", "mit"), ("a", "mit"), ("b", "apache"), ("b", "none")], "query string, term string")
        joined = search.match_terms(index, wanted.hint("merge"))
        assert rows(joined, "query", "id", "tf") == [("a", "1", 2), ("b", "2", 1)]
        # Only the queries are shuffled by term: neither the join nor the totals move the index.
        for known in (index, search.term_totals(index)):
            told = plan_of(search.match_terms(known, wanted.hint("merge")))
            assert "SortMergeJoin" in told and "Bucketed: true" in told
            assert told.count("Exchange hashpartitioning(term#") == 1
        assert rows(search.term_totals(index), "term", "texts", "hits") == [
            ("apache", 1, 1), ("license", 1, 1), ("mit", 1, 2), ("permit", 1, 1)]
    finally:
        spark.sql("DROP TABLE terms_of_test")


def test_term_index_counts_rows_where_they_are(spark, rows):
    texts = [("a", "MIT mit, of 12 x", None), ("b", "x", "Y y x"), (None, "mit", "-"), (None, "of mit", ""), ("c", "", "x X"),
             ("d", None, None), ("b", "X z", "y"), ("b", "z", None)]
    frame = spark.createDataFrame(texts, "id string, t string, u string")
    want = Counter()
    for key, *fields in texts:
        for field, text in zip("tu", fields):
            for word in re.findall("[a-z]+", (text or "").lower()):
                want[key, field, word] += 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for few in (frame.limit(0), frame, frame.filter("id != 'b'")):
            got = search.term_index(few, "docs", "id", ["t", "u"])
            found = rows(got, "id", "field", "term", "tf")
            ids = {r.id for r in few.collect()}
            assert found == sorted(((*k, n) for k, n in want.items() if k[0] in ids), key=repr)
        # Ids of one row each: texts are dealt out, and no posting is shuffled by term.
        alone = search.term_index(frame.filter("id != 'b'"), "docs", "id", ["t", "u"])
        alone.collect()
        told = alone._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "Exchange hashpartitioning" in told and "term#" not in "".join(re.findall(r"hashpartitioning\(.*", told))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", RUNTIME_CONF["spark.sql.autoBroadcastJoinThreshold"])


def test_ranked_search_order_and_misses(spark):
    texts = spark.createDataFrame(
        [(1, "sbom " + "word " * 50), (2, "sbom sbom"), (3, "syft"), (4, "nothing"), (5, None)], "id int, t string")
    got = search.ranked_search(texts, "id", "t", {"s": "sbom OR spdx", "u": "syft"}, limit=10).collect()
    assert [r["id"] for r in got] == [2, 1, 3]
    assert got[2]["s"] is None and got[2]["u"] > 0


def test_work_dir_uses_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = work_dir(spark, "x")
    assert path != work_dir(spark, "x")
    if base:
        assert path.startswith(base.rstrip("/"))


def response(at, owner, repo, rid, kind="Q"):
    return json.dumps({
        "metadata": {"queryType": kind, "timestamp": at, "owner": owner, "repo": repo},
        "response": {"repository": {"id": rid}},
    })


@pytest.fixture
def log_dir(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "1.jsonl").write_text("\n".join([
        response("2024-01-01T00:00:00Z", "o", "a", "a1"), response("2024-01-01T00:00:00Z", "o", "a", "a1"),
        response("2024-01-02T00:00:00Z", "o", "b", "b2")]))
    (folder / "2.jsonl").write_text("\n".join(['{"metadata": {"queryType": "Q", "ow',
        response("2024-01-01T12:00:00Z", "o", "b", "b1"), response("2024-01-03T00:00:00Z", "o", "a", "a3")]))
    return folder


def test_stream_without_repeats(spark, log_dir, tmp_path, rows):
    stream = lambda: ingest.drop_repeats(
        ingest.with_event_time(ingest.stream_responses(spark, str(log_dir), 1)), ["queryType", "owner", "repo", "ts"]
    ).select("repo", "response.repository.id")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    ingest.run_to_table(stream(), out, state)
    assert rows(spark.read.parquet(out)) == [("a", "a1"), ("a", "a3"), ("b", "b1"), ("b", "b2")]
    # A later run: a row that is years late stays, repeats of the first run don't.
    (log_dir / "3.jsonl").write_text("\n".join([
        response("2019-01-01T00:00:00Z", "o", "c", "c0"), response("2024-01-01T00:00:00Z", "o", "a", "again"),
        response("2024-01-01T00:00:00Z", "o", "a", "kind", "other")]))
    (log_dir / "4.jsonl").write_text(response("2019-01-01T00:00:00Z", "o", "c", "again"))
    ingest.run_to_table(stream(), out, state)
    assert rows(spark.read.parquet(out)) == [
        ("a", "a1"), ("a", "a3"), ("a", "kind"), ("b", "b1"), ("b", "b2"), ("c", "c0")]
    assert len([n for n in os.listdir(f"{state}/commits") if n.isdigit()]) >= 4


def test_snapshot_equals_batch_over_several_runs(spark, log_dir, tmp_path, rows):
    snapshot = ingest.LatestSnapshot(str(tmp_path / "snap"), ["owner", "repo"], ["ts"])
    stream = lambda: ingest.with_event_time(ingest.stream_responses(spark, str(log_dir), 1))
    got = snapshot.run(stream())
    assert rows(got, "repo", "response.repository.id") == [("a", "a3"), ("b", "b2")]
    (log_dir / "3.jsonl").write_text(response("2024-02-01T00:00:00Z", "o", "c", "c1") + "\n"
                                     + response("2024-02-01T00:00:00Z", "o", "b", "b9")
                                     + "\n" + response("2020-02-01T00:00:00Z", "o", "a", "late"))
    seen = []
    got = snapshot.run(stream(), lambda frame, batch: seen.extend(rows(frame, "repo", "response.repository.id")))
    assert got.columns == stream().columns
    assert rows(got, "repo", "response.repository.id") == [("a", "a3"), ("b", "b9"), ("c", "c1")]
    assert sorted(seen) == [("a", "a3"), ("b", "b9"), ("c", "c1")]
    assert rows(snapshot.read(spark, got), "repo") == [("a",), ("b",), ("c",)]


def test_snapshot_batches_read_no_earlier_ones(spark, tmp_path):
    """The rows that a batch puts through its plan follow its own size, and the state written does too."""
    folder = tmp_path / "in"
    snapshot = ingest.LatestSnapshot(str(tmp_path / "snap"), ["k"], ["t"])
    stream = lambda: spark.readStream.schema("k long, t long, v string").parquet(str(folder))
    part = lambda low, high, t: spark.range(low, high).selectExpr("id AS k", f"{t} AS t", f"'{t}' AS v")
    part(0, 2000, 1).write.mode("append").parquet(str(folder))
    snapshot.run(stream())
    part(0, 5, 2).write.mode("append").parquet(str(folder))
    changes = []
    got = snapshot.run(stream(), lambda frame, batch: changes.append(frame.count()))
    assert changes == [5] and got.count() == 2000 and got.filter("v = '2'").count() == 5
    assert list(folder.iterdir()) and not [p for p in (tmp_path / "snap").rglob("*.parquet")]


def test_stream_detection_equals_batch(spark, tmp_path, rows):
    folder = tmp_path / "flows"
    flows = spark.createDataFrame([("1", "syft"), ("2", "x"), ("3", "cosign trivy")], "id string, content string")
    flows.repartition(3).write.parquet(str(folder))
    stream = spark.readStream.schema(flows.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    ingest.run_to_table(detect_tools(stream, "content"), str(tmp_path / "o"), str(tmp_path / "s"))
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == rows(detect_tools(flows, "content"))


def test_responses_by_repo(spark, log_dir, tmp_path, rows):
    log = readers.read_responses(spark, str(log_dir))
    good, _ = readers.split_responses(log)
    writers.write_responses_by_repo(good, str(tmp_path / "by"))
    assert sorted(p for p in os.listdir(tmp_path / "by") if p.startswith("owner")) == ["owner=o"]
    flat = writers.responses_to_table(good)
    assert rows(flat, "query_type", "repo")[0] == ("Q", "a")


def test_text_files_and_response_table(spark, log_dir, tmp_path, rows):
    repos = spark.createDataFrame([("R1", "own/na me")], "id string, nameWithOwner string")
    flows = spark.createDataFrame([("R1", "sub/ci.yml", "x"), ("R1", "e.yml", "")],
                                  "repository_id string, filename string, content string")
    docs = spark.createDataFrame([("R1", ".github/SECURITY.md", "y"), ("R9", "z.md", "z")],
                                 "repository_id string, path string, content string")
    files = writers.text_files(repos, flows, docs)
    writers.write_text_files(files, str(tmp_path / "files"))
    assert rows(spark.read.parquet(str(tmp_path / "files")), "safe_name", "content", "owner") == [
        ("own__na_me__.github__SECURITY.md", "y", "own"), ("own__na_me__workflows__sub__ci.yml", "x", "own")]
    good, _ = readers.split_responses(readers.read_responses(spark, str(log_dir)))
    writers.write_response_table(good, str(tmp_path / "raw"))
    assert [p for p in os.listdir(tmp_path / "raw") if p.startswith("q")] == ["query_type=Q"]


def test_snapshot_of_nothing(spark, tmp_path):
    (tmp_path / "log").mkdir()
    snapshot = ingest.LatestSnapshot(str(tmp_path / "snap"), ["repo"], ["ts"])
    stream = ingest.with_event_time(ingest.stream_responses(spark, str(tmp_path / "log")))
    assert snapshot.run(stream).count() == 0
