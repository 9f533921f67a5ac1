"""Shapes of the physical plans, and results under one hot key."""

import re

import pytest
from pyspark.sql import functions as F

from attestry.operators import latest
from attestry.operators.classify import artifact_patterns, classify_assets
from attestry.operators.detect import workflow_tools
from attestry.operators.joins import left_join_many
from attestry.plans import analyses, project_summary, summaries
from workload.given import Given

FOLDER = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def given(spark):
    return Given(spark, FOLDER)


def test_all_tool_rules_take_one_pass(given):
    text = plan(workflow_tools(given.event_workflows, given.repositories))
    assert text.count("events.parquet") == 1 and text.count("regexp_replace") == 1


def test_long_unions_are_one_aggregate(given):
    assert plan(analyses.overview(given.summary)).count("lineitem.parquet") == 1
    # tool columns need no artifacts at all: those joins are pruned
    text = plan(analyses.top_tools(given.summary))
    assert "lineitem.parquet" not in text and text.count("events.parquet") == 1


def test_filters_do_not_repeat_text_work(given):
    text = plan(analyses.sbom_count_per_repo(given.patterns))
    assert text.count("regexp_replace") == 1


def test_newest_per_key_limits_before_the_shuffle(given):
    text = plan(latest.newest_releases(given.releases, 5))
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)


def test_artifacts_cross_the_network_once(given):
    text = plan(given.patterns)
    above_scan = text[: text.index("lineitem.parquet")]
    line = above_scan.split("lineitem")[0]
    assert line.count("Exchange hashpartitioning(release_id") <= 2


def test_column_pruning_reaches_the_scan(given):
    text = plan(given.workflows.groupBy("repository_id").count())
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert schemas and not any("text" in s or "props" in s for s in schemas)


def test_no_cross_join(given):
    for frame in (
        summaries.tool_summary(given.tools, given.repositories),
        project_summary.project_rollup(given.project_repos, given.summary),
    ):
        assert "CartesianProduct" not in plan(frame) and "NestedLoop" not in plan(frame)


@pytest.fixture
def eager_skew(spark):
    """Settings under which small test data counts as skewed and is not broadcast."""
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_tables(spark):
    """A third of all artifacts in one release, a third of all releases in one repository."""
    repos = spark.range(300).select(
        F.concat(F.lit("R"), "id").alias("id"), F.concat(F.lit("n"), "id").alias("name"),
        F.concat(F.lit("o/n"), "id").alias("nameWithOwner"), F.lit("u").alias("url"),
        F.lit("d").alias("description"),
    )
    releases = spark.range(3000).repartition(6).select(
        F.concat(F.lit("L"), "id").alias("id"),
        F.concat(F.lit("R"), F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 299)).alias("repository_id"),
        F.concat(F.lit("v"), "id").alias("tagName"), F.lit("n").alias("name"),
        F.lit("2024-01-01").cast("timestamp").alias("createdAt"),
    )
    assets = spark.range(30000).repartition(6).select(
        F.concat(F.lit("A"), "id").alias("id"),
        F.concat(F.lit("L"), F.when(F.col("id") < 10000, 11).otherwise(F.col("id") % 2900)).alias("release_id"),
        F.concat(F.lit("file"), "id", F.lit(".spdx.json")).alias("name"), F.lit("x").alias("downloadUrl"),
    )
    return repos, releases, assets


def test_hot_release_is_split_and_whole(spark, eager_skew):
    repos, releases, assets = hot_tables(spark)
    frame = artifact_patterns(assets, releases, repos)
    frame.write.format("noop").mode("overwrite").save()
    assert frame.count() == 30000
    frame = frame.select("asset_id", "nameWithOwner")
    frame.collect()
    assert "skew=true" in plan(frame)


def test_outer_join_splits_a_hot_right_side(spark, eager_skew):
    repos, releases, _ = hot_tables(spark)
    left = repos.select(F.col("id").alias("repository_id"), "name")
    right = releases.select("repository_id", "tagName", F.lit("x" * 100).alias("pad"))
    joined = left_join_many(left, right, "repository_id")
    plain = left.join(right, "repository_id", "left")
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_hot_key_newest_rows(spark):
    _, releases, _ = hot_tables(spark)
    got = latest.newest_releases(releases, 5).groupBy("repository_id").count().agg(F.max("count")).first()[0]
    assert got == 5


def test_classification_needs_no_shuffle(given):
    assert "Exchange" not in plan(classify_assets(given.assets))
