"""Tables of several part files give the same rows as tables of one file."""

from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from attestry.plans.project_summary import project_rollup
from attestry.plans.repo_summary import MATURITY_SIGNALS, with_maturity_score
from workload.given import Given

FOLDER = "/root/testdata/sf0.001"
NAMES = ["stream_without_repeats", "stream_log_without_repeats", "stream_latest_snapshot", "stream_tools", "keyword_flags"]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    for path in Path(FOLDER).glob("*.parquet"):
        spark.read.parquet(str(path)).repartition(3).write.parquet(f"{folder}/{path.name}")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_several_files(spark, parts, name):
    assert compare(entry.queries()[name](spark, parts), connect(FOLDER), entry.oracle_sql()[name]) is None


def test_project_scores_follow_the_weights(spark):
    given = Given(spark, FOLDER)
    one = next(iter(MATURITY_SIGNALS))
    weights = {name: 100 if name == one else 0 for name in MATURITY_SIGNALS}
    total = lambda summary: project_rollup(given.project_repos, summary).selectExpr("sum(score_sum)").first()[0]
    default = total(with_maturity_score(given.summary))
    assert total(with_maturity_score(given.summary, weights)) != default
