"""What the plans of the table queries must and must not hold."""

import re

import pytest

from tidemark.catalog import tables
from tidemark.catalog.inputs import document_files, document_ledger
from tidemark.operators import ledger as L
from tidemark.operators import metrics as M
from tidemark.operators.filters import delta_filter, subtree_filter
from tidemark.operators.verify import verify

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Window")
# These act when called and return what they found.
ACTING = {"commit_and_read", "discard_sink", "latest_snapshot"}
# Its windows are over ranges of values and their sums (tests/test_spread.py).
RANGED = {"transfer_percentiles"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


@pytest.fixture
def large(spark):
    """Plans as they are for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(tables.QUERIES) - ACTING - RANGED))
def test_no_pairs_no_python_no_windows(large, sf_dir, name):
    plan = plan_of(tables.QUERIES[name](large, sf_dir))
    assert not [operator for operator in FORBIDDEN if operator in plan]


def test_texts_are_not_shuffled(large, sf_dir):
    """Digests and sizes are taken below the join."""
    plan = plan_of(document_files(large, sf_dir).select("relpath", "size", "md5", "mtime_s"))
    join = plan.index("SortMergeJoin")
    assert plan.index("md5(") > join and plan.index("octet_length") > join


def test_unused_columns_are_not_read(large, sf_dir):
    plan = plan_of(document_files(large, sf_dir).select("relpath", "mtime_s"))
    assert "text:string" not in "".join(re.findall(r"ReadSchema: \S+", plan))


def test_window_is_pushed_before_the_join(large, sf_dir):
    plan = plan_of(document_files(large, sf_dir, (1_704_110_400, 1_704_240_000)))
    scan = next(line for line in plan.splitlines() if "events.parquet" in line)
    assert "DataFilters: [isnotnull(ts" in scan


def test_subtree_is_a_prefix_at_the_scan(spark, tmp_path):
    spark.createDataFrame([("a/b",), ("c",)], "relpath string").write.parquet(str(tmp_path / "m"))
    plan = plan_of(subtree_filter(spark.read.parquet(str(tmp_path / "m")), "a", recursive=True))
    assert "StringStartsWith(relpath,a/)" in plan


def test_verification_shuffles_once_and_combines_before(large):
    sides = [large.range(9).selectExpr("cast(id as string) relpath", "md5(cast(id as string)) md5") for _ in range(2)]
    plan = plan_of(verify(*sides))
    assert shuffles(plan) == 1 and "partial_min" in plan
    assert shuffles(plan_of(verify(*sides, unique=True))) == 2


def test_ledger_steps_combine_before_their_shuffle(large):
    rows = large.range(9).selectExpr("cast(id as string) relpath", "id mtime_s", "'x' as v")
    for df in (L.latest_version(rows), L.retry_set(rows, rows)):
        plan = plan_of(df)
        assert shuffles(plan) == 1 and "partial_max" in plan
    # Both sides of the anti join once; the distinct shares the shuffle of its side.
    assert shuffles(plan_of(L.exclude_transferred(rows, rows))) == 2


def test_totals_are_made_from_the_finest_groups(large, sf_dir):
    plan = plan_of(M.run_totals(document_ledger(large, sf_dir), ["source", "lang"]))
    assert plan.index("Expand") < plan.index("partial_count")


def test_window_on_seconds_is_pushed_too(spark, tmp_path):
    spark.range(9).selectExpr("id mtime_s").write.parquet(str(tmp_path / "m"))
    plan = plan_of(delta_filter(spark.read.parquet(str(tmp_path / "m")), 2, 5))
    assert "GreaterThan(mtime_s,2), LessThanOrEqual(mtime_s,5)" in plan
