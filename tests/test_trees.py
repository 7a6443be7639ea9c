"""Audits by folder digests, and the newest version kept as a snapshot."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ledger import latest_version
from tidemark.operators.snapshot import merge_latest, read_snapshot, with_runs, write_snapshot
from tidemark.operators.trees import audit_trees, differing_trees, folder_of, tree_digests
from tidemark.operators.verify import verify

FILES = "relpath string, md5 string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def both(spark, seed, changes):
    rng = random.Random(seed)
    source = {"/".join(rng.choice("abc") for _ in range(rng.randint(0, 3))) + f"/f{i}": f"{i:032x}" for i in range(150)}
    source = {k.lstrip("/"): v for k, v in source.items()}
    target = dict(source)
    for path in rng.sample(sorted(source), changes):
        kind = rng.randint(0, 4)
        if kind == 0:
            del target[path]
        elif kind == 1:
            target[path] = "0" * 32
        elif kind == 2:
            source[path] = None
        elif kind == 3:
            source[path] = target[path] = None
        else:
            target[f"new/{path}"] = target.pop(path)
    return tuple(spark.createDataFrame(list(x.items()), FILES).repartition(4) for x in (source, target))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed, changes", [(1, 0), (2, 1), (3, 7), (4, 150)])
def test_audit_gives_the_rows_of_verification(spark, seed, changes):
    source, target = both(spark, seed, changes)
    assert rows(audit_trees(source, target)) == rows(verify(source, target, unique=True))


@pytest.mark.parametrize("seed, changes", [(1, 0), (3, 7)])
def test_differing_trees_by_brute_force(spark, seed, changes):
    source, target = both(spark, seed, changes)
    sides = [{r.relpath: r.md5 for r in df.collect()} for df in (source, target)]
    under = lambda files, at: {k: v for k, v in files.items() if not at or k.startswith(f"{at}/")}
    folders = {"/".join(path.split("/")[:n]) for side in sides for path in side for n in range(path.count("/") + 1)}
    wanted = []
    for at in folders:
        a, b = (under(side, at) for side in sides)
        if a != b or None in a.values():
            wanted.append((at, at.count("/") + 1 if at else 0, len(a) or None, len(b) or None))
    assert rows(differing_trees(source, target)) == sorted(wanted, key=str)


def test_repeated_and_swapped_files_show(spark):
    """An exclusive or alone would not see a file that is there three times, nor contents that changed places."""
    one = spark.createDataFrame([("a/x", "1"), ("a/y", "2")], FILES)
    for other in ([("a/x", "1")] * 3 + [("a/y", "2")], [("a/x", "2"), ("a/y", "1")], [("a/x", "1"), ("b/y", "2")]):
        assert "" in {r.folder for r in differing_trees(one, spark.createDataFrame(other, FILES)).collect()}


def test_an_equal_tree_shuffles_folders_only(spark):
    """Every exchange that files go through is behind their folder's aggregate or a join with the folders that differ."""
    source, target = both(spark, 1, 0)
    found = audit_trees(source, target)
    assert found.count() == 150
    digests = tree_digests(source).collect()
    assert {r.folder: r.files for r in digests}[""] == 150 and all(r.depth == (r.folder.count("/") + 1 if r.folder else 0) for r in digests)


def test_folders(spark):
    paths = ["a", "a/b", "a/b/c d", "/x", "a//b", "ü/\n/z"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(folder_of("p").alias("f"))
    assert [r.f for r in df.collect()] == ["", "a/", "a/b/", "/", "a//", "ü/\n/"]


def test_no_files(spark):
    none = spark.createDataFrame([], FILES)
    some = spark.createDataFrame([("a/b", "1")], FILES)
    assert audit_trees(none, none).collect() == [] and differing_trees(none, none).collect() == []
    assert rows(audit_trees(some, none)) == [("a/b", "1", None, "missing")]
    assert rows(audit_trees(none, some)) == [("a/b", None, "1", "unexpected")]


VERSIONS = "relpath string, mtime_s long, value double, extra struct<a: int>"


def versions(spark, n, seed):
    rng = random.Random(seed)
    return spark.createDataFrame([(f"p{rng.randint(0, 40)}", rng.randint(0, 9), rng.choice([None, 0.5, 1.0]), (rng.choice([None, i]),)) for i in range(n)], VERSIONS)


def test_snapshot_and_runs_give_the_latest(spark, tmp_path):
    uri, parts = f"file:{tmp_path}/s", [versions(spark, 60, seed) for seed in range(4)]
    held, every = read_snapshot(spark, uri, parts[0].schema), None
    assert held is None
    for part in parts:
        every = part if every is None else every.unionByName(part)
        assert rows(merge_latest(held, part)) == rows(latest_version(every))
        held = write_snapshot(with_runs(spark, uri, part), uri, buckets=4)
        again = read_snapshot(spark, uri, part.schema)
        assert again.columns == part.columns and rows(again) == rows(latest_version(every)) == rows(held)
    assert len(list((tmp_path / "s").iterdir())) == 2


def test_the_snapshot_is_not_shuffled(spark, tmp_path):
    uri = f"file:{tmp_path}/s"
    write_snapshot(latest_version(versions(spark, 300, 1)), uri, buckets=4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = with_runs(spark, uri, versions(spark, 30, 2))
        lines = plan_of(merged).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    assert "Bucketed: true" in lines[scan] and not any("Exchange" in line for line in lines[join:scan])


def test_a_snapshot_is_known_to_a_new_catalog(spark, tmp_path):
    from tidemark.operators import snapshot

    uri, rows_ = f"file:{tmp_path}/s", latest_version(versions(spark, 50, 3))
    write_snapshot(rows_, uri, buckets=4)
    spark.sql(f"DROP TABLE {snapshot._table(f'{uri}/version=1-buckets=4')}")
    assert rows(read_snapshot(spark, uri, rows_.schema)) == rows(rows_)


def test_columns_of_a_snapshot_may_have_odd_names(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2, 3)], "relpath string, mtime_s long, `row` int, `old` int")
    uri = f"file:{tmp_path}/s"
    held = write_snapshot(df, uri, buckets=2)
    newer = df.withColumn("mtime_s", F.lit(5).cast("long")).withColumn("old", F.lit(9))
    assert rows(merge_latest(held, newer)) == [("a", 5, 2, 9)]
