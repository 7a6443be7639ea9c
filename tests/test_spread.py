"""Work dealt by size, exact percentiles by ranges, and copies by ranges of bytes."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import put
from tidemark.operators import split
from tidemark.operators.metrics import exact_percentiles
from tidemark.operators.split import copy_by_ranges, followed_by, ranges_of
from tidemark.operators.transfer import plan_transfer, transfer
from tidemark.options import TransferOptions
from tidemark.plans.run import run_transfer
from tidemark.session import materialize
from tidemark.sources.listing import walk_files
from tidemark.sources.manifest import store_manifest
from tidemark.spread import FILE_COST, spread

MIB = 1 << 20


def loads(df):
    return sorted(r.bytes for r in df.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("size").alias("bytes")).collect())


@pytest.mark.parametrize("kind", ["even", "heavy tail", "one giant", "many large"])
def test_tasks_get_equal_shares_of_bytes(spark, kind):
    rng = random.Random(kind)
    sizes = {
        "even": [rng.randint(10, 200) for _ in range(3_000)],
        "heavy tail": [int(10 * rng.paretovariate(0.9)) for _ in range(3_000)],
        "one giant": [30] * 2_000 + [1_000_000],
        "many large": [20_000] * 41 + [rng.randint(1, 900) for _ in range(1_000)],
    }[kind]
    files = spark.createDataFrame([(f"/in/{i}", s * MIB, "x") for i, s in enumerate(sizes)], "path string, size long, `_t` string").repartition(5)
    dealt = spread(files, 16)
    assert dealt.columns == files.columns and dealt.rdd.getNumPartitions() == 16
    assert sorted(r.size for r in dealt.select("size").collect()) == sorted(s * MIB for s in sizes)
    mean = sum(sizes) * MIB / 16
    assert max(loads(dealt)) <= max(max(sizes) * MIB, 1.25 * mean) + 100 * FILE_COST


def test_small_files_count_too(spark):
    files = spark.range(4_000).select(F.concat(F.lit("/"), "id").alias("path"), F.lit(0).cast("long").alias("size"))
    counts = [r["count"] for r in spread(files, 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == 8 and max(counts) <= 1.25 * 500


def test_nothing_to_deal(spark):
    files = spark.createDataFrame([], "path string, size long")
    assert spread(files).collect() == [] and spread(files, 4).collect() == []


# --- percentiles


@pytest.mark.parametrize("by", [["g", "h"], ["g"], []])
def test_percentiles_by_ranges(spark, by):
    rng = random.Random(len(by))
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1]), rng.choice([None, rng.randint(0, 9), rng.randint(-500, 500)]), rng.randint(1, 5)) for _ in range(900)]
    rows += [("only null", None, None, 3), ("one", 1, 7, 1)]
    at = [0.0, 0.1, 0.5, 0.95, 0.999, 1.0]
    df = spark.createDataFrame(rows, "g string, h int, value long, n long").groupBy(*by, "value").agg(F.sum("n").alias("n"))
    found = {tuple(r[b] for b in by): r["found"] for r in exact_percentiles(df, by, "value", "n", at).collect()}
    groups = {}
    for g, h, value, n in rows:
        key = tuple({"g": g, "h": h}[b] for b in by)
        groups.setdefault(key, []).extend([] if value is None else [value] * n)
    assert set(found) == set(groups)
    for key, values in groups.items():
        if values:
            assert found[key] == pytest.approx(np.percentile(values, [100 * p for p in at]).tolist())
        else:
            assert found[key] is None


def test_a_group_of_percentiles_is_many_tasks(spark):
    """Windows over values are by group and range."""
    df = spark.range(5_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 5_000).alias("value"), F.lit(1).alias("n"))
    found = exact_percentiles(df, ["g"], "value", "n", [0.5])
    plan = found._jdf.queryExecution().executedPlan().toString()
    over = [line for line in plan.splitlines() if "Window [sum(_n" in line]
    assert over and all("_range#" in line.split("windowspecdefinition")[1] for line in over)
    assert found.first()["found"] == [2499.5]


# --- ranges


def test_checksums_combine():
    rng = random.Random(1)
    for _ in range(40):
        data = rng.randbytes(rng.randint(0, 3_000))
        cuts = sorted(rng.randint(0, len(data)) for _ in range(4))
        whole, end = 0, 0
        for a, b in zip([0, *cuts], [*cuts, len(data)]):
            end = b
            whole ^= followed_by(zlib.crc32(data[a:b]), len(data) - end)
        assert whole == zlib.crc32(data)
    # Bytes that no task could hold.
    assert followed_by(1, 1 << 45) == followed_by(followed_by(1, 1 << 44), 1 << 44)


@pytest.fixture
def plan(spark, folders):
    rng = random.Random(2)
    for i, size in enumerate((0, 1, 99, 100, 101, 5_000)):
        put(folders / "in", f"d{i % 2}/f{i}", rng.randbytes(size))
    return plan_transfer(store_manifest(walk_files(spark, str(folders / "in")), "s", "gs://bucket/in"), str(folders / "out"))


def test_ranges_cover_each_file_once(plan):
    found = {}
    for r in ranges_of(plan, 100).collect():
        found.setdefault(r.size, []).append((r.start, r.length))
    assert {size: sorted(parts) for size, parts in found.items()} == {
        0: [(0, 0)], 1: [(0, 1)], 99: [(0, 99)], 100: [(0, 100)], 101: [(0, 100), (100, 1)], 5_000: [(100 * i, 100) for i in range(50)],
    }


def test_copies_by_ranges(plan, folders):
    done = copy_by_ranges(plan, range_bytes=100, buffer_bytes=33).collect()
    assert len(done) == 6
    for row in done:
        data = (folders / "in" / row.relpath).read_bytes()
        assert (folders / "out" / row.relpath).read_bytes() == data
        assert (row.status, row.bytes, row.attempts) == ("copied", len(data), 1)
        assert row.md5_source == row.md5_target == f"crc32:{zlib.crc32(data):08x}"
    assert not list((folders / "out").rglob("*part"))


def test_short_ranges_share_tasks(spark, plan, monkeypatch):
    """Tasks are counted by bytes and by ranges, as for files; sixteen short ranges are no task's work."""
    written = []
    monkeypatch.setattr(split, "materialize", lambda df, name: written.append(materialize(df, name)) or written[-1])
    done = copy_by_ranges(plan, range_bytes=10)
    assert written[0].count() > 500 and len(written[0].inputFiles()) <= spark.sparkContext.defaultParallelism
    assert {(r.status, r.bytes == r.size) for r in done.collect()} == {("copied", True)}


def test_damaged_changed_and_missing_files(spark, plan, folders, monkeypatch):
    """A range that is stored wrong, a source that changes, one that goes: none is published, and nothing is left."""
    plan = spark.createDataFrame(plan.collect(), plan.schema)
    (folders / "in/d0/f2").unlink()
    put(folders / "in", "d1/f3", b"z" * 100, 1_000_000_999)
    pread = os.pread
    monkeypatch.setattr(split.os, "pread", lambda f, n, at: pread(f, n, at) if at != 4_900 else b"?" * n)
    writer, publisher = split._writer(1, 50, 1), split._publisher(1, 1)
    import pandas as pd

    from tidemark.schemas import PLAN

    ranges = ranges_of(plan, 100).toPandas()
    done = pd.concat(writer(iter([ranges])))
    files = done.groupby(PLAN.fieldNames(), dropna=False).agg(
        crc_source=("crc_source", lambda c: np.bitwise_xor.reduce(c)), crc_target=("crc_target", lambda c: np.bitwise_xor.reduce(c)),
        copied=("length", "sum"), error=("error", lambda e: next((x for x in e if x), None)), gone=("gone", "max"), start_ms=("start_ms", "min"),
    ).reset_index()
    status = {r.relpath: r.status for r in pd.concat(publisher(iter([files]))).itertuples()}
    assert status == {"d0/f0": "copied", "d1/f1": "copied", "d0/f2": "missing", "d1/f3": "failed", "d0/f4": "copied", "d1/f5": "failed"}
    assert sorted(f.name for f in (folders / "out").rglob("*") if f.is_file()) == ["f0", "f1", "f4"]


def test_transfer_cuts_large_files_only(plan, folders):
    done = {r.relpath: r.md5_source for r in transfer(plan, 0, 0, split_bytes=100).collect()}
    assert len(done) == 6 and {n for n, digest in done.items() if digest.startswith("crc32:")} == {"d0/f4", "d1/f5"}


def test_a_run_with_ranges_archives_and_tries_again(spark, plan, folders):
    (folders / "out/d1/f5").mkdir(parents=True)
    options = TransferOptions(
        "p", str(folders / "in"), str(folders / "out"), recursive=True, retries=1, wait_s=0, safety_s=0, state_root=str(folders / "state"),
        archive="rename", archive_root=str(folders / "done"), split_bytes=100,
    )
    first = run_transfer(spark, options, "r1", 2_000_000_000_000).ledger
    assert {r.relpath: (r.check, r.attempts) for r in first.collect()} == {f"d{i % 2}/f{i}": ("failed", 2) if i == 5 else ("verified", 1) for i in range(6)}
    (folders / "out/d1/f5").rmdir()
    run = run_transfer(spark, options, "r2", 2_000_000_100_000)
    assert [(r.relpath, r.check) for r in run.ledger.collect()] == [("d1/f5", "verified")]
    assert len([f for f in (folders / "done").rglob("*") if f.is_file()]) == 6
    with pytest.raises(ValueError, match="split_bytes"):
        TransferOptions("p", "/in", "gs://bucket/out", split_bytes=5).validate(spark)
