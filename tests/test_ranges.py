"""Levels of names by ranges."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import put
from tidemark.sources import ranges
from tidemark.sources.ranges import cuts, folder_pager, list_level


def test_cuts_lie_between():
    rng = random.Random(1)
    letters = "\x01 0129AZaz~éÿ中\U0001f600"
    for _ in range(5_000):
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(2))
        after, until = (min(a, b), max(a, b)) if a != b else (a, None)
        found = cuts(after, until, rng.randint(2, 20))
        assert found == sorted(set(found)) and all(after < c and (until is None or c < until) for c in found), (after, until, found)
    assert cuts("000123", None, 16) and cuts("a", "a ", 4) == []


def test_five_million_names(spark):
    """Made-up names in order, none of them kept anywhere: each task lists a bounded number of them."""
    total, limit = 5_000_000, 50_000

    def place(text):
        """How many names are not above a text, by bisection."""
        low, high = 0, total
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if f"k/{middle:09d}" <= text else (low, middle)
        return low

    def pager(after, until, n):
        first, last = place(after), total if until is None else place(until)
        return [(f"k/{i:09d}", i % 7, i) for i in range(first, min(first + n, last))]

    found = list_level(spark, pager, page=10_000, limit=limit)
    counts = found.agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"), F.sum("mtime_us").alias("sum")).first()
    assert tuple(counts) == (total, total, total * (total - 1) // 2)
    tasks = found.groupBy(F.input_file_name().alias("task")).count().agg(F.max("count"), F.count("*")).first()
    assert tasks[0] <= limit and tasks[1] >= total / limit


@pytest.mark.parametrize("limit, parts", [(1, 2), (3, 4), (1000, 16)])
def test_folder_by_ranges(spark, folders, limit, parts):
    rng = random.Random(limit)
    letters = "ab0_.é中 ~\U0001f600"
    names = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(40)} - {".", ".."}
    names = {n for n in names if n.strip(".")}
    for name in names:
        put(folders / "in", name, b"x" * len(name), 1_000_000_000)
    (folders / "in/a folder").mkdir()
    found = list_level(spark, folder_pager(str(folders / "in")), 2, limit, parts).collect()
    assert sorted((r.name, r.size, r.mtime_us) for r in found) == sorted((n, len(n), 10**15) for n in names)


def test_nothing(spark, folders):
    assert list_level(spark, folder_pager(f"file://{folders}/in")).collect() == []
    with pytest.raises(ValueError, match="own client"):
        ranges.folder_pager("gs://bucket/in")


def test_folder_in_order(spark, folders, monkeypatch):
    """The folder is read once: pages and cuts come from its sorted names, and ranges are cut evenly."""
    names = sorted({f"{i * 37 % 400}.txt" for i in range(400)} | {"é", "\U0001f600", "\uffee", "~"})
    for name in names:
        put(folders / "in", name, b"x" * len(name), 1_000_000_000)
    (folders / "in/a folder").mkdir()
    monkeypatch.setattr(ranges, "_HELD", 50)
    plain = folder_pager(str(folders / "in"))
    pager = plain.in_order(spark)
    assert len(pager.files) > 1 and sum(map(len, (ranges._names(f) for f in pager.files))) == len(names)
    rng = random.Random(1)
    asked = [(a, None if rng.random() < 0.2 else max(a, b), rng.randint(1, 120)) for a, b in
             ((rng.choice(["", "~~", "2", *names]), rng.choice(["3", *names])) for _ in range(60))]
    wanted = [plain(*a) for a in asked]
    with monkeypatch.context() as patched:
        patched.setattr(ranges.os, "scandir", None)
        assert [pager(*a) for a in asked] == wanted
        bounds = ["", *pager.cuts("", None, 16, 30), None]
        assert [len(pager(a, b, 1_000)) for a, b in zip(bounds, bounds[1:])] == [29] * 13 + [27]
        assert pager.cuts("", None, 4, 30) == [names[100], names[201], names[302]] and pager.cuts(names[-1], None, 4, 30) == []
    # No range is ever empty, so few tasks list nothing.
    found = list_level(spark, plain, limit=20)
    assert found.count() == len(names) and found.inputFiles() and len(found.inputFiles()) <= 80
    # A file that went away ends no page.
    (folders / "in" / names[0]).unlink()
    assert [n for n, _, _ in pager("", None, 3)] == names[1:4]
