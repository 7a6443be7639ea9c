"""Codes against plain nearest entries and means, on integers of every size."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import codes
from tidemark.llm.gnat import Tree

SCHEMA = "vec_id long, embedding array<double>, label int, code string, v int, part int, error int"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // parts)
    whole = lambda x: math.floor(x * 1024) if abs(x) < 2**52 else int(x) * 1024
    vectors = [[whole(x) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(vectors[i], p) for i in first] for p in range(parts)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for v in vectors:
                of.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*of[i])] if i in of else e for i, e in enumerate(books[p])]
    found = [[near(cut(v, p), books[p]) for p in range(parts)] for v in vectors]
    errors, sums = [sum(d for d, _ in f) for f in found], {}
    for r, e in zip(kept, errors):
        sums.setdefault(r[2], []).append(e)
    total = {k: sum(e) if max(e) < 2**63 and sum(e) < 2**63 else None for k, e in sums.items()}
    print_ = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [
        (r[0], "".join(f"{i:02x}" for _, i in f), e if e < 2**63 else None, total[r[2]], print_) for r, f, e in zip(kept, found, errors)
    ]


def check(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], SCHEMA).repartition(5)
    found = codes.compress(df, codes.Settings(**settings))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute(rows, **settings), key=str)


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rng = random.Random(3)
    rows = [(i % 450, [float(rng.randint(-2, 2)) / 1024 for _ in range(8)], rng.choice([1, 2, None])) for i in range(500)]
    rows += [(900, None, 1), (901, [1.0, None] * 4, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), (None, [0.5] * 8, 7)]
    check(spark, rows, entries=40)


def test_lengths_and_sizes(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 10 ** rng.choice([0, 1, 5])) for _ in range(rng.choice([0, 3, 6, 7]))], i % 3) for i in range(120)]
    rows += [(200, [1e300, -1e18, 3.0, 1e15, -1e200, 5e-324], 1), (201, [-1e300] * 6, 4), (202, [2.0**40] * 7, 5)]
    check(spark, rows, entries=16, rounds=3)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], None)], [(1, [0.25], None), (1, [0.25], None)]])
def test_few_rows(spark, rows):
    check(spark, rows)


@pytest.mark.parametrize("spread", [1, 3, 2000])
def test_tree_finds_the_nearest_and_skips_the_rest(spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread, spread + 1, (20, 6)) * 40
    entries = centres[rng.integers(0, 20, 256)] + rng.integers(-spread, spread + 1, (256, 6))
    points = np.concatenate([entries[:100], centres[rng.integers(0, 20, 900)] + rng.integers(-spread, spread + 1, (900, 6))])
    tree = Tree(entries)
    best, least = tree.nearest(points)
    far = ((points[:, None, :] - entries[None]) ** 2).sum(2)
    assert (best == far.argmin(1)).all() and (least == far.min(1)).all()
    assert tree.compared < 0.5 * far.size


def test_no_entry_is_nearer(spark, sf_dir):
    """On the given table, against all distances."""
    rows = codes.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", "label")
    books = codes.train(rows)
    coded = codes.encode(rows, books).join(rows.select("vec_id", "v"), "vec_id").collect()
    points = np.floor(np.array([r["v"] for r in coded]) * 1024).astype(np.int64)
    for part, book in enumerate(books):
        cut = points[:, part * book.width : (part + 1) * book.width]
        far = ((cut[:, None, :] - np.array(book.entries)[None]) ** 2).sum(2)
        assert [int(r["code"][2 * part : 2 * part + 2], 16) for r in coded] == far.argmin(1).tolist()
    assert rows.where(F.size("v") != 64).count() == 0
