"""The manifest against trees built one by one."""

import hashlib
import random
import zlib

import pytest

from tidemark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, p long, `group` int, leaf string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [None if v is None else str(v) for v in (row[0], row[3], row[2], row[4], text)]
    return digest(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


def climb(nodes):
    """The last node, and of each node the siblings before and after it and its ancestors."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for start in range(0, len(nodes), 8):
            run = nodes[start : start + 8]
            for slot in range(len(run)):
                for i in under[start + slot]:
                    paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        under = [sum(under[s : s + 8], []) for s in range(0, len(nodes), 8)]
        nodes = [digest(*nodes[s : s + 8]) for s in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda x: x[:3]), *climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])])) for g in langs}
    root, over = climb([trees[g][1] for g in langs])
    out = []
    for g, more in zip(langs, over):
        made, subroot, paths = trees[g]
        for (_, _, own, row), path in zip(made, paths):
            struck = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1]) if struck and row[1] is not None else row[1]
            folded = leaf(row, text)
            for before, after in path + more:
                folded = digest(before, folded, after)
            proof = digest(*[s for pair in path + more for s in pair])
            out.append((row[0], own, subroot, root, proof, folded, folded == root))
    return out


def table(n, langs, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "Ä " * rng.randint(1, 9), f"Some TEXT {i} é" * rng.randint(1, 40), "plain"])
        rows.append((i * 3 % 1009, text, rng.choice(langs), rng.choice(["s", None, "src:1"]), rng.choice([None, i]), "x", 1, 2, "y"))
    return rows


@pytest.mark.parametrize("levels", [2])
@pytest.mark.parametrize("rows", [
    table(700, [None, "", "en", "en", "en", "Ünd", "z"]),
    table(64, ["en"]) + [(None, "A", "en", None, None, "x", 1, 2, "y")] * 3,
    table(1, ["en"]),
    [(1, "A", "de", "s", 1, "", 0, 0, "")] * 17 + [(i, "B" * 3000, f"g{i % 75}", None, 2, "", 0, 0, "") for i in range(90)],
], ids=["groups", "nulls", "one", "repeats"])
def test_manifest(spark, rows, levels):
    found = merkle.documents_manifest(spark.createDataFrame(rows, SCHEMA).repartition(7), levels)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(found.collect()) == order(brute(rows))


def test_nothing(spark):
    assert merkle.documents_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_group_meets_in_one_task(spark):
    """Only windows over counts of ranges are by group alone; those over nodes are by group and block."""
    rows = spark.createDataFrame(table(300, ["en"]), SCHEMA)
    plan = merkle.documents_manifest(rows, 2)._jdf.queryExecution().executedPlan().toString()
    over = [line for line in plan.splitlines() if "Window [l" in line]
    assert over and all("block#" in line.split("windowspecdefinition")[1] for line in over)
