"""Scores against plain counting and the forward recursion token by token."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import likelihood
from tidemark.llm.base import prepared
from tidemark.llm.hmm import Counts, Model

SCHEMA = "doc_id long, text string, row long, classes int, rest string, h long, held_out string"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2



def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def out_of(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    topics = [[f"{t}{i}" for i in range(90)] for t in "abÄ"]
    texts = [" ".join(rng.choice(topic)[: rng.randint(1, 9)] for _ in range(rng.randint(1, 300))) for topic in topics * 25]
    texts += ["", None, None, " \n\t ", "A a", "a\x0bB\x1cc é", "once", "x" * 5000, " ".join(rng.choice(topics[0]) for _ in range(9000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (5, texts[5]), (5, texts[5])]
    return [(*r, 1, 2, "c", 3, "no") for r in rows]


def forward(model, classes):
    state, log = model.start * model.emit[classes[0]], 0.0
    for at, c in enumerate(classes):
        if at:
            state = (state @ model.move) * model.emit[c]
        log += math.log10(state.sum())
        state = state / state.sum()
    return log


def expected(model, classes, into):
    ahead, behind = [], [np.ones(len(model.start))]
    for at, c in enumerate(classes):
        state = (model.start if not at else ahead[-1] @ model.move) * model.emit[c]
        ahead.append(state / state.sum())
    for c in classes[:0:-1]:
        state = model.move @ (model.emit[c] * behind[-1])
        behind.append(state / state.sum())
    for at, (a, b, c) in enumerate(zip(ahead, behind[::-1], classes)):
        into.emit[c] += a * b / (a @ b)
        if at:
            both = ahead[at - 1][:, None] * model.move * (model.emit[c] * b)
            into.move += both / both.sum()
        else:
            into.start += a * b / (a @ b)


@pytest.mark.parametrize("own, known", [(1 << 15, 1 << 18), (40, 90)])
def test_scores(spark, rows, monkeypatch, own, known):
    monkeypatch.setattr(likelihood, "_OWN", own)
    monkeypatch.setattr(likelihood, "_KNOWN", known)
    seen = {}
    train = likelihood.train
    monkeypatch.setattr(likelihood, "train", lambda coded, v, s: seen.update(v=v, coded=coded, model=train(coded, v, s)) or seen["model"])
    settings = likelihood.Settings(states=3, rounds=2)
    found = likelihood.likelihoods(spark.createDataFrame(rows, SCHEMA).repartition(4), held_out(), settings)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    words = [SPLIT.findall(lower(r[1])) for r in rows]
    counts = Counter(w for r, ws in zip(rows, words) if not out_of(r[0]) for w in ws)
    texts = sum(not out_of(r[0]) for r in rows)
    total, distinct = sum(counts.values()) + texts, len(counts) + 1
    model, v = seen["model"][0], seen["v"]
    assert np.isclose(model.emit.sum(axis=0), 1).all() and np.isclose(model.move.sum(axis=1), 1).all()
    hashes = dict(spark.createDataFrame([(w,) for ws in words for w in set(ws)], "text string").transform(likelihood.word_counts).select("word", "h").collect())
    classes = {w: int(v.look_up(np.array([h], np.int64).view(np.uint64))[0][0]) for w, h in hashes.items()}
    alone = {w for w, c in counts.items() if c >= total / own}
    assert len({classes[w] for w in alone}) == len(alone) and all((classes[w] > v.end) == (w in alone) for w in classes)
    room = Counter()
    for w, c in counts.items():
        if w not in alone:
            room[classes[w]] += c + 1
    wanted = []
    for r, ws in zip(rows, words):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws) + math.log10((texts + 1) / (total + distinct + 1))
        score = forward(model, [*(classes[w] for w in ws), v.end])
        score += sum(math.log10((counts[w] + 1) / (room[classes[w]] + 1)) for w in ws if w not in alone)
        wanted.append((r[0], out_of(r[0]), len(ws) + 1, 1 + sum(w in counts for w in ws), total, base, score))
    order = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[2], r[6]))
    for a, b in zip(order(map(tuple, found.collect())), order(wanted), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)

    # One more round, by the plain recursion.
    plain = Counts.none(3, len(model.emit))
    for r, ws in zip(rows, words):
        if not out_of(r[0]):
            expected(model, [*(classes[w] for w in ws), v.end], plain)
    round_ = likelihood._round(seen["coded"], model)
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(round_, name), getattr(plain, name))


@pytest.mark.parametrize("piece, lane", [(1 << 16, 512), (256, 128), (1024, 64), (64, 64)])
def test_lanes_and_pieces_change_nothing(piece, lane):
    rng = np.random.default_rng(3)
    share = rng.random(50)
    model = Model.guess(share / share.sum(), 3, 1)
    model.move = rng.random((3, 3)) + 0.1
    model.move /= model.move.sum(axis=1, keepdims=True)
    offsets = np.cumsum([0, 1, 5, 700, 1, 130, 128, 300, 2])
    classes = rng.integers(0, 50, offsets[-1])
    texts = [classes[a:b] for a, b in zip(offsets, offsets[1:])]
    assert np.allclose(model.log10(classes, offsets, piece, lane), [forward(model, t) for t in texts])
    found, wanted = Counts.none(3, 50), Counts.none(3, 50)
    model.count(classes, offsets, found, piece, lane)
    for t in texts:
        expected(model, t, wanted)
    assert all(np.allclose(getattr(found, n), getattr(wanted, n)) for n in ("start", "move", "emit"))
    assert np.isclose(found.log10, sum(forward(model, t) for t in texts))


def test_rounds_learn(spark, sf_dir):
    """Each round explains the training texts better, and held-out texts are likelier than by their words alone."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    logs = []
    train = likelihood.train
    found = []
    try:
        likelihood.train = lambda *a: found.append(train(*a)) or found[-1]
        scored = likelihood.likelihoods(docs, held_out())
        sums = scored.where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
        logs = found[0][1]
    finally:
        likelihood.train = train
    assert logs == sorted(logs) and len(logs) == 3
    assert sums["score"] > sums["base"]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(10, "a b")], [(i, "") for i in range(20)]])
def test_little(spark, rows):
    found = likelihood.likelihoods(spark.createDataFrame([(*r, 1, 2, "", 3, "") for r in rows], SCHEMA), F.lit(True)).collect()
    assert len(found) == len(rows)
    assert all(r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and r["score"] <= 0 for r in found)
