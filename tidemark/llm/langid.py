"""Language identification by averaged subword embeddings and a linear softmax.

Subwords are the runs of 2 to 4 UTF-8 bytes of the lower-cased text that touch a
letter and hold white space, digits or marks at their ends only. Each is hashed
to a bucket with an embedding; a text is the mean of its subwords' embeddings,
and a linear softmax gives the languages' probabilities. Both layers are trained
by stochastic gradient descent in numpy on a bounded sample of labelled rows.

A part of the sample is kept from the descent: it sets the softmax's temperature
and the probability below which a prediction is rejected.

Predictions read whole texts. As both layers are linear, their product is one
small table of logits by bucket, which is all that the tasks get.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import fresh
from tidemark.llm.words import slices, text_bytes

UNDETERMINED = "und"
_BITS = 16
_SIZES = (2, 3, 4)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
# All that is no letter is one symbol, so that marks and digits tell nothing.
_SYMBOL = np.where(_LETTER, np.arange(256), 0).astype(np.uint32)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds what is learned from, whatever the size of the table: so many rows at most in all,
    an equal share for each language, the rows with the smallest hashes of their ids. ``lost`` is the share
    of rightly predicted calibration rows that the rejection may cost, ``floor`` the highest probability to reject."""

    sample_rows: int = 3000
    dimension: int = 16
    epochs: int = 4
    rate: float = 0.5
    lost: float = 0.001
    floor: float = 0.5
    seed: int = 1


@dataclass
class Model:
    """``logits``: a row for each bucket; ``threshold``: predictions with a lower probability are rejected."""

    languages: list[str] = field(default_factory=list)
    logits: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """A row for each text; texts without a subword get what the bias says."""
        out = np.empty((len(texts), len(self.languages)))
        for a, b in slices(texts):
            sums, counts = _pooled(texts.slice(a, b - a), self.logits)
            out[a:b] = softmax((sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _subwords(texts: pa.Array):
    """For each size of subword: buckets, and the place in the bytes of each; last the texts' first places."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    # A mark on either side of each text, so that no subword reaches into the next one.
    n = len(data) + len(texts) + 1
    at = np.arange(len(data)) + np.repeat(np.arange(1, len(texts) + 1), np.diff(offsets))
    symbols, letters = np.zeros(n, np.uint32), np.zeros(n, bool)
    symbols[at], letters[at] = _SYMBOL[data], _LETTER[data]
    found, hashes, inner = [], symbols.copy(), np.ones(n, bool)
    for size in range(2, max(_SIZES) + 1):
        m = n - size + 1
        hashes = hashes[:m] * np.uint32(0x01000193) + symbols[size - 1 :]
        inner = inner[:m] & letters[size - 2 : n - 1] if size > 2 else inner[:m]
        if size in _SIZES:
            valid = inner if size > 2 else letters[:m] | letters[1:]
            places = np.flatnonzero(valid)
            spread = (hashes[places] + np.uint32(size)) * np.uint32(0x9E3779B1)
            found.append((spread >> np.uint32(32 - _BITS), places))
    return found, offsets[:-1] + np.arange(len(texts))


def _pooled(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the table's rows over each text's subwords, and their number."""
    found, firsts = _subwords(texts)
    sums, counts = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts), np.int64)
    for buckets, places in found:
        cuts = np.searchsorted(places, np.append(firsts, np.iinfo(np.int64).max))
        counts += np.diff(cuts)
        some = np.flatnonzero(np.diff(cuts))
        if len(some):
            sums[some] += np.add.reduceat(table[buckets], cuts[some], axis=0, dtype=np.float64)
    return sums, counts


def _features(batches):
    """Labelled rows as their buckets and the share of each."""
    for batch in batches:
        texts = batch.column("text")
        for i in range(len(texts)):
            found, _ = _subwords(texts.slice(i, 1))
            buckets, counts = np.unique(np.concatenate([b for b, _ in found]), return_counts=True)
            share = counts / max(1, counts.sum())
            yield pa.RecordBatch.from_pydict(
                {"lang": batch.column("lang").slice(i, 1), "part": batch.column("part").slice(i, 1),
                 "buckets": pa.array([buckets.astype("<i4").tobytes()]), "share": pa.array([share.astype("<f4").tobytes()])}
            )


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 5


def train(documents: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from text and lang of the rows whose fold is not 0. Null texts, languages and ids teach nothing."""
    labelled = documents.select("text", "lang", fold().alias("part"), F.xxhash64("doc_id").alias("h")).where(
        "text is not null and lang is not null and part <> 0"
    )
    counts = dict(labelled.groupBy("lang").agg(F.approx_count_distinct("h")).collect())
    languages = sorted(counts)
    if not languages:
        return Model()
    share = max(1, settings.sample_rows // len(languages))
    # Only rows with one of the lowest hashes go on, of twice as many ids as wanted, so few texts are shuffled at any size.
    lowest = {name: (min(1.0, 2 * share / max(1, n)) - 0.5) * 2.0**64 for name, n in counts.items()}
    cutoff = F.create_map(*[F.lit(x) for pair in lowest.items() for x in pair])[F.col("lang")]
    order = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    few = labelled.where(F.col("h").cast("double") <= cutoff)
    sample = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= share)
    rows = (
        sample.select("lang", "part", "text")
        .mapInArrow(_features, "lang string, part long, buckets binary, share binary")
        .toArrow().to_pylist()
    )
    rows.sort(key=lambda r: (r["lang"], r["buckets"], r["share"]))
    number = {name: i for i, name in enumerate(languages)}
    rows = [(np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["share"], "<f4"), number[r["lang"]], r["part"]) for r in rows]
    rows = [r for r in rows if len(r[0])]
    kept = [r for r in rows if r[3] == 1]
    taught = [r for r in rows if r[3] != 1] or kept
    if not taught:
        return Model()
    return _calibrated(*_descend(taught, len(languages), settings), kept or taught, languages, settings)


def _descend(rows: list, n: int, settings: Settings):
    rng = np.random.default_rng(settings.seed)
    inputs = rng.uniform(-1, 1, (1 << _BITS, settings.dimension)).astype(np.float32) / settings.dimension
    outputs, bias = np.zeros((settings.dimension, n), np.float32), np.zeros(n, np.float32)
    steps, done = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            buckets, share, label, _ = rows[i]
            rate = settings.rate * (1 - done / steps)
            hidden = share @ inputs[buckets]
            error = softmax(hidden @ outputs + bias).astype(np.float32)
            error[label] -= 1
            back = outputs @ error
            outputs -= rate * np.outer(hidden, error)
            bias -= rate * error
            # The gradient of one subword is its share of the text's; scaled up, as shares are small.
            inputs[buckets] -= (rate * len(buckets) ** 0.5) * share[:, None] * back
            done += 1
    return inputs @ outputs, bias


def _calibrated(logits, bias, rows: list, languages: list[str], settings: Settings) -> Model:
    scores = np.array([share @ logits[buckets] + bias for buckets, share, _, _ in rows], np.float64)
    labels = np.array([r[2] for r in rows])
    at = np.arange(len(rows))
    loss = lambda t: -np.log(softmax(scores / t)[at, labels] + 1e-12).mean()
    temperature = min(np.geomspace(1, 20, 61), key=loss)
    chances = softmax(scores / temperature)
    right = np.sort(chances.max(1)[chances.argmax(1) == labels])
    threshold = min(settings.floor, right[int(settings.lost * len(right))]) if len(right) else settings.floor
    return Model(languages, logits.astype(np.float32), np.asarray(bias, np.float64), float(temperature), float(threshold))


def identify(documents: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """Add a struct (lang, score, accepted); rows and other columns stay as they are.

    ``lang`` is ``und`` with score 0, and not accepted, where the text is null or has no
    letter, or where nothing was learned. Repeated rows are judged alike; empty tables give
    empty tables; an existing column called ``name`` is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, accepted boolean")
    def predict(texts: pa.Array) -> pa.Array:
        model, texts = shared.value, pc.fill_null(texts, "")
        lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}"))
        if not model.languages:
            lettered[:] = False
            best, score = np.zeros(len(texts), int), np.zeros(len(texts))
        else:
            chances = model.probabilities(texts)
            best, score = chances.argmax(1), chances.max(1)
        names = np.array([*model.languages, UNDETERMINED], dtype=object)[np.where(lettered, best, len(model.languages))]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.where(lettered, np.minimum(score, 1.0), 0.0)),
             pa.array(lettered & (score >= model.threshold))], ["lang", "score", "accepted"])

    # Not deterministic, so that the plan never works it out twice.
    return documents.withColumn(name, predict.asNondeterministic()(F.col(text)))


def keep_identified(documents: DataFrame, model: Model) -> DataFrame:
    """The rows whose language is accepted, with their columns."""
    name = fresh(documents, "language")
    return identify(documents, model, name=name).where(F.col(f"{name}.accepted")).drop(name)
