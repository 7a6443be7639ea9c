"""Log10 probability of whole texts under a hidden Markov model learned from the corpus.

Tokens are words with A-Z lower-cased, and one end for each text. A token is drawn in two steps: a latent state gives its class, and the
class gives the word. A word with at least one in ``2 ** 15`` of all training tokens is a class of its own, the end is one, and the others
share ``SHARED`` classes by hash. Within a class a word has its share of the counts plus one, and one more goes to all words that training
never saw. So the states, which Baum-Welch finds, look at a bounded number of classes, while the words' counts grow with the corpus.

1. Words are counted: batches, then tasks, then Spark by word. The words with at least one in ``2 ** 18`` tokens, so at most that many,
   form a dictionary of hash, count and class that all tasks get, 16 bytes a word.
2. Texts become classes, two bytes a token, and the list of words that are not in the dictionary.
3. Each round of Baum-Welch passes over the classes of all training texts. Tasks add up their expected counts, Spark adds up the tasks' by
   class, and the new model, as many numbers as classes times states, goes out with the next round.
4. The forward recursion gives each text the exact probability of its classes. Words outside the dictionary, each rare, meet their counts
   in a join by word, and come back as one sum a text.

Null texts are empty: their only token is the end. Null ids are trained on and not held out. Equal rows are texts of their own. Without
training texts nothing is known, and every word is as likely as its class. An empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import whole, written
from tidemark.llm.hmm import Counts, Model
from tidemark.llm.words import Words, slices, words_of

# Own classes and dictionary words are those with at least one token in so many. All classes fit in two bytes.
_OWN, _KNOWN = 1 << 15, 1 << 18
SHARED = 4096
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass(frozen=True)
class Settings:
    """``mixed``: the part of each distribution that is an even one, or the classes' overall shares."""

    states: int = 4
    rounds: int = 3
    mixed: float = 0.01
    seed: int = 12


def _spelled(words: Words, at: np.ndarray) -> pa.Array:
    """The words at these places, with A-Z lower-cased."""
    lengths = words.ends[at] - words.starts[at]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    data = _FOLD[words.data[np.repeat(words.starts[at] - offsets[:-1], lengths) + np.arange(offsets[-1])]]
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, h, n) of a ``text`` column: each word, its hash, how often it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, parts = batch.column(0), []
            for a, b in slices(column):
                words = words_of(column.slice(a, b - a), fold=True)
                hashes, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                parts.append((hashes, _spelled(words, first), n))
            if parts:
                hashes, first, of = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
                n = np.bincount(of, np.concatenate([p[2] for p in parts]), len(hashes)).astype(np.int64)
                spelled = pa.concat_arrays([p[1] for p in parts]).take(pa.array(first))
                yield pa.RecordBatch.from_arrays([spelled, pa.array(hashes.view(np.int64)), pa.array(n)], names=["word", "h", "n"])

    each = texts.select(whole("text").alias("text")).mapInArrow(count, "word string, h long, n long")
    return each.groupBy("word").agg(F.max("h").alias("h"), F.sum("n").alias("n"))


class Vocabulary:
    """What tasks know of the counts: the dictionary's hashes, counts and classes, and the counts of whole classes."""

    def __init__(self, counts: DataFrame, texts: int):
        words = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
        self.texts = texts
        self.tokens = (words["tokens"] or 0) + texts
        self.words = words["words"] + (texts > 0)
        own = self._at_least(_OWN)
        known = counts.where(self._at_least(_KNOWN)).select("h", "n", own.alias("own")).toArrow()
        order = np.argsort(np.asarray(known["h"]).view(np.uint64), kind="stable")
        self.hashes = np.asarray(known["h"]).view(np.uint64)[order]
        self.counts = np.asarray(known["n"], np.int64)[order]
        is_own = np.asarray(known["own"], bool)[order]
        shared = self.of_hash(self.hashes)
        self.end = SHARED
        self.classes = np.where(is_own, SHARED + np.cumsum(is_own), shared).astype(np.uint16)
        # Of the shared classes, counts plus one of all words, and one for those never seen; the others have one word.
        self.room = np.ones(SHARED + 1 + int(is_own.sum()))
        self.tally = np.zeros(len(self.room))
        rest = counts.where(~own).groupBy(F.pmod("h", F.lit(SHARED)).cast("int").alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
        for r in rest.collect():
            self.room[r["class"]] += r["n"] + r["words"]
            self.tally[r["class"]] = r["n"]
        self.tally[self.end] = texts
        self.tally[SHARED + 1 :] = self.counts[is_own]

    def _at_least(self, share: int) -> Column:
        return F.col("n") >= F.lit(-(-self.tokens // share))

    def rare(self) -> Column:
        return ~self._at_least(_KNOWN)

    @staticmethod
    def of_hash(hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(SHARED - 1)).astype(np.int64)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each token, and its count, -1 where the dictionary does not have it."""
        if not len(self.hashes):
            return self.of_hash(hashes).astype(np.uint16), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = self.hashes[at] == hashes
        return np.where(found, self.classes[at], self.of_hash(hashes)).astype(np.uint16), np.where(found, self.counts[at], -1)


_ENCODED = "n_tokens long, n_known long, known_log double, class_log double, classes binary, rest array<string>"


def encode(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of ``texts`` but its ``text``, and of each text: tokens; those in the dictionary; their log10(count + 1) summed; the same
    without those of one-word classes, less the classes' room; the classes; and the words that are not in the dictionary."""
    kept = [c for c in texts.columns if c != "text"]
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        room = np.log10(v.room)
        for batch in batches:
            column = batch.column("text")
            for a, b in slices(column):
                words = words_of(column.slice(a, b - a), fold=True)
                classes, counts = v.look_up(words.hashes)
                known = counts >= 0
                logs = np.log10(np.maximum(counts, 0) + 1.0)
                of_class = np.where(classes > v.end, 0.0, np.where(known, logs, 0.0) - room[classes])
                rest = np.flatnonzero(~known)
                sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[words.offsets])
                n = np.diff(words.offsets)
                ends = np.full(len(n), v.end, np.uint16).tobytes()
                data = classes.tobytes()
                coded = [data[2 * x : 2 * y] + ends[:2] for x, y in zip(words.offsets[:-1], words.offsets[1:])]
                spelled = pa.ListArray.from_arrays(pa.array(np.searchsorted(rest, words.offsets), pa.int32()), _spelled(words, rest))
                columns = [
                    pa.array(n + 1), pa.array(np.rint(sums(known)).astype(np.int64) + (v.texts > 0)),
                    pa.array(sums(np.where(known, logs, 0.0)) + np.log10(v.texts + 1.0)),
                    pa.array(sums(of_class)), pa.array(coded, pa.binary()), spelled,
                ]
                names = [*kept, "n_tokens", "n_known", "known_log", "class_log", "classes", "rest"]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(a, b - a) for c in kept] + columns, names=names)

    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in kept)
    return texts.mapInArrow(code, f"{schema}, {_ENCODED}")


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of several texts, and where each begins."""
    sizes = np.array([len(x) // 2 for x in column.to_pylist()], np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16), np.concatenate([[0], np.cumsum(sizes)])


def _round(coded: DataFrame, model: Model) -> Counts:
    """The expected counts of all texts. Row -1 is the first state, -2 the likelihood, -3 and on the moves from each state."""
    states, classes = len(model.start), len(model.emit)
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts.none(states, classes)
        for batch in batches:
            if len(batch):
                shared.value.count(*_sequences(batch.column(0)), counts)
        seen = np.flatnonzero(counts.emit.any(axis=1))
        rows = np.concatenate([counts.emit[seen], counts.start[None], np.full((1, states), counts.log10), counts.move])
        names = np.concatenate([seen, np.arange(-1, -3 - states, -1)])
        columns = [pa.array(names, pa.int32()), *(pa.array(np.ascontiguousarray(rows[:, s])) for s in range(states))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *(f"s{s}" for s in range(states))])

    columns = [f"s{s}" for s in range(states)]
    each = coded.select("classes").mapInArrow(count, "row int, " + ", ".join(f"{c} double" for c in columns))
    found = each.groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = Counts.none(states, classes)
    rows = np.asarray(found["row"], np.int64)
    values = np.stack([np.asarray(found[c], np.float64) for c in columns], axis=1).reshape(-1, states)
    out.emit[rows[rows >= 0]] = values[rows >= 0]
    for row, value in zip(rows[rows < 0], values[rows < 0]):
        if row == -1:
            out.start = value
        elif row == -2:
            out.log10 = float(value[0])
        else:
            out.move[-3 - row] = value
    return out


def train(coded: DataFrame, vocabulary: Vocabulary, settings: Settings = Settings()) -> tuple[Model, list[float]]:
    """The model after some rounds over all ``coded`` texts, and the log10 likelihood of their classes before each round."""
    share = (vocabulary.tally + 1) / (vocabulary.tally + 1).sum()
    model, logs = Model.guess(share, settings.states, settings.seed), []
    for _ in range(settings.rounds if vocabulary.texts else 0):
        counts = _round(coded, model)
        logs.append(counts.log10)
        model = Model.fitted(counts, share, settings.mixed)
    return model, logs


def likelihoods(documents: DataFrame, held_out: Column, settings: Settings = Settings(), doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row; learns from those not ``held_out``.

    ``base_score`` is the sum over tokens of log10((c + 1) / (N + V + 1)): counts, all tokens and distinct ones of training.
    """
    texts = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), whole(text).alias("text")
    )
    counts = written(word_counts(texts.where("not held_out")), "counts")
    vocabulary = Vocabulary(counts, texts.where("not held_out").count())
    coded = written(encode(texts, vocabulary).withColumn("row", F.monotonically_increasing_id()), "coded")
    model, _ = train(coded.where("not held_out"), vocabulary, settings)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("classes")
            found = shared.value.log10(*_sequences(batch.column(at))) if len(batch) else np.zeros(0)
            yield batch.set_column(at, "state_log", pa.array(found))

    columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "known_log", "class_log", "classes"]
    plain = coded.select(*columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema if f.name != "classes")
    scored = plain.mapInArrow(score, f"{schema}, state_log double")
    rest = coded.select("row", F.explode("rest").alias("word")).join(counts.where(vocabulary.rare()).select("word", "n"), "word")
    rest = rest.groupBy("row").agg(F.sum(F.log10(F.col("n") + 1.0)).alias("rest_log"), F.count("*").alias("rest_known"))
    log, n = F.coalesce("rest_log", F.lit(0.0)), F.coalesce("rest_known", F.lit(0))
    return scored.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + n).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("known_log") + log - F.col("n_tokens") * float(np.log10(vocabulary.tokens + vocabulary.words + 1))).alias("base_score"),
        (F.col("state_log") + F.col("class_log") + log).alias("score"),
    )
