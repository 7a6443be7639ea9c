"""Removal of passages that recur anywhere, exact over all windows of ``window`` words.

An anchor is the run of ``anchor`` words with the smallest hash in a window, so equal windows
have equal anchors, and few runs are anchors at all. Documents are dealt to blocks of
about ``block_bytes`` of text. Three steps follow:

1. Anchors are counted over all documents; those that occur once are done with.
2. Windows with a recurring anchor are counted, by 96 bits of hash: recurring passages are
   confirmed, all others ruled out. Counts are combined before every shuffle, so a passage
   that a third of the documents share is one row for each block.
3. Each block compiles its shard of the automaton (pyahocorasick) from the recurring
   anchors that its documents can hold, and streams all its documents through it once. A hit proposes the windows
   around it; these, and no others, are compared with what is known of windows with a recurring anchor, and confirmed ones are covered.

Blocks bound the automaton and the texts in memory; no document meets more than one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import groups_for, whole, written
from tidemark.llm.words import Words, slices, words_of

_SALT = 0x5851F42D4C957F2D


@dataclass(frozen=True)
class Settings:
    window: int = 35
    anchor: int = 12
    block_bytes: int = 2 << 20


def _slide(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of n values from each place on; shorter at the end."""
    out, span = values.copy(), 1
    while span < n:
        step = min(span, n - span)
        out[:-step] = pick(out[:-step], out[step:]) if step < len(out) else out[:-step]
        span += step
    return out


class _Windows:
    """Of some texts: ``ok`` for each word that begins a window, the windows' ``anchor`` hashes, and ``chosen`` for words
    that begin the anchor of a window; all by word."""

    def __init__(self, words: Words, settings: Settings):
        self.words = words
        n = settings.window - settings.anchor + 1
        self.runs, _ = words.runs(settings.anchor)
        left = np.repeat(words.offsets[1:], np.diff(words.offsets)) - np.arange(len(words.hashes))
        self.ok = left >= settings.window
        self.anchor = _slide(self.runs, n, np.minimum)
        # A run is chosen if it is the smallest in one of the windows around it: those that begin up to n - 1 words before.
        best = np.where(self.ok, self.anchor, 0)[::-1]
        self.chosen = (_slide(best, n, np.maximum)[::-1] == self.runs) & (left >= settings.anchor)
        # The windows looked back at may be another text's; what is chosen by them only is no harm, just no use.

    def pairs(self, at: np.ndarray, settings: Settings) -> np.ndarray:
        """Both hashes of the windows at some words: 64 and 32 bits."""
        out = np.empty(len(at), [("a", "<u8"), ("b", "<u4")])
        out["a"] = self.words.runs(settings.window)[0][at]
        out["b"] = (self.words.runs(settings.window, _SALT)[0][at] >> np.uint64(32)).astype(np.uint32)
        return out


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among others, which are sorted."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _anchors(settings: Settings):
    """How often each anchor occurs, by block."""

    def of(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for low, high in slices(batch.column("text")):
                found = _Windows(words_of(batch.column("text").slice(low, high - low)), settings)
                at = np.flatnonzero(found.chosen)
                doc = np.searchsorted(found.words.offsets, at, side="right") - 1
                rows = np.empty(len(at), [("h", "<u8"), ("block", "<i4")])
                rows["h"], rows["block"] = found.runs[at], batch.column("block").slice(low, high - low).to_numpy()[doc]
                rows, n = np.unique(rows, return_counts=True)
                columns = [_signed(rows["h"]), pa.array(np.ascontiguousarray(rows["block"])), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "block", "n"])

    return of


def _candidates(settings: Settings):
    """The windows of a block with a recurring anchor. ``tail``: 32 bits of hash, the block, and whether it occurs again in it."""

    def of(texts: pa.Table, known: pa.Table) -> pa.Table:
        anchors = np.unique(known.column("a").to_numpy().view(np.uint64))
        found = [np.zeros(0, [("a", "<u8"), ("b", "<u4")])]
        column = texts.column("text").combine_chunks()
        for low, high in slices(column):
            windows = _Windows(words_of(column.slice(low, high - low)), settings)
            at = np.flatnonzero(windows.ok)
            at = at[_member(windows.anchor[at], anchors)]
            found.append(windows.pairs(at, settings))
        rows, n = np.unique(np.concatenate(found), return_counts=True)
        block = texts.column("block")[0].as_py() if len(texts) else 0
        tail = (rows["b"].astype(np.int64) << 31) | (block << 1) | (n > 1)
        return pa.table({"head": _signed(rows["a"]), "tail": tail})

    return of


def _kept(settings: Settings):
    """The block's documents without the words of recurring windows."""

    def of(texts: pa.Table, known: pa.Table) -> pa.Table:
        import ahocorasick

        kind, a, b = (known.column(c).to_numpy() for c in ("kind", "a", "b"))
        anchors = np.unique(a[kind == 0].view(np.uint64))
        single = np.empty((kind == 1).sum(), [("a", "<u8"), ("b", "<u4")])
        single["a"], single["b"] = a[kind == 1].view(np.uint64), b[kind == 1]
        single.sort()
        column, ids = texts.column("text").combine_chunks(), texts.column("doc_id").combine_chunks()
        shard, parts, phrases = ahocorasick.Automaton(), [], set()
        for low, high in slices(column):
            windows = _Windows(words_of(column.slice(low, high - low)), settings)
            # The words of each recurring anchor, from its first place in the block.
            places = np.flatnonzero(windows.chosen)
            places = places[_member(windows.runs[places], anchors)]
            hashes, first = np.unique(windows.runs[places], return_index=True)
            words = windows.words
            for h, place in zip(hashes.tolist(), places[first].tolist()):
                if h not in phrases:
                    phrases.add(h)
                    spans = zip(words.starts[place : place + settings.anchor], words.ends[place : place + settings.anchor])
                    phrase = b" ".join([words.data[s:e].tobytes() for s, e in spans]).decode()
                    shard.add_word(f" {phrase} ", True)
            parts.append((low, high, windows))
        if phrases:
            shard.make_automaton()

        def confirmed(windows: _Windows, at: np.ndarray) -> np.ndarray:
            """Of proposed windows those that recur: their anchor does, and they are none of those that occur once."""
            at = at[windows.ok[at]]
            at = at[_member(windows.anchor[at], anchors)]
            return at[~_member(windows.pairs(at, settings), single)] if len(at) else at

        rows = [
            row for low, high, windows in parts
            for row in zip(ids.slice(low, high - low).to_pylist(), _strip(column.slice(low, high - low), windows, confirmed, shard if phrases else None, settings))
        ]
        done = [(doc_id, *rest) for doc_id, rest in rows]
        columns = list(zip(*done)) or [()] * 4
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            names=["doc_id", "n_words", "n_removed", "text"],
        )

    return of


def _strip(texts: pa.Array, windows: _Windows, confirmed, shard, settings: Settings):
    """For each text: words, removed words, and what is left joined by single spaces."""
    offsets, reach = windows.words.offsets, settings.window - settings.anchor
    near, split = np.zeros(len(windows.ok) + 1, np.int64), []
    for i, text in enumerate(texts.to_pylist()):
        words = [w.decode() for w in text.encode().split()]
        joined = " ".join(words)
        split.append((words, joined))
        ends = [end for end, _ in shard.iter(f" {joined} ")] if shard is not None and len(words) >= settings.window else []
        if ends:
            starts = np.fromiter(itertools.accumulate((len(w) + 1 for w in words), initial=0), np.int64, len(words) + 1)
            # A phrase ends with the space behind its last word, where the next word's leading space stands too.
            hits = np.searchsorted(starts, np.array(ends)) - settings.anchor
            np.add.at(near, offsets[i] + np.maximum(hits - reach, 0), 1)
            np.add.at(near, offsets[i] + hits + 1, -1)
    at = confirmed(windows, np.flatnonzero(np.cumsum(near)[:-1] > 0))
    cover = np.zeros(len(near), np.int64)
    cover[at] += 1
    cover[at + settings.window] -= 1
    left = np.cumsum(cover)[:-1] <= 0
    for (words, joined), a, b in zip(split, offsets, offsets[1:]):
        some = left[a:b]
        removed = int((~some).sum())
        yield len(words), removed, " ".join(itertools.compress(words, some.tolist())) if removed else joined


def without_recurring(documents: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, text) for each row: the words left, joined by one space.

    Null texts have no words. Repeated rows are documents of their own, so the passages of copies recur and go from all
    of them. Texts with fewer words than a window stay whole. Other columns are not looked at. An empty table gives
    an empty result.
    """
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    blocks = groups_for(source, F.octet_length("text"), settings.block_bytes)
    block = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).cast("int")
    dealt = source.withColumn("block", block)
    anchors = written(dealt.select("text", "block").mapInArrow(_anchors(settings), "h long, block int, n int"), "anchors")
    recurring = anchors.groupBy("h").agg(F.sum("n").alias("times")).where("times > 1").select("h")
    relevant = written(anchors.join(recurring, "h").select("block", F.col("h").alias("a")), "relevant")
    seen = dealt.groupBy("block").cogroup(relevant.groupBy("block")).applyInArrow(_candidates(settings), "head long, tail long")
    # The shuffle carries two numbers a window; a window that occurs once comes from one block, which is then the smallest.
    low = F.col("tail").bitwiseAND(F.lit((1 << 31) - 1))
    counted = seen.groupBy("head", F.shiftright("tail", 31).alias("b")).agg(
        F.sum(F.lit(1) + low.bitwiseAND(F.lit(1))).alias("times"), F.min(low).alias("low")
    )
    single = counted.where("times = 1").select(F.shiftright("low", 1).cast("int").alias("block"), F.lit(1).alias("kind"), F.col("head").alias("a"), "b")
    known = relevant.select("block", F.lit(0).alias("kind"), "a", F.lit(0).cast("long").alias("b")).unionByName(single)
    kept = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _kept(settings), "doc_id long, n_words long, n_removed long, text string"
    )
    return kept
