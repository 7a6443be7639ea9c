"""Benchmark passages in documents, found by spaced seeds and verified around each hit.

Words are compared without regard to the case of A-Z. A seed is a fixed mask of selected
and ignored word positions; test items and documents are hashed under every mask at every
position, so a passage with substituted words still shares a hash with its item as long as
no mask's selected words were hit. The masks are chosen for each number of words such that every pattern
of substitutions that the threshold allows leaves one of them whole, so none is missed. Each common hash gives an item and an alignment; along
it, the words of item and document are compared one by one. A document is contaminated by
an item if of some ``window`` consecutive words of it (all of them, if it has fewer), a share
of ``similarity`` or more stands in the document at the same alignment.

The test items are the stated query set: they go to the tasks in parts of at most
``part_bytes`` of text, each a pass over the documents, and no document is ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.base import fresh, whole
from tidemark.llm.words import mix, slices, words_of

# Selected (1) and ignored (0) positions: of so many words with so many substituted, wherever they are, one mask is left whole.
_LONG = ("11101011", "110110011", "1101000111", "1011010011")
MASKS = {
    (5, 1): ("1111", "11101", "11011", "10111"), (6, 1): ("1111", "11011"), (7, 1): ("11111", "111011", "110111"),
    (8, 1): ("11111", "111011"), (9, 1): ("1111011", "1101111"), (10, 2): ("11111", "111011", "11010011"),
    (11, 2): ("1101011", "1110011"), (12, 2): (*_LONG, "111111"), (13, 2): _LONG, (14, 2): _LONG,
    (15, 3): (*_LONG, "111001011"), (16, 3): (*_LONG, "111111"),
}
HITS = "array<struct<item_id:long,overlap:double>>"
_FILTER_BITS = 20
_FACTOR = 0xD1342543DE82EF95  # any odd number


@dataclass(frozen=True)
class Settings:
    window: int = 16
    similarity: float = 0.8
    part_bytes: int = 8 << 20


def masks_for(words: int, settings: Settings) -> tuple[str, ...]:
    """Masks of which a copy of an item of so many words keeps one whole, if it is within the threshold."""
    n = min(settings.window, words)
    lost = max((e for e in range(n) if (n - e) / n >= settings.similarity), default=0)
    # Elsewhere, the run that is left between the substituted words however they lie.
    return MASKS.get((n, lost)) or ("1" * -(-(n - lost) // (lost + 1)),)


def _seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed's hash at each position where it fits, not looking at text bounds."""
    n = len(hashes) - len(mask) + 1
    out = np.full(max(n, 0), len(mask), np.uint64)
    for at, selected in enumerate(mask):
        if selected == "1" and n > 0:
            out += hashes[at : at + n] * np.uint64(pow(_FACTOR, at + 1, 1 << 64))
    return mix(out)


class Index:
    """The seeds of some test items."""

    def __init__(self, items: list[Row], settings: Settings):
        self.settings, self.ids = settings, [r["item_id"] for r in items]
        words = words_of(pa.array([r["text"] for r in items], pa.large_string()), fold=True)
        self.words = [words.hashes[a:b] for a, b in zip(words.offsets, words.offsets[1:])]
        of = {n: masks_for(n, settings) for n in {len(w) for w in self.words if len(w)}}
        self.masks = sorted({mask for masks in of.values() for mask in masks})
        found = []
        for m, mask in enumerate(self.masks):
            for i, w in enumerate(self.words):
                if mask in of.get(len(w), ()):
                    seeds = _seeds(w, mask)
                    found.append((seeds, np.full(len(seeds), i), np.arange(len(seeds)), np.full(len(seeds), m)))
        seeds, item, place, mask = (np.concatenate([f[k] for f in found] or [np.zeros(0, int)]) for k in range(4))
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place, self.mask = seeds.astype(np.uint64)[order], item[order], place[order], mask[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.seeds >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, texts: pa.Array) -> list[list[dict]]:
        """For each text the items it holds, with the best overlap of each."""
        out: list[list[dict]] = []
        for a, b in slices(texts):
            words = words_of(texts.slice(a, b - a), fold=True)
            best: list[dict] = [{} for _ in range(b - a)]
            for doc, item, shift in self._alignments(words):
                overlap = self._overlap(words.hashes[words.offsets[doc] : words.offsets[doc + 1]], self.words[item], shift)
                key = self.ids[item]
                if overlap >= self.settings.similarity and overlap > best[doc].get(key, 0):
                    best[doc][key] = overlap
            out += [[{"item_id": k, "overlap": d[k]} for k in sorted(d)] for d in best]
        return out

    def _alignments(self, words) -> list[list[int]]:
        """Distinct (text, item, first word of the item relative to the text's) with a common seed."""
        found = []
        for m, mask in enumerate(self.masks):
            seeds = _seeds(words.hashes, mask)
            some = np.flatnonzero(self.filter[seeds >> np.uint64(64 - _FILTER_BITS)])
            low, high = (np.searchsorted(self.seeds, seeds[some], side=s) for s in ("left", "right"))
            n = high - low
            at = np.repeat(some, n)
            of = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            doc = np.searchsorted(words.offsets, at, side="right") - 1
            right = (self.mask[of] == m) & (at + len(mask) <= words.offsets[doc + 1])
            at, of, doc = at[right], of[right], doc[right]
            found.append(np.stack([doc, self.item[of], at - words.offsets[doc] - self.place[of]], axis=1))
        return np.unique(np.concatenate(found or [np.zeros((0, 3), int)]), axis=0).tolist()

    def _overlap(self, text: np.ndarray, item: np.ndarray, shift: int) -> float:
        same = np.zeros(len(item) + 1, np.int64)
        low, high = max(0, -shift), min(len(item), len(text) - shift)
        same[low + 1 : high + 1] = item[low:high] == text[low + shift : high + shift]
        n = min(self.settings.window, len(item))
        sums = np.cumsum(same)
        return float((sums[n:] - sums[:-n]).max() / n)


def _lookup(shared: Broadcast):
    @F.arrow_udf(HITS)
    def look(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("overlap", pa.float64())]))
        return pa.array(shared.value.hits(texts), kind)

    return look.asNondeterministic()


def contamination(documents: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "items",
                  settings: Settings = Settings()) -> DataFrame:
    """Add ``name``: the benchmark items (item_id, text) that a document holds, as ``HITS``, by item_id.

    Empty for documents without words, null or not, and if there are no items. Items without words or id are
    held by nothing; repeated items are one. Rows and other columns stay; a column ``name`` is replaced.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // settings.part_bytes))
    found, columns = documents, []
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        shared = documents.sparkSession.sparkContext.broadcast(Index(mine, settings))
        columns.append(fresh(found, f"part{part}"))
        found = found.withColumn(columns[-1], _lookup(shared)(whole(text)))
    return found.withColumn(name, F.array_sort(F.flatten(F.array(*columns)))).drop(*columns)


def keep_clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no benchmark item, with their columns."""
    name = fresh(documents, "items")
    return contamination(documents, benchmark, text, name, settings).where(F.size(name) == 0).drop(name)
