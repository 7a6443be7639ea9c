"""Near duplicates: MinHash bands propose, odd sketches estimate, full shingle sets confirm.

A document's set holds the hashes of its runs of five words (A-Z taken as a-z). Documents
with equal sets are one class and go on as their smallest id. Of each class:

- 128 MinHash values, four to a band; documents that agree in a band share a bucket. At a
  similarity of 0.85, two miss each other in all 32 bands with a chance below 1e-10.
- an odd sketch: one MinHash sample from each of 1024 ranges of the hash, each flipping one
  of 1024 bits. The bits in which two sketches differ tell how many samples differ, which
  estimates a high similarity to about 0.02. Pairs more than about five times that below
  the limit are dropped; every other link is confirmed on the full sets.

Only which documents hang together is wanted, so pairs of a group are not listed. First,
each bucket (in random parts, if it is large) gives a spanning forest of its highest
estimates; the 32 bands part it differently, so a group of copies hangs together after
this. Then only buckets whose members still belong to different components are looked at
again, and of these the pairs that the estimate leaves open and that no earlier band had. A bucket's most
frequent component is not compared with itself: its members stay where they are, each once for each part of the others, and
only the others go to all of its parts. Where open pairs are few, they are listed; where many, the texts go to the bucket and are counted there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import fresh, whole, written
from tidemark.llm.components import components
from tidemark.llm.words import mix, slices, words_of

_BANDS, _ROWS, _BITS = 32, 4, 1024
_RNG = np.random.Generator(np.random.PCG64(11))
_FACTORS = (_RNG.integers(0, 1 << 63, _BANDS * _ROWS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, _BANDS * _ROWS).astype(np.uint64)
_WEIGHTS = (_RNG.integers(0, 1 << 63, _ROWS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_PROFILE = "doc_id long, n_shingles long, key long, key2 long, bands array<long>, sketch binary, samples int"


@dataclass(frozen=True)
class Settings:
    """Two documents are linked if 100 x intersection >= ``percent`` x union. ``part`` and ``shingles``: members of a
    bucket, and their shingles, that are one part of it, as a rule; larger buckets are handled in parts, and pairs of parts.
    ``pairs``: estimates that a task makes, about."""

    words: int = 5
    percent: int = 85
    part: int = 1000
    shingles: int = 2_000_000
    pairs: int = 1_000_000


def shingle_sets(texts: pa.Array, k: int):
    """The sorted distinct shingle hashes of text after text; a shorter text is one shingle, one without words none."""
    for a, b in slices(texts):
        words = words_of(texts.slice(a, b - a), fold=True)
        runs, _ = words.runs(k)
        alone = words.whole()
        for i, (low, high) in enumerate(zip(words.offsets.tolist(), words.offsets[1:].tolist())):
            if high - low >= k:
                yield np.unique(runs[low : high - k + 1])
            else:
                yield alone[i : i + 1] if high > low else alone[:0]


def _minima(shingles: np.ndarray) -> np.ndarray:
    best = None
    for at in range(0, len(shingles), 2048):
        some = (shingles[at : at + 2048, None] * _FACTORS + _SHIFTS).min(axis=0)
        best = some if best is None else np.minimum(best, some)
    return best


def _sketch(shingles: np.ndarray) -> tuple[bytes, int]:
    """The parity bitmap of the smallest shingle in each range of the hash, and the number of ranges that have one."""
    ranges = shingles >> np.uint64(64 - 10)
    first = np.ones(len(shingles), bool)
    first[1:] = ranges[1:] != ranges[:-1]
    samples = mix(shingles[first])
    parity = np.bincount((samples >> np.uint64(54)).astype(np.int64), minlength=_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes(), len(samples)


def _profiles(settings: Settings):
    numbers = np.arange(_BANDS, dtype=np.uint64)

    def of(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for s in shingle_sets(batch.column("text"), settings.words):
                if len(s):
                    bands = mix((_minima(s).reshape(_BANDS, _ROWS) * _WEIGHTS).sum(axis=1) + numbers)
                    # Two sums of the set under different hashes: equal for equal sets only.
                    keys = [int(mix(s + np.uint64(c)).sum().astype(np.int64)) for c in (1, 2)]
                    row = (len(s), *keys, bands.astype(np.int64).tolist(), *_sketch(s))
                else:
                    row = (0, None, None, None, None, 0)
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32())
            arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _PROFILE.split(", ")])

    return of


# Estimates


class _Group:
    """Members of one part of a bucket and the estimates between them."""

    def __init__(self, table: pa.Table, settings: Settings):
        self.ids = table.column("doc_id").to_numpy()
        bits = b"".join(table.column("sketch").to_pylist())
        self.sketches = np.frombuffer(bits, np.uint64).reshape(len(self.ids), -1)
        self.samples = table.column("samples").to_numpy().astype(np.float64)
        self.limit = settings.percent / 100 - 0.06

    def open_pairs(self, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated similarities of member i with others, and which of them may reach the limit."""
        differ = np.bitwise_count(self.sketches[others] ^ self.sketches[i]).sum(axis=1, dtype=np.int64)
        apart = -_BITS / 2 * np.log1p(-2 * np.minimum(differ, _BITS / 2 - 1) / _BITS)
        larger = np.maximum(self.samples[others], self.samples[i])
        common = (self.samples[others] + self.samples[i] - apart) / 2
        return (estimate := common / larger), estimate >= self.limit - 0.5 / np.sqrt(larger)


def _forest(settings: Settings):
    """A spanning forest of the highest estimates in a group, grown member by member."""

    def of(table: pa.Table) -> pa.Table:
        group = _Group(table, settings)
        n = len(group.ids)
        best, link = np.full(n, -np.inf), np.zeros(n, np.int64)
        rest, pairs, at = np.arange(1, n), [], 0
        while len(rest):
            estimate, may = group.open_pairs(at, rest)
            better = may & (estimate > best[rest])
            best[rest[better]], link[rest[better]] = estimate[better], at
            chosen = int(best[rest].argmax())
            at = int(rest[chosen])
            if np.isfinite(best[at]):
                pairs.append((group.ids[link[at]], group.ids[at]))
            rest = np.delete(rest, chosen)
        return _pairs(pairs)

    return of


def _open(table: pa.Table, settings: Settings):
    """For each member of the first part: those of the second that lie in another component, had no earlier common
    band with it, and are not ruled out by the estimate."""
    group = _Group(table, settings)
    labels, own, band = (table.column(c).to_numpy() for c in ("label", "own", "band"))
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(labels), _BANDS)
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
    for at, i in enumerate(left):
        others = right[at + 1 :] if first == second else right
        others = others[labels[others] != labels[i]]
        if len(others):
            others = others[group.open_pairs(i, others)[1]]
            others = others[~(bands[others, : band[i]] == bands[i, : band[i]]).any(axis=1)]
            if len(others):
                yield i, others


def _across(settings: Settings):
    """The open pairs of a group if they are few; else the members that have any, to be compared where they meet."""

    def of(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        found = list(_open(table, settings))
        if sum(len(others) for _, others in found) <= 2 * len(ids):
            a = np.repeat(ids[[i for i, _ in found]], [len(o) for _, o in found]) if found else ids[:0]
            b = ids[np.concatenate([o for _, o in found])] if found else ids[:0]
            out = pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        else:
            some = np.unique(np.concatenate([[i for i, _ in found], *(o for _, o in found)]))
            out = pa.table({"a": ids[some], "b": pa.nulls(len(some), pa.int64())})
        for name, kind in (("bucket", pa.int64()), ("first", pa.int32()), ("second", pa.int32())):
            out = out.append_column(name, pa.array([table.column(name)[0].as_py()] * len(out), kind))
        return out

    return of


def _met(settings: Settings):
    """Links between the components of a group, by exact counts: one link at most for each that it joins."""

    def of(table: pa.Table) -> pa.Table:
        ids, labels = table.column("doc_id").to_numpy(), table.column("label").to_numpy().copy()
        sets = list(shingle_sets(table.column("text").combine_chunks(), settings.words))
        sizes = np.array([len(x) for x in sets])
        shingles, holder = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(shingles, kind="stable")
        shingles, holder = shingles[order], holder[order]
        pairs = []
        for i, others in _open(table, settings):
            others = others[labels[others] != labels[i]]
            if len(others):
                low, high = (np.searchsorted(shingles, sets[i], side=x) for x in ("left", "right"))
                n = high - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                both = np.bincount(holder[at], minlength=len(sets))[others]
                alike = others[100 * both >= settings.percent * (sizes[others] + sizes[i] - both)]
                for j in alike:
                    if labels[j] != labels[i]:
                        pairs.append((ids[i], ids[j]))
                        labels[labels == labels[j]] = labels[i]
        return _pairs(pairs)

    return of


def _pairs(pairs: list) -> pa.Table:
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


# Confirmation


def confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets reach the limit.

    The texts of all partners of a come to where the text of a is; a document with very many partners is sent to
    several places. Rows arrive sorted, so a task holds the set of one document and looks at partner after partner.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / settings.part).cast("int").alias("places"))
    partners = pairs.join(degree, "a").select(
        "a", F.pmod(F.xxhash64("b"), "places").cast("int").alias("place"), F.col("b").alias("doc_id"), F.lit(1).alias("side")
    )
    hubs = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"),
                         F.col("a").alias("doc_id"), F.lit(0).alias("side"))
    routed = partners.unionByName(hubs).join(texts, "doc_id").select("a", "place", "side", "doc_id", "text")
    percent, k = settings.percent, settings.words

    def check(batches):
        hub, held = None, []
        for batch in batches:
            found = []
            a, place, side, doc_id = (batch.column(c).to_pylist() for c in ("a", "place", "side", "doc_id"))
            for i, mine in enumerate(shingle_sets(batch.column("text"), k)):
                if side[i] == 0:
                    held = held if hub == (a[i], place[i]) else []
                    hub, held = (a[i], place[i]), [*held, mine]
                    continue
                for other in held:
                    both = len(np.intersect1d(mine, other, assume_unique=True))
                    if both and 100 * both >= percent * (len(mine) + len(other) - both):
                        found.append((a[i], doc_id[i]))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], pa.int64()) for j in (0, 1)], names=["a", "b"])

    dealt = routed.repartition("a", "place").sortWithinPartitions("a", "place", "side", "doc_id")
    return dealt.mapInArrow(check, "a long, b long")


# The operator


def _open_rows(labelled: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, band, doc_id, label, own, first, second): the members of buckets with several components, where they meet others.

    Parts of a bucket's most frequent component have numbers below zero, those of the other members from zero on. A member
    of that component meets each part of the others; one of the others meets those, and every part of it.
    """
    sizes = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    most = F.max_by(F.struct("label", "n", "s"), F.struct("n", "label")).alias("most")
    mixed = sizes.groupBy("bucket").agg(most, F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("labels")).where("labels > 1")
    parts = lambda n, s: F.greatest(F.ceil(n / settings.part), F.ceil(s / settings.shingles), F.lit(1)).cast("int")
    mixed = mixed.select(
        "bucket", F.col("most.label").alias("main"), parts(F.col("most.n"), F.col("most.s")).alias("main_parts"),
        parts(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.s")).alias("other_parts"),
    )
    rows = labelled.join(mixed, "bucket")
    is_main, hashed = F.col("label") == F.col("main"), F.xxhash64("doc_id")
    own = F.when(is_main, -1 - F.pmod(hashed, "main_parts")).otherwise(F.pmod(hashed, "other_parts")).cast("int")
    other = F.explode(F.sequence(F.when(is_main, F.lit(0)).otherwise(-F.col("main_parts")), F.col("other_parts") - 1)).alias("other")
    return rows.select("bucket", "band", "doc_id", "label", own.alias("own"), other).select(
        "bucket", "band", "doc_id", "label", "own", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second")
    )


def near_duplicates(documents: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row: the smallest id that it hangs together with.

    Null and empty texts, and texts without words, have no shingles and hang together with nothing. Rows with the
    same id are one document, linked if any of its texts is; a null id gets a null component and is kept. Other
    columns are not looked at. An empty table gives an empty result.
    """
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    profiles = written(source.mapInArrow(_profiles(settings), _PROFILE), "profiles")
    linkable = profiles.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("key", "key2").agg(F.min("doc_id").alias("rep"))
    copies = linkable.select("doc_id", "key", "key2").join(classes, ["key", "key2"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    reps = linkable.join(classes.select(F.col("rep").alias("doc_id"), "key", "key2"), ["doc_id", "key", "key2"])
    banded = reps.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "bucket")).distinct()
    crowded = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = written(banded.join(crowded, "bucket"), "members")
    involved = members.select("doc_id").distinct()
    texts = written(source.join(involved, "doc_id", "left_semi"), "texts")
    described = written(reps.join(involved, "doc_id", "left_semi").select("doc_id", "bands", "sketch", "samples").dropDuplicates(["doc_id", "sketch"]), "described")

    parts = F.ceil(F.col("n") / settings.part).cast("int")
    part = F.pmod(F.xxhash64("doc_id", "band"), parts).cast("int")
    rows = members.select("bucket", part.alias("part"), "doc_id").join(described.drop("bands"), "doc_id")
    # Tasks by the pairs that they estimate: their bytes are few.
    work = crowded.agg(F.sum(F.col("n") * F.least("n", F.lit(settings.part)))).first()[0] or 0
    rows = rows.repartition(max(1, min(100_000, int(work) // settings.pairs)), "bucket", "part")
    forest = rows.groupBy("bucket", "part").applyInArrow(_forest(settings), "a long, b long").where("a <> b").distinct()
    tried = written(forest, "forest")
    links = written(confirmed(tried, texts, settings).distinct(), "links")

    labels = components(links)
    labelled = members.join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "bucket", "band", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("label"))
    labelled = written(labelled, "labelled")
    open_rows = _open_rows(labelled, settings)
    keys = ["bucket", "first", "second"]
    grouped = open_rows.join(described, "doc_id").groupBy(*keys)
    more = written(grouped.applyInArrow(_across(settings), "a long, b long, bucket long, first int, second int"), "open")
    pairs = more.where("a <> b").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    few = confirmed(written(pairs, "pairs"), texts, settings)
    crowds = more.where("b is null").select(F.col("a").alias("doc_id"), *keys).join(open_rows, ["doc_id", *keys])
    many = crowds.join(described, "doc_id").join(texts, "doc_id").groupBy(*keys).applyInArrow(_met(settings), "a long, b long")
    found = written(few.unionByName(many).distinct(), "links")

    joined = components(links.unionByName(found).unionByName(copies.where("a <> b")))
    smallest = joined.select(F.col("node").alias("doc_id"), "component")
    result = profiles.select("doc_id", "n_shingles").join(smallest, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return result.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(documents: DataFrame, settings: Settings = Settings(percent=80), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: the one with the smallest id, with its columns. Rows without an id all stay."""
    dropped = near_duplicates(documents, settings, doc_id, text).where("not kept").select(F.col("doc_id").alias(name := fresh(documents, "dropped")))
    return documents.join(dropped, F.col(doc_id).cast("long") == F.col(name), "left_anti")
