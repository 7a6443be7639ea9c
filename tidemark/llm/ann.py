"""Nearest neighbours by cosine from balanced posting lists.

Fitting: a bounded sample is split by k-means again and again until no cell has more than
``cell`` of its rows, which balances the lists; the cells' means are the centroids. They lie in
memory, with a graph of each one's nearest others, and are searched best-first through it.

Index: every vector goes to its nearest centroid's list, and to those of other centroids that are
hardly farther (boundary vectors). How much farther, and the ratio of a query's search below, are the ones that
compare the fewest vectors among those that reach the wanted recall on a part of the sample, which is searched by brute force.
Search: a query takes the centroids it finds whose distance
is within a ratio of the nearest one's, and the next nearest ones until their lists hold ``k + 1`` distinct vectors (all
lists, if those it finds do not), and is compared with all vectors of their lists.

Lists are tables. A long one is split into blocks of bounded size, and each block answers for
its own rows. Equal vectors are searched once: ties go to the smaller id, so of each vector only the
``k + 1`` smallest ids can be in a result. Nothing else is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import written


@dataclass(frozen=True)
class Settings:
    """``sample``: rows that the fit looks at, at most; ``cell``: of these in a list at most; ``recall``: share of true neighbours
    wanted, of ``tried`` queries in ``among`` of the sample's rows; ``spreads``, ``copies``: ratios of distances to choose from and number of
    lists for a boundary vector; ``ratios``: of distances for a query's lists, to choose from; ``beam``: centroids
    kept while searching, so lists of a query but for those that make up the number of candidates; ``block``: rows of a
    list, and queries, that meet in one group."""

    sample: int = 20_000
    cell: int = 100
    recall: float = 0.97
    tried: int = 200
    among: int = 4_000
    spreads: tuple[float, ...] = (1.0, 1.03, 1.08)
    copies: int = 4
    ratios: tuple[float, ...] = (1.0, 1.02, 1.05, 1.1, 1.15, 1.2, 1.27, 1.35, 1.6, 2.0)
    beam: int = 96
    degree: int = 24
    block: int = 4_000
    seed: int = 5


class Centroids:
    def __init__(self, points: np.ndarray, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        cells, means = [np.arange(len(points))], []
        while cells:
            cell = cells.pop()
            parts = _split(points[cell], min(8, -(-len(cell) // settings.cell)), rng) if len(cell) > settings.cell else []
            if len(parts) > 1:
                cells += [cell[p] for p in parts]
            elif len(cell):
                means.append(points[cell].mean(axis=0))
        self.means = np.array(means, np.float32).reshape(len(means), points.shape[1])
        near = np.argsort(self._far(self.means, np.arange(len(means))[None, :].repeat(len(means), 0)), axis=1)[:, : settings.degree + 1]
        # A few far ones in each row, so that the graph hangs together.
        self.graph = np.concatenate([near, rng.integers(0, len(means), (len(means), 4))], axis=1) if len(means) else near
        self.beam = min(settings.beam, len(means))

    def _far(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distances of each point to its own row of centroids."""
        found = self.means[at]
        return np.sqrt(np.maximum((found * found).sum(2) - 2 * np.einsum("ij,ikj->ik", points, found) + (points * points).sum(1)[:, None], 0))

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of each point and their distances, nearest first, best-first through the graph."""
        n, k = len(points), len(self.means)
        seen = np.zeros((n, k), bool)
        rows = np.arange(n)[:, None]
        start = np.unique(np.linspace(0, k - 1, self.beam).astype(int))
        held = np.repeat(start[None, :], n, 0)
        far = self._far(points, held)
        seen[rows, held] = True
        done = np.zeros(held.shape, bool)
        while True:
            order = np.argsort(np.where(done, np.inf, far), axis=1)[:, :4]
            live = ~np.take_along_axis(done, order, 1)
            if not live.any():
                break
            done[rows, order] = True
            near = self.graph[np.take_along_axis(held, order, 1)].reshape(n, -1)
            new = ~seen[rows, near] & np.repeat(live, self.graph.shape[1], 1)
            seen[rows, near] = True
            # The same centroid may come from two neighbours: the second is as good as the first, and goes.
            ranked = np.sort(np.where(new, near, k), axis=1)
            ranked[:, 1:][ranked[:, 1:] == ranked[:, :-1]] = k
            ok = ranked < k
            near = np.where(ok, ranked, 0)
            held, far = np.concatenate([held, near], 1), np.concatenate([far, np.where(ok, self._far(points, near), np.inf)], 1)
            done = np.concatenate([done, ~ok], 1)
            best = np.argsort(far, axis=1, kind="stable")[:, : self.beam]
            held, far, done = (np.take_along_axis(x, best, 1) for x in (held, far, done))
        best = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(held, best, 1), np.take_along_axis(far, best, 1)


def tuned(points: np.ndarray, centroids: Centroids, settings: Settings, k: int) -> tuple[float, float, float, float]:
    """(spread, ratio, recall, work): the least work, as a share of all rows compared, that reaches the recall; else the most recall."""
    part = points[: settings.among].astype(np.float64)
    found = [centroids.search(part[a : a + 512].astype(np.float32)) for a in range(0, len(part), 512)]
    at, far = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    asked = np.arange(0, len(part), max(1, len(part) // settings.tried))
    scores = part[asked] @ part.T
    scores[np.arange(len(asked)), asked] = -2
    true = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(part) - 1)]
    tried = []
    for spread in settings.spreads:
        posted = np.zeros((len(part), len(centroids.means)), bool)
        near = far[:, : settings.copies] <= spread * far[:, :1] + 1e-9
        rows, place = np.nonzero(near)
        posted[rows, at[rows, place]] = True
        sizes = posted.sum(axis=0)
        for ratio in settings.ratios:
            probed = np.zeros((len(asked), posted.shape[1]), bool)
            rows, place = np.nonzero(far[asked] <= ratio * far[asked, :1] + 1e-9)
            probed[rows, at[asked[rows], place]] = True
            hit = (posted[true] & probed[:, None, :]).any(axis=2)
            tried.append((spread, ratio, float(hit.mean()) if hit.size else 1.0, float((probed @ sizes).mean() / len(part))))
    enough = [t for t in tried if t[2] >= settings.recall]
    return min(enough, key=lambda t: t[3]) if enough else max(tried, key=lambda t: (t[2], -t[3]))


def _split(points: np.ndarray, k: int, rng) -> list[np.ndarray]:
    means = points[rng.choice(len(points), k, replace=False)]
    for _ in range(8):
        label = ((means * means).sum(1) - 2 * points @ means.T).argmin(1)
        means = np.array([points[label == c].mean(0) if (label == c).any() else means[c] for c in range(k)])
    return [p for c in range(k) if len(p := np.flatnonzero(label == c))]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(1))[:, None]).astype(np.float32)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): ids are not null; vectors are not null, empty or zero, and have only finite components."""
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & fine)


def nearest(vectors: DataFrame, queries: str, k: int = 5, settings: Settings = Settings(), vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of each row that meets the condition ``queries`` on ``vec_id``, the k nearest others.

    Score is the cosine of the original vectors in double precision; ties go to the smaller id. Vectors that are null,
    zero, or hold null or non-finite components take no part; shorter vectors count as followed by zeros. Rows with the same
    id and vector are one. With fewer than k candidates the result has them all.
    """
    spark = vectors.sparkSession
    # Vectors go on times a power of two, which is exact: no square is too small or too large for a double then, and the
    # cosine is the same to the last bit wherever the plain one is neither zero nor infinite.
    power = F.floor(F.log2(F.array_max(F.transform("v", F.abs))))
    factor = F.pow(F.lit(2.0), -F.greatest(F.lit(-1_000), F.least(F.lit(1_000), power)))
    rows = written(usable(vectors, vec_id, embedding).withColumn("factor", factor), "vectors")
    sizes = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    even = F.transform("v", lambda x: x * F.col("factor"))
    if sizes["least"] != sizes["most"]:
        even = F.concat(even, F.array_repeat(F.lit(0.0), F.lit(sizes["most"]) - F.size("v")))
    rows = rows.select("vec_id", even.alias("v"))
    # Equal vectors: the k + 1 smallest ids, cut down before the shuffle.
    order = Window.partitionBy("v").orderBy("vec_id")
    few = written(rows.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1), "few")
    distinct = few.where("n = 1").select(F.col("vec_id").alias("key"), "v")
    asked = rows.where(queries).distinct().join(distinct.select("key", F.col("v").alias("w")), F.col("v") == F.col("w")).select("vec_id", "key")
    asked = written(asked, "asked")
    sample = distinct.orderBy(F.xxhash64("key")).limit(settings.sample).toArrow()
    if not len(sample):
        return spark.range(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    points = _unit(_matrix(sample.column("v").combine_chunks()))
    centroids = Centroids(points, settings)
    boundary, ratio, _, _ = tuned(points, centroids, settings, k)
    shared = spark.sparkContext.broadcast(centroids)

    def lists(ratio: float, most: int, held: np.ndarray | None = None):
        """Each vector's lists; ``held``: vectors of each list that are in no nearer one, of which k + 1 are wanted."""

        def of(batches):
            for batch in batches:
                for low in range(0, len(batch), 512):
                    part = batch.slice(low, 512)
                    at, far = shared.value.search(_unit(_matrix(part.column("v"))))
                    at, far = at[:, :most], far[:, :most]
                    near = far <= ratio * far[:, :1] + 1e-9
                    if held is not None:
                        sizes = np.where(np.isfinite(far), held[at], 0)
                        until = np.cumsum(sizes, axis=1)
                        near |= (until - sizes <= k) & np.isfinite(far)
                        poor = np.flatnonzero(until[:, -1] <= k)
                        near[poor] = False
                    row, place = np.nonzero(near)
                    found, first = at[row, place], place == 0
                    if held is not None and len(poor):
                        row = np.concatenate([row, np.repeat(poor, len(held))])
                        found = np.concatenate([found, np.tile(np.arange(len(held)), len(poor))])
                        first = np.concatenate([first, np.zeros(len(poor) * len(held), bool)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.astype(np.int32)), part.column("key").take(pa.array(row)), part.column("v").take(pa.array(row)), pa.array(first)],
                        names=["list", "key", "v", "first"])

        return of

    columns = "list int, key long, v array<double>, first boolean"
    posted = written(distinct.mapInArrow(lists(boundary, settings.copies), columns), "lists")
    held = np.zeros(len(shared.value.means), np.int64)
    for r in posted.where("first").groupBy("list").count().collect():
        held[r["list"]] = r["count"]
    blocks = posted.groupBy("list").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    searching = distinct.join(asked.select("key").distinct(), "key")
    probes = written(searching.mapInArrow(lists(ratio, settings.beam, held), columns), "probes")
    spread = posted.join(blocks, "list").select("list", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("block"), "key", "v")
    sent = probes.join(blocks, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "key", "v")

    def compare(asking: pa.Table, held: pa.Table) -> pa.Table:
        out: list = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(asking) and len(held):
            q, c = (_matrix(t.column("v").combine_chunks()) for t in (asking, held))
            ids, mine = held.column("key").to_numpy(), asking.column("key").to_numpy()
            order = np.argsort(ids)
            ids, c = ids[order], c[order]
            c_size, q_size = np.sqrt((c * c).sum(1)), np.sqrt((q * q).sum(1))
            found = []
            for low in range(0, len(q), 256):
                scores = q[low : low + 256] @ c.T / (q_size[low : low + 256, None] * c_size)
                top = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
                found.append((np.repeat(mine[low : low + 256], top.shape[1]), ids[top].ravel(), np.take_along_axis(scores, top, 1).ravel()))
            out = [np.concatenate(x) for x in zip(*found)]
        return pa.table(dict(zip(("key", "other", "score"), out)))

    # The asking side is dealt out too: a list that many queries look into is several groups, each with all of the block's rows.
    turns = probes.groupBy("list").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("turns"))
    sent = sent.join(turns, "list").withColumn("turn", F.pmod(F.xxhash64("key"), "turns").cast("int")).drop("turns")
    spread = spread.join(turns, "list").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
    hits = sent.groupBy("list", "block", "turn").cogroup(spread.groupBy("list", "block", "turn")).applyInArrow(
        compare, "key long, other long, score double"
    )
    # One sum for each pair, not one for each block's matrix: replicas agree, and equal scores tie.
    hits = hits.select("key", "other").distinct()
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    dot = F.aggregate(F.zip_with("v", "w", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = hits.join(searching, "key").join(distinct.select(F.col("key").alias("other"), F.col("v").alias("w")), "other")
    scored = scored.select("key", "other", (dot / (size(F.col("v")) * size(F.col("w")))).alias("score"))
    ids = few.select("vec_id", "v").join(distinct, "v").select(F.col("key").alias("other"), "vec_id")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    # One more than asked for, as the query's own row is among them.
    top = scored.join(ids, "other").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).select("key", "vec_id", "score")
    mine = asked.select(F.col("vec_id").alias("query_id"), "key").join(top, "key").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
