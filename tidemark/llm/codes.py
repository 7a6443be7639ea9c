"""Vectors as short codes: each part of a vector is named by the nearest entry of that part's codebook.

Vectors become integers first, so sums, distances and ties are exact. Codebooks start as the parts of the first vectors by id;
a round assigns every part to its nearest entry, found by a tree over the entries (``gnat``), and replaces an entry by the mean
of its parts, rounded down. All rows take part in every round: tasks add up their own, Spark adds up the tasks', and only the
codebooks, whose size is that of ``entries`` vectors, come to the driver and go back with the next round's tasks.

Rows whose vector is null or holds null or non-finite components are dropped. Shorter vectors count as followed by zeros, up
to the length of the longest, rounded up to equal parts. Of equal ids the lesser vector comes first, null ids come last; equal
rows are rows of their own. With fewer rows than entries there are as many entries as rows. Integers of any size are exact; an error
beyond a long is null, and so is that of its label. An empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import written
from tidemark.llm.gnat import Tree

# Totals travel as digits to this base, so that a long and a decimal hold what any number of rows add up to.
_DIGIT_BITS = 40
_LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, v, label) of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v"), F.col(label).alias("label")).where(fine)


def _whole(x: float, scale: int) -> int:
    return math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as doubles while those are exact, in rows of ``width``."""
    lengths = np.asarray(pc.list_value_length(column), np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    out = np.zeros((len(column), width))
    at = np.repeat(np.arange(len(column)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Codebook:
    """The entries of one part, as rows of Python integers."""

    def __init__(self, entries: list[list[int]], width: int, scale: int):
        self.entries, self.width, self.scale = entries, width, scale
        # Four parts' squared distances between components up to this by size add up to a long.
        self.limit = math.isqrt((1 << 60) // max(1, width)) // 2
        self.small = all(abs(x) <= self.limit for row in entries for x in row)
        self.trees: dict[type, Tree] = {}

    def _tree(self, kind: type) -> Tree:
        if kind not in self.trees:
            self.trees[kind] = Tree(np.array(self.entries, kind).reshape(len(self.entries), self.width))
        return self.trees[kind]

    def assign(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, integers, entries, squared distances), of the rows that int64 can hold, then of the others."""
        fits = (np.abs(points) * self.scale <= self.limit).all(axis=1) & self.small
        rows = np.flatnonzero(fits)
        if len(rows):
            whole = np.floor(points[rows] * self.scale).astype(np.int64)
            yield rows, whole, *self._tree(np.int64).nearest(whole)
        rows = np.flatnonzero(~fits)
        if len(rows):
            whole = np.array([[_whole(x, self.scale) for x in points[r].tolist()] for r in rows], object).reshape(len(rows), self.width)
            yield rows, whole, *self._tree(object).nearest(whole)


class _Totals:
    """Per part and entry: rows, and the sum of each component."""

    def __init__(self, settings: Settings, width: int):
        self.counts = np.zeros((settings.parts, settings.entries), np.int64)
        self.sums = np.zeros((settings.parts, settings.entries, width), object)

    def add(self, part: int, whole: np.ndarray, entries: np.ndarray) -> None:
        order = np.argsort(entries, kind="stable")
        found, starts, n = np.unique(entries[order], return_index=True, return_counts=True)
        self.counts[part, found] += n
        if whole.shape[1]:
            self.sums[part, found] += np.add.reduceat(whole[order], starts, axis=0).astype(object)

    def rows(self) -> pa.RecordBatch:
        out = []
        for part, entry in zip(*np.nonzero(self.counts)):
            out.append((part, entry, -1, 0, int(self.counts[part, entry])))
            for at, total in enumerate(self.sums[part, entry].tolist()):
                sign, total, digit = (-1 if total < 0 else 1), abs(total), 0
                while total:
                    out.append((part, entry, at, digit, sign * (total & ((1 << _DIGIT_BITS) - 1))))
                    total, digit = total >> _DIGIT_BITS, digit + 1
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        names = ["part", "entry", "at", "digit", "total"]
        columns = list(zip(*out)) or [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array([int(x) for x in c], k) for c, k in zip(columns, kinds)], names=names)


def _better(rows: DataFrame, books: list[Codebook], settings: Settings) -> list[Codebook]:
    """The codebooks after one more round."""
    width = books[0].width

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _Totals(settings, width)
        for batch in batches:
            points = integers(batch.column(0), width * settings.parts, settings.scale)
            for part, book in enumerate(books):
                for _, whole, entries, _ in book.assign(points[:, part * width : (part + 1) * width]):
                    totals.add(part, whole, entries)
        yield totals.rows()

    added = rows.select("v").mapInArrow(add_up, "part int, entry int, at int, digit int, total long")
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in added.groupBy("part", "entry", "at", "digit").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        of = found.setdefault((r["part"], r["entry"]), {})
        of[r["at"]] = of.get(r["at"], 0) + (int(r["total"]) << (_DIGIT_BITS * r["digit"]))
    return [
        Codebook(
            [[of.get(at, 0) // of[-1] for at in range(width)] if (of := found.get((part, entry))) else row
             for entry, row in enumerate(book.entries)],
            width, settings.scale,
        )
        for part, book in enumerate(books)
    ]


def train(rows: DataFrame, settings: Settings = Settings()) -> list[Codebook]:
    """The codebooks of ``usable`` rows, which are read once a round."""
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // settings.parts)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(settings.entries).collect()
    points = integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width * settings.parts, settings.scale)
    whole = [[_whole(x, settings.scale) for x in row] for row in points.tolist()]
    books = [Codebook([row[p * width : (p + 1) * width] for row in whole], width, settings.scale) for p in range(settings.parts)]
    for _ in range(settings.rounds if first else 0):
        books = _better(rows, books, settings)
    return books


def fingerprint(books: list[Codebook]) -> str:
    """SHA-256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for book in books for row in book.entries for x in row).encode()).hexdigest()


def encode(rows: DataFrame, books: list[Codebook], settings: Settings = Settings()) -> DataFrame:
    """(vec_id, label, code, error) of ``usable`` rows."""
    width = books[0].width
    kinds = rows.schema

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = integers(batch.column("v"), width * settings.parts, settings.scale)
            codes = np.zeros((len(points), len(books)), np.uint8)
            errors = np.zeros(len(points), object)
            for part, book in enumerate(books):
                for at, _, entries, apart in book.assign(points[:, part * width : (part + 1) * width]):
                    codes[at, part] = entries
                    errors[at] += apart.astype(object)
            error = pa.array([e if e <= _LONGEST else None for e in errors.tolist()], pa.int64())
            code = pa.array([c.tobytes().hex() for c in codes], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), code, error], names=["vec_id", "label", "code", "error"])

    schema = f"vec_id {kinds['vec_id'].dataType.simpleString()}, label {kinds['label'].dataType.simpleString()}, code string, error long"
    return rows.select("vec_id", "label", "v").mapInArrow(name, schema)


def compress(vectors: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding",
             label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row that takes part.

    Errors of a label are added up before they are joined back, so a label's rows never meet in one task.
    """
    rows = usable(vectors, vec_id, embedding, label)
    books = train(rows, settings)
    coded = written(encode(rows, books, settings), "codes")
    whole = F.try_sum("error")
    of_label = coded.groupBy(F.col("label").alias("_label")).agg(
        F.when(F.count("error") == F.count("*"), whole).alias("label_error")
    )
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )


_ROUND_SQL = """d{k} as (
  select v.vec_id, v.part, v.label, v.v,
         min(cast(list_dot_product(v.v, v.v) + list_dot_product(b.v, b.v) - 2 * list_dot_product(v.v, b.v) as bigint) * 256 + b.entry) as near
  from cut v join b{k} b on b.part = v.part group by all
)"""
_NEXT_SQL = """m{k} as (
  select part, entry, list(mean order by pos) as v from (
    select part, near % 256 as entry, pos, floor(sum(x) / count(*)) as mean
    from (select part, near, unnest(v) as x, generate_subscripts(v, 1) as pos from d{k}) group by 1, 2, 3
  ) group by 1, 2
), b{up} as (
  select b.part, b.entry, coalesce(m.v, b.v) as v from b{k} b left join m{k} m on m.part = b.part and m.entry = b.entry
)"""


def _sql(settings: Settings = Settings()) -> str:
    rounds = ",\n".join(f"{_ROUND_SQL.format(k=k)},\n{_NEXT_SQL.format(k=k, up=k + 1)}" for k in range(settings.rounds))
    last = settings.rounds
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor({settings.scale} * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cut as (
  select vec_id, label, part, v[part * len(v) // {settings.parts} + 1 : (part + 1) * len(v) // {settings.parts}] as v
  from kept, range({settings.parts}) as parts(part)
), b0 as (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, v
  from cut join (select vec_id from kept order by vec_id limit {settings.entries}) using (vec_id)
),
{rounds},
{_ROUND_SQL.format(k=last)}, coded as (
  select vec_id, label, string_agg(printf('%02x', near % 256), '' order by part) as code, sum(near // 256)::bigint as error
  from d{last} group by vec_id, label
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(x::bigint::varchar, ',' order by part, entry, pos))
        from (select part, entry, unnest(v) as x, generate_subscripts(v, 1) as pos from b{last})) as codebooks_sha256
from coded"""


SQL = _sql()
