"""Merkle manifest of a table: a tree of digests for each group of rows, and one over the groups.

A leaf is the digest of a row's fields. The leaves of a group stand in the order of an item column; every ``FANOUT``
consecutive nodes of a level become one node of the next, until one is left. The groups' last nodes, in the order of
the groups, become one in the same way. Digests are lowercase hex SHA-256 of their inputs put together, digests as hex text.

Rows get their places from one sort over all groups, cut into ranges; what a range has to know of those before it is a
count for each group. A *layer* is several levels at once: the nodes of a group are cut into blocks of ``FANOUT ** LEVELS``
consecutive ones, and within a block each level is a pass of lag and lead columns at fixed offsets, the distance of two
neighbours of that level. The node's slot in its run and the run's length mask them; what is left are the siblings, and the
first child of a run hashes its parent. So no group, however large, meets in one task. The block's last nodes are the next layer.

Only digests move. Nulls count as ``-``, other values as their length in UTF-8 bytes, a colon, and themselves. Null groups
are a group of their own and come first, null items come first in theirs; equal items are in the order of their leaves, and
equal rows are leaves of their own with the same proof. An empty table has an empty manifest. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import written

FANOUT = 8
# Levels that one layer has: blocks of 512 nodes.
LEVELS = 3


def row_digest(fields: list[Column]) -> Column:
    """The leaf of a row."""
    return F.sha2(F.concat(*[_field(f.cast("string")) for f in fields]), 256)


def _field(value: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(rows: DataFrame, group: str, item: str, fields: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """(group, item, leaf, found), written: ``found`` is the leaf with some fields changed, or null where that is the same."""
    leaf = row_digest([F.col(f) for f in fields])
    found = row_digest([(changed or {}).get(f, F.col(f)) for f in fields]) if changed else leaf
    digests = rows.select(F.col(group).alias("group"), F.col(item).alias("item"), leaf.alias("leaf"), found.alias("found"))
    return written(digests.withColumn("found", F.nullif("found", "leaf")).withColumn("tie", F.monotonically_increasing_id()), "leaves")


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``p`` and ``n``: the place of each node in its group by ``order``, from 0, and the group's number of nodes.

    ``nodes`` has to be a written table, and no two of its rows equal in ``order``.
    """
    dealt = nodes.repartitionByRange("group", *order).sortWithinPartitions("group", *order)
    # The id is the number of the range and, in its lower 33 bits, the row's place there.
    at = written(dealt.withColumn("at", F.monotonically_increasing_id()), "ranges").withColumn("part", F.shiftright("at", 33))
    runs = at.groupBy("group", "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    whole, earlier = Window.partitionBy("group"), Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("group").alias("_group"), F.col("part").alias("_part"), F.sum("here").over(whole).alias("n"),
        (F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("first")).alias("_shift"),
    )
    found = at.join(runs, F.col("group").eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part")))
    return found.select(*nodes.columns, (F.col("at") + F.col("_shift")).alias("p"), "n")


def _div(number: str | Column, by: int) -> Column:
    return F.call_function("div", F.col(number) if isinstance(number, str) else number, F.lit(by))


def _layer(nodes: DataFrame, levels: int) -> DataFrame:
    """Add ``pairs``, the siblings before and after each node and its ancestors below the block's last node, level by level,
    and ``top``, that last node. ``nodes`` has group, p, n, h."""
    kept = list(nodes.columns)
    # A column of its own: windows that name the same columns share one shuffle and one sort.
    nodes = nodes.withColumn("block", _div("p", FANOUT**levels))
    ordered = Window.partitionBy("group", "block").orderBy("p")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    pairs = []
    for level in range(levels):
        step = FANOUT**level
        at = _div("p", step)
        slot = at % FANOUT
        run = F.least(F.lit(FANOUT), _div(F.col("n") + (step - 1), step) - (at - slot))
        before = [F.when(slot >= k, F.lag("h", k * step).over(ordered)) for k in range(FANOUT - 1, 0, -1)]
        after = [F.when(slot + k < run, F.lead("h", k * step).over(ordered)) for k in range(1, FANOUT)]
        # A group that has one node left has its last: nothing is hashed any more.
        own = (F.col("p") % step == 0) & (F.col("n") > step)
        nodes = nodes.withColumn("_pair", F.when(own, F.struct(F.concat_ws("", *before).alias("before"), F.concat_ws("", *after).alias("after"))))
        parent = F.when(F.col("n") > step, F.sha2(F.concat("h", "_pair.after"), 256)).otherwise(F.col("h"))
        # All descendants of a node stand behind its own row and before that of the next.
        pair = F.col("_pair") if level == 0 else F.last("_pair", ignorenulls=True).over(so_far)
        pairs.append(f"_pair{level}")
        nodes = nodes.withColumn(pairs[-1], pair).withColumn("h", F.when(F.col("p") % (step * FANOUT) == 0, parent))
    top = F.last("h", ignorenulls=True).over(so_far).alias("top")
    return nodes.select(*[c for c in kept if c != "h"], "block", F.array_compact(F.array(*pairs)).alias("pairs"), top)


def _tops(layer: DataFrame, size: int) -> DataFrame:
    return layer.where(F.col("p") % size == 0).select(
        "group", F.col("block").alias("p"), _div(F.col("n") + (size - 1), size).alias("n"), F.col("top").alias("h")
    )


def _climb(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """``nodes`` without h, with ``pairs``, the siblings of each and its ancestors, and ``top``, its group's last node; and (group, h), those."""
    size = FANOUT**levels
    most = nodes.agg(F.max("n")).first()[0] or 0
    layer = _layer(nodes, levels)
    if most <= size:
        return layer.drop("block"), layer.where("p = 0").select("group", F.col("top").alias("h"))
    above, ends = _climb(written(_tops(layer, size), "layer"), levels)
    above = above.select(
        F.col("group").alias("_group"), F.col("p").alias("_p"), F.col("pairs").alias("_pairs"), F.col("top").alias("_top")
    )
    joined = layer.join(above, F.col("group").eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_p")))
    return joined.select(
        *[c for c in layer.columns if c not in ("block", "pairs", "top")], F.concat("pairs", "_pairs").alias("pairs"), F.col("_top").alias("top")
    ), ends


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(group, item, leaf, subroot, root, proof_sha256, folded_root, verified) of each leaf.

    ``proof_sha256`` is the digest of all siblings, level by level. ``folded_root`` is made of the leaf as it was found
    and those siblings, and ``verified`` tells whether that is the root.
    """
    below, ends = _climb(placed(leaves.withColumn("h", F.col("leaf")), ["item", "leaf", "tie"]).drop("tie"), levels)
    # One group of groups: they stand in their own order.
    subroots = written(ends.select(F.lit(0).alias("group"), F.col("group").alias("of"), "h", F.col("h").alias("subroot")), "subroots")
    above = _climb(placed(subroots, ["of"]), levels)[0].select(
        F.col("of").alias("_of"), "subroot", F.col("pairs").alias("_pairs"), F.col("top").alias("root")
    )
    # As many groups as there are, which may be many: no hint.
    found = below.join(above, F.col("group").eqNullSafe(F.col("_of"))).withColumn("pairs", F.concat("pairs", "_pairs"))
    proof = F.array_join(F.transform("pairs", lambda x: F.concat(x["before"], x["after"])), "")
    folded = F.aggregate("pairs", F.coalesce("found", "leaf"), lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))
    return found.select(
        "group", "item", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents_manifest(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents by language, with every third document's text changed after its leaf was made."""
    struck = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(struck, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    made = leaves(documents, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"text": text})
    return manifest(made, levels).drop("group").withColumnRenamed("item", "doc_id")


# The same for up to 8 ** 7 documents a language and 64 languages: each level's nodes joined with those above them.
_LEVEL_SQL = """{name}{up} as (
  select g, p // 8 as p, (n + 7) // 8 as n,
         case when n > 1 then sha256(string_agg(h, '' order by p)) else min(h) end as h
  from {name}{at} group by g, p // 8, n
), {name}{at}s as (
  select g, p, n > 1 as live,
         coalesce(string_agg(h, '') over (partition by g, p // 8 order by p rows between unbounded preceding and 1 preceding), '') as b,
         coalesce(string_agg(h, '') over (partition by g, p // 8 order by p rows between 1 following and unbounded following), '') as a
  from {name}{at}
)"""


def _tree_sql(name: str, levels: int) -> str:
    return ",\n".join(_LEVEL_SQL.format(name=name, at=at, up=at + 1) for at in range(levels))


def _proof_sql(name: str, levels: int) -> tuple[str, str, str]:
    """Joins of a node ``x`` with its ancestors' siblings, those siblings, and the fold of ``{}``."""
    joins = " ".join(
        f"join {name}{at}s {name}s{at} on {name}s{at}.g is not distinct from x.{name}g and {name}s{at}.p = x.{name}p // {8**at}" for at in range(levels)
    )
    proof = " || ".join(f"case when {name}s{at}.live then {name}s{at}.b || {name}s{at}.a else '' end" for at in range(levels))
    return joins, proof, f"list_reduce([{{}}, {', '.join(f'case when {name}s{at}.live then {name}s{at}.b || chr(9) || {name}s{at}.a end' for at in range(levels))}], lambda h, s: case when s is null then h else sha256(replace(s, chr(9), h)) end)"


def _sql(levels: int = 7, over: int = 2) -> str:
    fields = " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
    leaf = f"sha256({fields} || coalesce(strlen({{0}}) || ':' || {{0}}, '-'))"
    crc = """xor(list_reduce(flatten([[4294967295]] || list_transform(string_split(doc_id::varchar, ''), lambda d: [ord(d), -1, -1, -1, -1, -1, -1, -1, -1])),
                     lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, (c & 1) * 3988292384) end), 4294967295)"""
    joins, proof, fold = _proof_sql("l", levels)
    over_joins, over_proof, over_fold = _proof_sql("r", over)
    return f"""
with struck as (
  select *, case when {crc} % 3 = 0 then translate(text, '{_UPPER}', '{_LOWER}') else text end as found from documents
), leaves as (
  select doc_id, lang, {leaf.format("text")} as leaf, {leaf.format("found")} as found from struck
), l0 as (
  select lang as g, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as p,
         count(*) over (partition by lang) as n, leaf as h, doc_id, found
  from leaves
),
{_tree_sql("l", levels)}, r0 as (
  select 0 as g, g as lang, row_number() over (order by g nulls first) - 1 as p, count(*) over () as n, h from l{levels}
),
{_tree_sql("r", over)}, under as (
  select x.doc_id, x.h as leaf, x.lg, {proof} as proof, {fold.format("x.found")} as folded
  from (select *, g as lg, p as lp from l0) x {joins}
), above as (
  select u.*, r0.h as subroot, 0 as rg, r0.p as rp from under u join r0 on r0.lang is not distinct from u.lg
), done as (
  select x.doc_id, x.leaf, x.subroot, (select h from r{over}) as root, sha256(x.proof || {over_proof}) as proof_sha256,
         {over_fold.format("x.folded")} as folded_root
  from above x {over_joins}
)
select *, folded_root = root as verified from done"""


SQL = _sql()
