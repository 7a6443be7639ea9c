"""Preference pairs as training text: the common turns once as prompt, then two masked completions.

All of it is joins and aggregates by turn; no conversation is ever gathered in one row, so one
of any length is spread like many short ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OPEN, _CLOSE, _END = "<|", "|>\n", "<|end|>\n"


def rendered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, text, learned) for each turn of a conversation (conv_id, turn, role, text).

    Null roles and texts count as empty. Equal rows of a turn count once; different ones are rendered one after the
    other in binary order, and are learned only if all are the assistant's. Rows without conv_id or turn are left out.
    """
    said = F.concat(F.lit(_OPEN), F.coalesce("role", F.lit("")), F.lit(_CLOSE), F.coalesce("text", F.lit("")), F.lit(_END))
    rows = turns.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", said.alias("said"), (F.coalesce("role", F.lit("")) == "assistant").alias("own"))
    return rows.groupBy("conv_id", "turn").agg(
        F.array_join(F.array_sort(F.collect_set("said")), "").alias("text"), F.bool_and("own").alias("learned")
    )


def preference_turns(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, part, turn, text, mask) for pairs (pair_id, chosen, rejected) of conversations.

    ``part`` is ``prompt`` for the longest common prefix of turns, rendered once, else ``chosen`` or ``rejected``.
    ``mask`` is 1 where the text is to be learned: the assistant's turns of the completions. Equal conversations are
    all prompt. A pair of which a conversation has no turns is left out; other columns are not looked at.
    """
    slots = rendered_turns(turns)
    sides = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.col("chosen").alias("conv_id"), F.lit("chosen").alias("side")),
        F.struct(F.col("rejected").alias("conv_id"), F.lit("rejected").alias("side")))).alias("s")).select("pair_id", "s.*")
    said = sides.distinct().join(slots, "conv_id")
    side = lambda name: F.max(F.when(F.col("side") == name, F.struct("text", "learned"))).alias(name)
    lined = said.groupBy("pair_id", "turn").agg(side("chosen"), side("rejected"))
    apart = F.when(~F.col("chosen.text").eqNullSafe(F.col("rejected.text")), F.col("turn"))
    cuts = lined.groupBy("pair_id").agg(F.min(apart).alias("cut"), F.count("chosen").alias("c"), F.count("rejected").alias("r"))
    cut = lined.join(cuts.where("c > 0 and r > 0"), "pair_id")
    common = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    part = lambda name, c: F.struct(F.lit(name).alias("part"), F.col(c)["text"].alias("text"), F.col(c)["learned"].alias("learned"))
    parts = F.when(common, F.array(part("prompt", "chosen"))).otherwise(F.array(part("chosen", "chosen"), part("rejected", "rejected")))
    rows = cut.select("pair_id", "turn", F.explode(parts).alias("p")).where("p.text is not null")
    mask = F.when((F.col("p.part") != "prompt") & F.col("p.learned"), 1).otherwise(0)
    return rows.select("pair_id", "p.part", "turn", "p.text", mask.alias("mask"))


def assembled(parts: DataFrame) -> DataFrame:
    """(pair_id, prompt, chosen, rejected) as whole strings, for conversations that fit a row."""
    text = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(F.col("part") == name, F.struct("turn", "text")))), lambda s: s["text"]), "").alias(name)
    return parts.groupBy("pair_id").agg(text("prompt"), text("chosen"), text("rejected"))


# The same over conversations 2k (chosen) and 2k + 1 (rejected).
SQL = """
with slots as (
  select conv_id, turn, array_to_string(list_sort(list_distinct(list('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10)))), '') said,
         bool_and(coalesce(role, '') = 'assistant') learned
  from conversations where conv_id is not null and turn is not null group by all),
lined as (
  select conv_id // 2 pair_id, turn, max(case when conv_id % 2 = 0 then said end) c, max(case when conv_id % 2 = 1 then said end) r,
         bool_or(case when conv_id % 2 = 0 then learned end) cl, bool_or(case when conv_id % 2 = 1 then learned end) rl
  from slots group by all),
cuts as (
  select pair_id, min(case when c is distinct from r then turn end) cut from lined group by pair_id having count(c) > 0 and count(r) > 0),
cut as (select l.*, (cut is null or turn < cut) common from lined l join cuts using (pair_id))
select pair_id, 'prompt' part, turn, c as text, 0 mask from cut where common
union all select pair_id, 'chosen', turn, c, cl::int from cut where not common and c is not null
union all select pair_id, 'rejected', turn, r, rl::int from cut where not common and r is not null
"""
