"""Preference pairs of conversations: a shared prompt and two masked completions.

Column expressions only: turns are gathered per pair, compared place by place, and rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED = ("assistant",)


def render(turn: Column) -> Column:
    """One turn as text; nulls are empty."""
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"), F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def format_pairs(pairs: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """``pairs``: pair_id, chosen and rejected (array<struct<role, text>>, null for a missing side).

    Result: pair_id, n_shared, prompt, and for each side its completion and the spans [begin, end) of it
    that are learned: the texts of ``learned`` roles with their end mark.  All else, and the whole prompt,
    is masked.  The prompt is the longest common turn prefix (null equals null); a missing side shares nothing and
    has a null completion.  Equal conversations are all prompt, with empty completions.
    """
    least = F.least(F.size("chosen"), F.size("rejected"))
    same = F.transform(F.slice("chosen", 1, least), lambda t, i: F.struct(t.alias("t"), F.get("rejected", i).alias("o")))
    differs = F.transform(same, lambda p: ~(p["t"]["role"].eqNullSafe(p["o"]["role"]) & p["t"]["text"].eqNullSafe(p["o"]["text"])))
    first = F.array_position(differs, True)
    both = F.col("chosen").isNotNull() & F.col("rejected").isNotNull()
    shared = F.when(both, F.when(first > 0, first - 1).otherwise(least.cast("long"))).otherwise(0).cast("int")
    out = pairs.withColumn("n_shared", shared)

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("n_shared") + 1, F.greatest(F.size(side), F.lit(0)))

    def spans(side: str) -> Column:
        sized = F.transform(rest(side), lambda t: F.struct(
            F.length(render(t)).alias("size"), (F.length(F.coalesce(t["role"], F.lit(""))) + 5).alias("head"),
            F.coalesce(t["role"].isin(*learned), F.lit(False)).alias("on")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
        folded = F.aggregate(sized, start, lambda acc, t: F.struct(
            (acc["at"] + t["size"]).alias("at"),
            F.when(t["on"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["head"]).alias("begin"), (acc["at"] + t["size"] - 1).alias("end")))))
            .otherwise(acc["spans"]).alias("spans")))
        return folded["spans"]

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, render), "")

    one = F.coalesce("chosen", "rejected")
    return out.select(
        "pair_id", "n_shared", text(F.slice(one, 1, F.col("n_shared"))).alias("prompt"),
        text(rest("chosen")).alias("chosen"), spans("chosen").alias("chosen_learned"),
        text(rest("rejected")).alias("rejected"), spans("rejected").alias("rejected_learned"))


def adjacent_pairs(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) as pair k; a conversation without its partner is
    paired with null.  Rows with a null conversation are no conversation.  Equal turn numbers are ordered by
    role and text; a null turn number comes first.  Turns move once, and no group is larger than two
    conversations, however many share a first turn."""
    conv = F.col(f"`{key}`").cast("long")
    item = F.struct(F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = turns.select(conv.alias("conv"), item.alias("item")).where("conv is not null")
    rows = rows.withColumn("pair_id", F.expr("conv div 2 - if(conv < 0 and conv % 2 <> 0, 1, 0)"))
    odd = F.pmod("conv", F.lit(2)) == 1

    def side(mine: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(mine, F.col("item"))))

    rows = rows.groupBy("pair_id").agg(side(~odd).alias("even"), side(odd).alias("odd"))

    def shown(items: str) -> Column:
        return F.when(F.size(items) > 0, F.transform(items, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))

    return rows.select("pair_id", shown("even").alias("chosen"), shown("odd").alias("rejected"))
