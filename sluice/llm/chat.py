"""Chat formatting after collapsing cumulative snapshots.

A logged conversation is often stored again after each turn, so most of what is stored are beginnings of longer ones. Every
turn gets the hash of all turns up to it: the sum, over these turns, of a hash of the turn's number and content, twice
over with different hashes. A conversation whose last hash is also the hash of an inner turn of another one is a beginning
of it; an anti-join drops it. Of equal conversations the one with the smallest id stays. Only those that are left are
rendered, turn by turn.

Sums roll over parts of a conversation as they do over a whole, so no conversation has to fit in a task: turns are put in
order by range, each range sums its own, and the sums of the ranges before are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.joins import lookup_join, settle

KEY = ["conv", "turn", "digest"]


def content(role: Column, text: Column) -> Column:
    """Role and text in one, so that different pairs differ, nulls included."""
    return F.concat(F.coalesce(F.octet_length(role).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(role, F.lit("")),
                    F.when(text.isNull(), "-").otherwise("+"), F.coalesce(text, F.lit("")))


def ranged(turns: DataFrame) -> DataFrame:
    """Turns dealt out by conversation and order; ``part`` numbers the ranges, of which a long conversation has several."""
    dealt = turns.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id())
    return settle(dealt)


def rolled(turns: DataFrame, **sums: Column) -> DataFrame:
    """Adds the sum of each column over the turns of the conversation up to the row's own."""
    own = Window.partitionBy("part", "conv").orderBy("turn", "digest").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = turns.groupBy("part", "conv").agg(*(F.sum(value).alias(name) for name, value in sums.items()))
    parts = parts.select("part", "conv", *(F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"{name}_before")
                                           for name in sums))
    here = turns.select("*", *(F.sum(value).over(own).alias(name) for name, value in sums.items()))
    here = here.join(parts, ["part", "conv"])
    return here.select(*turns.columns, *((F.col(name) + F.col(f"{name}_before")).alias(name) for name in sums))


def turn_hashes(turns: DataFrame) -> DataFrame:
    """``seq``, the turn's place from 1, and ``prefix``, which stands for all turns up to it."""
    numbered = rolled(ranged(turns), seq=F.lit(1).cast("bigint"))
    hashed = rolled(numbered, a=F.xxhash64("seq", "digest").cast("decimal(20,0)"),
                    b=F.xxhash64("digest", F.lit("second"), "seq").cast("decimal(20,0)"))
    return settle(hashed.select("conv_id", *KEY, "seq", F.struct("seq", "a", "b").alias("prefix")))


def maximal(prefixes: DataFrame) -> DataFrame:
    """``conv`` and ``n_turns`` of the conversations that begin no longer one, one of each set of equals."""
    whole = prefixes.groupBy("conv").agg(F.max("prefix").alias("prefix"), F.first("conv_id").alias("conv_id"))
    # One row for each conversation, however many turns it has.
    inner = (lookup_join(prefixes, whole.select("conv", F.col("prefix.seq").alias("n_turns")), ["conv"], "inner")
             .where(F.col("seq") < F.col("n_turns")).select("prefix").distinct())
    one = whole.groupBy("prefix").agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "conv")).alias("one"))
    return one.join(inner, "prefix", "left_anti").select("one.conv", F.col("prefix.seq").alias("n_turns"))


def rendered(role: Column, text: Column) -> Column:
    """A turn in the form that models are trained on; a null role is "unknown", a null text is empty."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), F.coalesce(text, F.lit("")),
                    F.lit("<|end|>\n"))


def formatted(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``seq``, ``n_turns``, ``rendered``: the turns of maximal conversations, one row each.

    Columns used are ``conv_id``, ``turn``, ``role`` and ``text``. Turns are ordered by ``turn``, null first, and those of
    one number by a digest of role and text; rows equal in all four columns count once. Conversations are compared by
    role and text of their turns, not by turn numbers. A conversation that begins a longer one is left out, and of equal
    ones all but that with the smallest conv_id. Turns without a conv_id are one conversation. A turn stays a row of its
    own, since a conversation may be longer than a row can be: its text is ``rendered`` in the order of ``seq``.
    """
    role, text = F.col("role").cast("string"), F.col("text").cast("string")
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.unhex(F.sha2(content(role, text), 256)).alias("digest"))
    turns = rows.select("conv_id", *KEY).distinct()
    prefixes = turn_hashes(turns)
    kept = prefixes.join(settle(maximal(prefixes)), "conv").select(*KEY, "seq", "n_turns")
    # The texts of turns that are kept; equal rows are dropped after the join, where few are left.
    texts = rows.join(kept, (rows["conv"] == kept["conv"]) & rows["turn"].eqNullSafe(kept["turn"])
                      & (rows["digest"] == kept["digest"]))
    return (texts.select("conv_id", "seq", "n_turns", rendered(F.col("role"), F.col("text")).alias("rendered"))
            .distinct())
