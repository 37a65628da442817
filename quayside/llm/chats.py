"""Collapse of cumulative chat snapshots.

Loggers often store a conversation again after every turn. Each turn gets a rolling hash of all turns
up to it; a conversation whose last hash is an inner hash of another one is a prefix of that one. An
anti-join retains the maximal conversations, which are then rendered. Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order() -> list[Column]:
    return [F.asc_nulls_first(c) for c in ("turn", "role", "text")]


def _content(salt: int) -> Column:
    """A hash of a turn at its place; a null differs from an empty string."""
    return F.xxhash64(F.lit(salt), F.col("place"), F.col("role").isNull(), F.coalesce("role", F.lit("")),
                      F.col("text").isNull(), F.coalesce("text", F.lit("")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ...), n_turns, h1, h2: a 128-bit hash of the turns up to each place. As
    every turn's hash holds its place, the running XOR depends on the order."""
    by_conv = Window.partitionBy("conv_id").orderBy(*_order())
    placed = turns.select("conv_id", F.row_number().over(by_conv).alias("place"), "role", "text")
    hashed = placed.select("conv_id", "place", _content(1).alias("a"), _content(2).alias("b"))
    upto = Window.partitionBy("conv_id").orderBy("place")
    running = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hashed.select("conv_id", "place", F.max("place").over(Window.partitionBy("conv_id")).alias("n_turns"),
                         F.bit_xor("a").over(running).alias("h1"), F.bit_xor("b").over(running).alias("h2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of every conversation that is no proper prefix of another one. Of
    equal conversations the one with the smallest id stays; n_copies counts them all. Copies and shared
    first turns are merged by partial aggregation before either side of the join moves."""
    hashes = prefix_hashes(turns)
    whole = (hashes.filter(F.col("place") == F.col("n_turns"))
             .groupBy("h1", "h2", F.col("n_turns").alias("place"))
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    inner = hashes.filter(F.col("place") < F.col("n_turns")).select("h1", "h2", "place").distinct()
    return whole.join(inner, ["h1", "h2", "place"], "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "n_copies")


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns (long), n_copies (long), rendered (string) of every maximal conversation.

    ``turns``: conv_id, turn, role, text and any others, which are not read. Turns are ordered by turn,
    then role, then text, nulls first; ties and repeated rows are turns of their own. Rows without a
    conv_id form one conversation, whose id is null; among equal conversations an id comes before none. A
    null role renders as an empty one, a null text likewise. Empty tables give no rows.
    """
    kept = maximal_conversations(turns).withColumnRenamed("conv_id", "kept_id")
    piece = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")),
                     F.lit("<|end|>\n"))
    rows = turns.select("conv_id", "turn", "role", "text").join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    said = rows.groupBy("kept_id", "n_turns", "n_copies").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", piece.alias("piece"))), _by_turn).alias("said"))
    return said.select(F.col("kept_id").alias("conv_id"), F.col("n_turns").cast("long").alias("n_turns"),
                       "n_copies", F.array_join(F.transform("said", lambda s: s["piece"]), "").alias("rendered"))


def _by_turn(a: Column, b: Column) -> Column:
    """The order of :func:`_order` as a comparison."""
    out = F.lit(0)
    for c in ("text", "role", "turn"):
        out = (F.when(a[c].eqNullSafe(b[c]), out).when(a[c].isNull(), -1).when(b[c].isNull(), 1)
               .when(a[c] < b[c], -1).otherwise(1))
    return out
