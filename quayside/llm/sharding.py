"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to a grid; each cell has an index on the Hilbert curve
through the grid. Rows are range-sorted by that index, so that rows near each other in all dimensions
lie near each other in the order, and the order is cut into runs of equal row counts. A reader that
filters on any of the dimensions then skips most shards and, inside a shard, most row groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import replace_columns, written

#: Bits of each dimension; a grid of d dimensions has 2 ** (d * BITS) cells.
BITS = 6
SHARDS = 16


def hilbert_index(axes: list[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each point of a grid of 2 ** bits steps a side (Skilling's
    transform of axes to the curve's transposed index, for all points at once)."""
    x = [np.asarray(a, np.int64).copy() for a in axes]
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i, xi in enumerate(x):
            on = (xi & step) != 0
            swap = np.where(on, 0, (x[0] ^ xi) & low)
            x[0] ^= np.where(on, low, swap)
            if i:
                x[i] = xi ^ swap
        step >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip, step = np.zeros_like(x[0]), 1 << (bits - 1)
    while step > 1:
        flip ^= np.where((x[-1] & step) != 0, step - 1, 0)
        step >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for xi in x:
            out = (out << 1) | (((xi ^ flip) >> b) & 1)
    return out


def by_label(c: Column, bits: int = BITS) -> Column:
    """Grid step of a label: the same for equal labels, 0 for null."""
    return F.coalesce(F.pmod(F.xxhash64(c), F.lit(1 << bits)), F.lit(0)).cast("int")


def by_magnitude(c: Column, bits: int = BITS, most: float = 40.0) -> Column:
    """Grid step of a count on a scale of logarithms, up to 2 ** most; 0 for null and negatives."""
    step = F.floor(F.log2(F.greatest(c.cast("double"), F.lit(0.0)) + 1) * ((1 << bits) / most))
    return F.coalesce(F.least(step, F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def hilbert_shards(docs: DataFrame, dims: list[Column], shards: int = SHARDS, bits: int = BITS,
                   id_col: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` and curve (long), shard (int, 0 to ``shards`` - 1), slot (long, gapless
    from 0 in each shard). Shards differ by one row at most; the order of the curve, then of the id,
    then of the rest of the row runs through them.

    ``dims``: columns with steps from 0 to 2 ** bits - 1, null meaning 0. Rows with equal or null ids
    are ordered by a hash of the row; rows that are equal in all columns may change places. An empty
    table gives no rows, fewer rows than shards leave later shards empty. An input column with the name
    of a result column (in any case) is replaced by it.

    The rows are shuffled once, by ranges of the order, and written in order to the shared folder;
    only the row counts of the written runs (one for each task of the sort) are summed up in one place.
    """

    @F.pandas_udf("long")
    def curve(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for axes in it:
            yield pd.Series(hilbert_index([a.to_numpy() for a in axes], bits))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[F.coalesce(d, F.lit(0)).cast("int").alias(f"axis{i}") for i, d in enumerate(dims)])
    keyed = rows.select("row", curve(*[f"axis{i}" for i in range(len(dims))]).alias("curve"),
                        F.xxhash64("row").alias("tie"))
    order = [F.col("curve"), F.col(f"row.{id_col}"), F.col("tie")]
    runs = written(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("row", "curve", F.monotonically_increasing_id().alias("at")))
    run = F.shiftright("at", 33)
    sizes = runs.groupBy(run.alias("run")).agg(F.count("*").alias("n"))
    before = Window.orderBy("run")
    starts = sizes.select(
        "run", (F.sum("n").over(before) - F.col("n")).alias("start"),
        F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    # as many rows as the sort had tasks, whatever the size of the table
    placed = runs.withColumn("run", run).join(F.broadcast(starts), "run")
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.select("row", "curve", "total", rank.alias("rank"))
    placed = placed.withColumn("shard", F.expr(f"rank * {shards} div total"))
    placed = placed.withColumn("slot", F.expr(f"rank - (shard * total + {shards - 1}) div {shards}"))
    return replace_columns(placed.withColumn("shard", F.col("shard").cast("int")), "row", ["curve", "shard", "slot"])


def document_dims() -> list[Column]:
    return [by_label(F.col("lang")), by_label(F.col("source")), by_magnitude(F.col("n_chars"))]


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, its files in the order of the slots."""
    order = ["shard", "slot"]
    sharded.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("shard").parquet(path)
