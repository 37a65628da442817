"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.session import new_scratch_path

#: White space that parts words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none. A one-character separator needs no
    regular expression."""
    blank = F.coalesce(text, F.lit(""))
    for c in WHITE[1:]:
        blank = F.replace(blank, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(blank, " "), "")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c))
    return (F.length(text) - F.length(rest)).cast("long")


def replace_columns(df: DataFrame, row: str, results: list[str]) -> DataFrame:
    """The fields of struct column ``row`` and the columns ``results``; where names clash (in any
    case), the result column takes the place of the input column."""
    taken = {r.lower() for r in results}
    kept = [c for c in df.schema[row].dataType.names if c.lower() not in taken]
    return df.select(*[F.col(row)[c].alias(c) for c in kept], *results)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share."""
    return new_scratch_path(spark, "llm")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut and the planner knows
    the size."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of the batch with about ``most`` bytes in a string column; a longer text goes
    alone. What a worker makes of a slice stays small whatever the size of a batch."""
    done = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(done[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(done, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def with_columns_of(df: DataFrame, column: str, fields: str, f: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` and further columns, named and typed by ``fields`` (a DDL string), that ``f`` makes of each
    slice of rows."""
    more = StructType.fromDDL(fields)
    names = [*df.columns, *more.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield pa.RecordBatch.from_arrays([*part.columns, *f(part)], names=names)

    return df.mapInArrow(run, StructType([*df.schema.fields, *more.fields]))
