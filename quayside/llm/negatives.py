"""Hard negatives by exact scores from Four-Russians tables.

Components are whole numbers. A candidate is packed once: of each bit plane (two's complement) and each
group of eight dimensions one byte. An anchor has for each group the sums of all 256 subsets of its eight
components; a candidate's byte picks the sum that its plane adds, and planes are added up by shifting.
So a full inner product is planes x groups look-ups and no multiplication. Tables of many anchors lie side
by side: one look-up serves all of them.

Anchors and candidates meet in a grid of bounded cells. A first round finds each anchor's positives, a
second one its negatives inside the bands that the positives' scores set; a cell sends a few rows for
each anchor and band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these shares of the positive's, in percent.
BAND = (50, 95)
#: Anchors of a cell; candidates of a cell, at least and at most (between them by the cluster's cores).
ANCHORS = 4096
CANDIDATES = (2048, 32768)
#: Anchors whose tables lie side by side, and candidates that are scored at once.
SIDE = 64
STRIDE = 2048
#: Squared length that a vector of whole numbers may have: of two such vectors, a hundred times the score still fits a long.
SQUARES = float(1 << 55)


def pack_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """Bytes [row, plane, group] of whole numbers [row, dimension], eight dimensions a group."""
    n, dims = values.shape
    groups = -(-dims // 8)
    full = np.zeros((n, groups * 8), np.int64)
    full[:, :dims] = values
    bits = (full[:, None, :] >> np.arange(planes)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8).reshape(n, planes, groups, 8), axis=3, bitorder="little")[..., 0]


def subset_sums(values: np.ndarray, kind: type) -> np.ndarray:
    """Tables [group, subset, anchor] of anchors [anchor, dimension]."""
    n, dims = values.shape
    groups = -(-dims // 8)
    full = np.zeros((n, groups * 8), kind)
    full[:, :dims] = values
    own = full.reshape(n, groups, 8).transpose(1, 2, 0)
    table = np.zeros((groups, 256, n), kind)
    for i in range(8):
        table[:, 1 << i : 2 << i] = table[:, : 1 << i] + own[:, i : i + 1]
    return table


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products [candidate, anchor]: look-ups, additions and shifts."""
    n, planes, groups = packed.shape
    total = np.zeros((n, table.shape[2]), table.dtype)
    found = np.empty_like(total)
    at = packed.astype(np.intp)
    for p in reversed(range(planes)):
        total <<= 1
        for g in range(groups):
            np.take(table[g], at[:, p, g], axis=0, out=found, mode="clip")
            if p == planes - 1:  # the sign's plane counts negative
                total -= found
            else:
                total += found
    return total


def _whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(256 x) of each component; short vectors are filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    length = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).astype(np.int64)
    out = np.zeros((len(vectors), dims), np.int64)
    out[np.repeat(np.arange(len(length)), length), np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def _bytes(table: pa.Table, column: str, kind: str, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind).reshape(-1, *shape)


def _best(anchor: np.ndarray, score: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """Rows of the ``most`` best of each anchor: by score, then by id; in that order."""
    order = np.lexsort((ident, -score, anchor))
    a = anchor[order]
    first = np.searchsorted(a, a)
    return order[np.arange(len(a)) - first < most]


class _Cell:
    """Anchors and candidates that meet."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table, dims: int, planes: int, kind: type):
        self.anchor_id, self.anchor_label = (anchors.column(c).to_numpy() for c in ("id", "label"))
        self.values = _bytes(anchors, "value", "<i8", (dims,))
        ident, label = (candidates.column(c).to_numpy() for c in ("id", "label"))
        order = np.lexsort((ident, label))
        self.id, self.label = ident[order], label[order]
        self.packed = _bytes(candidates, "planes", "u1", (planes, -(-dims // 8)))[order]
        self.kind = kind

    def blocks(self, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Some anchors, some candidates, and their scores; ``same``: only candidates of the anchors' label."""
        if same:
            shared = np.unique(self.anchor_label)
            sides = [np.flatnonzero(self.anchor_label == x) for x in shared]
            spans = [(np.searchsorted(self.label, x), np.searchsorted(self.label, x, side="right")) for x in shared]
        else:
            sides, spans = [np.arange(len(self.anchor_id))], [(0, len(self.id))]
        for side, (low, high) in zip(sides, spans):
            for i in range(0, len(side), SIDE):
                some = side[i : i + SIDE]
                table = subset_sums(self.values[some], self.kind)
                for j in range(low, high, STRIDE):
                    rows = np.arange(j, min(high, j + STRIDE))
                    yield some, rows, scores(table, self.packed[rows])

    def positives(self, most: int) -> pa.Table:
        found = []
        for some, rows, score in self.blocks(same=True):
            row, col = np.nonzero(self.id[rows][:, None] != self.anchor_id[some][None, :])
            s = score[row, col].astype(np.int64)
            best = _best(col, s, self.id[rows[row]], most)
            found.append((some[col[best]], s[best], self.id[rows[row[best]]]))
        return _merged(found, most)

    def negatives(self, low: np.ndarray, high: np.ndarray, band_of: np.ndarray, most: int) -> pa.Table:
        """Best of each band. Bands [low, high], ascending in ``band_of``, the anchor of each."""
        found = []
        first = np.searchsorted(band_of, np.arange(len(self.anchor_id) + 1))
        least = np.full(len(self.anchor_id), np.iinfo(np.int64).max)
        np.minimum.at(least, band_of, low)
        greatest = np.full(len(self.anchor_id), np.iinfo(np.int64).min)
        np.maximum.at(greatest, band_of, high)
        for some, rows, score in self.blocks(same=False):
            on = (score >= least[some]) & (score <= greatest[some]) & (self.label[rows][:, None] != self.anchor_label[some][None, :])
            row, col = np.nonzero(on & (self.id[rows][:, None] != self.anchor_id[some][None, :]))
            if not len(row):
                continue
            s, ident = score[row, col].astype(np.int64), self.id[rows[row]]
            # each hit once for each band of its anchor
            n = np.diff(first)[some][col]
            hit = np.repeat(np.arange(len(row)), n)
            band = np.repeat(first[some][col] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            inside = (s[hit] >= low[band]) & (s[hit] <= high[band])
            hit, band = hit[inside], band[inside]
            best = _best(band, s[hit], ident[hit], most)
            found.append((band[best], s[hit[best]], ident[hit[best]]))
        return _merged(found, most)


def _merged(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], most: int) -> pa.Table:
    """at, score, other: the best of what several blocks found."""
    none = np.empty(0, np.int64)
    at, s, ident = (np.concatenate(x) for x in zip(*found)) if found else (none, none, none)
    best = _best(at, s, ident, most)
    return pa.table({"at": at[best].astype(np.int64), "score": s[best], "other": ident[best]})


def usable(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """id, label, vector of the rows that take part."""
    # a null, NaN or infinite component makes the sum null, NaN (the largest number) or infinite
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x * float(SCALE * SCALE))
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & (squares < SQUARES))


def hard_negatives(vectors: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   band: tuple[int, int] = BAND, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", candidates: int | None = None, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id (long), rank (int), negative_id, positive_score, negative_score (long).

    Labels are whole numbers. Scores are inner products of floor(256 x); higher ones come first, ties by smaller id. An
    anchor's positives are its best ``positives`` rows of its label; for each, the best ``negatives`` rows of
    other labels whose score lies within ``band`` percent of the positive's, ends included. ``is_anchor``
    (over id and label): which rows are anchors, by default those whose id is divisible by 50.

    Rows with a null id, label, vector or component, a NaN or infinite one, or a length beyond ``SQUARES`` (their
    scores would not fit a long) take no part. Short vectors count as filled up with zeros. Rows with an anchor's own
    id are neither positives nor negatives of it; other repeated rows are rows each, and anchors that are equal in id, label and
    vector are one anchor. No usable row or no anchor gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, label_col, vector_col)
    asked = F.col("id") % 50 == 0 if is_anchor is None else is_anchor
    told = rows.agg(F.count("*").alias("n"), F.count_if(asked).alias("asked"), F.max(F.size("vector")).alias("dims"),
                    F.max(F.array_max("vector")).alias("high"), F.min(F.array_min("vector")).alias("low")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not told["n"] or not told["asked"]:
        return spark.createDataFrame([], schema)
    dims = max(1, told["dims"])
    top = max(int(np.floor(SCALE * x)) if x >= 0 else -int(np.floor(SCALE * x)) for x in (told["high"] or 0.0, told["low"] or 0.0))
    planes = max(1, top).bit_length() + 1
    kind = np.int32 if 2 * max(1, top).bit_length() + dims.bit_length() < 31 else np.int64
    low, high = CANDIDATES
    per_cell = candidates or max(low, min(high, told["n"] // (3 * spark.sparkContext.defaultParallelism)))
    columns, lines = max(1, -(-told["n"] // per_cell)), max(1, -(-told["asked"] // anchors))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, STRIDE):
                part = batch.slice(i, STRIDE)
                packed = pack_planes(_whole(part.column("vector"), dims), planes)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array([x.tobytes() for x in packed], pa.binary())],
                                                 names=["id", "label", "planes"])

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = _whole(batch.column("vector"), dims).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([x.tobytes() for x in value], pa.binary())],
                                             names=["id", "label", "value"])

    packed = written(rows.mapInArrow(pack, "id long, label long, planes binary"))
    anchor = written(rows.filter(asked).mapInArrow(numbers, "id long, label long, value binary").distinct()
                     .withColumn("anchor", F.md5(F.concat(F.col("id").cast("string"), F.lit("/"), F.col("label").cast("string"),
                                                          F.lit("/"), F.hex("value")))))
    # candidates by place, so that equal rows part; every line of anchors meets every column of candidates once
    right = (packed.withColumn("column", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(columns)).cast("int"))
             .withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(lines - 1)))))

    def grid(left: DataFrame) -> DataFrame:
        return (left.withColumn("line", F.pmod(F.xxhash64("anchor"), F.lit(lines)).cast("int"))
                .withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))))

    def meet(left: DataFrame, f, result: str) -> DataFrame:
        return grid(left).groupBy("line", "column").cogroup(right.groupBy("line", "column")).applyInArrow(f, result)

    def find_positives(left: pa.Table, other: pa.Table) -> pa.Table:
        if not left.num_rows or not other.num_rows:
            return empty_positives
        got = _Cell(left, other, dims, planes, kind).positives(positives)
        return pa.table({"anchor": left.column("anchor").combine_chunks().take(got.column("at").combine_chunks()) if got.num_rows else pa.array([], pa.string()),
                         "positive_id": got.column("other"), "positive_score": got.column("score")})

    empty_positives = pa.table({"anchor": pa.array([], pa.string()), "positive_id": pa.array([], pa.int64()), "positive_score": pa.array([], pa.int64())})
    near = meet(anchor, find_positives, "anchor string, positive_id long, positive_score long")
    by = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc("positive_id"))
    chosen = near.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= positives)
    bands = chosen.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("bands"))
    with_bands = written(anchor.join(bands, "anchor"))

    def find_negatives(left: pa.Table, other: pa.Table) -> pa.Table:
        names = {"anchor": pa.string(), "place": pa.int32(), "negative_id": pa.int64(), "negative_score": pa.int64()}
        if not left.num_rows or not other.num_rows:
            return pa.table({k: pa.array([], t) for k, t in names.items()})
        lists = left.column("bands").to_pylist()
        band_of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        positive = np.array([b["positive_score"] for x in lists for b in x], np.int64)
        place = np.array([b["place"] for x in lists for b in x], np.int32)
        least, most = -(-band[0] * positive // 100), band[1] * positive // 100
        got = _Cell(left, other, dims, planes, kind).negatives(least, most, band_of, negatives)
        at = got.column("at").to_numpy()
        anchors_of = np.array(left.column("anchor").to_pylist(), object)
        return pa.table({"anchor": pa.array(anchors_of[band_of[at]], pa.string()), "place": pa.array(place[at]),
                         "negative_id": got.column("other"), "negative_score": got.column("score")})

    hard = meet(with_bands, find_negatives, "anchor string, place int, negative_id long, negative_score long")
    by = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc("negative_id"))
    ranked = hard.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= negatives)
    pairs = with_bands.select("anchor", F.col("id").alias("anchor_id"), F.explode("bands").alias("b")).select(
        "anchor", "anchor_id", "b.place", "b.positive_id", "b.positive_score")
    return ranked.join(pairs, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
