"""SimHash near-duplicates by BK-trees.

Every text becomes a 64-bit fingerprint; equal fingerprints are one node from there on. Two fingerprints
within the radius agree on some of a few pieces of their bits, so nodes are dealt to shards by the values
of those pieces. A shard is a BK-tree: a node's children are keyed by their Hamming distance to it, and a
search follows only edges whose key is within the radius of the distance just measured. A shard with very
many nodes is several trees of bounded size, and each goes to all queries of its shard. Trees travel
through the shuffle and not as one broadcast, since all of them together grow with the documents.

A task answers with a spanning forest of the links that it finds, never with all pairs; the components
of the forests are the components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.chosen_path import components
from quayside.llm.common import slices, written

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Parts of the 64 bits. At radius 2, two of four parts agree.
PIECES = 4
#: Nodes of one tree at the most.
TREE = 2048
#: Rows for each group of shards that a task takes at once; queries that walk the trees at once.
GROUP_ROWS = 100_000
QUERIES = 1024
#: Shingles hashed at once.
STRIDE = 1 << 16

_LOWER = bytes(c + 32 if ord("A") <= c <= ord("Z") else c for c in range(256))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bit by bit what over half of the text's shingle hashes have; 0 without words."""
    import xxhash

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - size + 1)
    last = ends[size - 1 :] if len(words) >= size else ends[-1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, STRIDE):
        h = np.array([xxhash.xxh64_intdigest(data[a : b - 1], SEED)
                      for a, b in zip(starts[i : min(n, i + STRIDE)], last[i : i + STRIDE])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, value (the fingerprint's bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                got = np.array([fingerprint(t, size) for t in part.column("text").cast(pa.binary()).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(got.view(np.int64))], names=["id", "value"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "id long, value long")


class Trees:
    """One BK-tree for each shard. ``value``: nodes by shard; ``shard``: ascending numbers from 0 on."""

    def __init__(self, value: np.ndarray, shard: np.ndarray, shards: int):
        self.value = value
        count = np.bincount(shard, minlength=shards)
        self.root = np.where(count > 0, np.cumsum(count) - count, -1)
        # all nodes go down their trees side by side, until each is the child of the node it stands at
        at = self.root[shard]
        waiting = np.flatnonzero(at != np.arange(len(value)))
        edges, children = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(waiting):
            key = at[waiting] * 128 + np.bitwise_count(value[waiting] ^ value[at[waiting]])
            edge, first, back = np.unique(key, return_index=True, return_inverse=True)
            child = waiting[first]
            edges.append(edge)
            children.append(child)
            at[waiting] = child[back]
            waiting = waiting[child[back] != waiting]
        edge, child = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edge)
        self.edge, self.child = edge[order], child[order]

    def within(self, value: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) of one shard at ``radius`` or less, some at a time."""
        for i in range(0, len(value), QUERIES):
            query = np.arange(i, min(len(value), i + QUERIES))
            node = self.root[shard[query]]
            query, node = query[node >= 0], node[node >= 0]
            while len(query):
                d = np.bitwise_count(value[query] ^ self.value[node]).astype(np.int64)
                near = d <= radius
                yield query[near], node[near]
                low = np.searchsorted(self.edge, node * 128 + np.maximum(d - radius, 0))
                span = np.searchsorted(self.edge, node * 128 + d + radius, side="right") - low
                query = np.repeat(query, span)
                node = self.child[np.repeat(low - np.concatenate([[0], np.cumsum(span)[:-1]]), span) + np.arange(span.sum())]


def _join(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give the components on both sides of each link one label, the smallest member."""
    while len(left):
        a, b = label[left], label[right]
        apart = a != b
        left, right = left[apart], right[apart]
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (up := label[label]).tobytes() != label.tobytes():
            label[:] = up


def _forest(table: pa.Table, radius: int) -> pa.Table:
    """key, root: each fingerprint of the group and the first that links connect it to in its shard."""
    value, key, part, a, b = (table.column(c).to_numpy() for c in ("value", "key", "part", "a", "b"))
    order = np.lexsort((value, b, a, key))
    value, key, part, a, b = (x[order] for x in (value, key, part, a, b))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    shard = np.cumsum(new) - 1
    bits = value.view(np.uint64)
    nodes, queries = np.flatnonzero(part == a), np.flatnonzero((part == b) | (a == b))
    trees = Trees(bits[nodes], shard[nodes], int(shard[-1]) + 1)
    label = np.arange(len(value))
    for query, node in trees.within(bits[queries], shard[queries], radius):
        _join(label, queries[query], nodes[node])
    linked = np.flatnonzero(label != np.arange(len(value)))
    return pa.table({"key": pa.array(value[linked]), "root": pa.array(value[label[linked]])})


def _masks(pieces: int, radius: int) -> list[int]:
    """Bits of each choice of pieces that agree when ``radius`` of them may differ, as longs."""
    cut = [64 * i // pieces for i in range(pieces + 1)]
    piece = [((1 << cut[i + 1]) - 1) ^ ((1 << cut[i]) - 1) for i in range(pieces)]
    masks = [sum(c) for c in combinations(piece, pieces - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(values: DataFrame, radius: int = RADIUS, pieces: int = PIECES, tree: int = TREE) -> DataFrame:
    """key, root: edges that connect what links of ``radius`` or fewer bits connect. ``values``: distinct
    fingerprints, as value."""
    if pieces <= radius:
        raise ValueError("more pieces than bits that may differ are needed")
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(_masks(pieces, radius))])
    keyed = values.select("value", F.explode(masks).alias("m")).select(
        "value", F.xxhash64(F.col("m.i"), F.col("value").bitwiseAND(F.col("m.mask"))).alias("key"))
    sizes = written(keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
    shards = F.ceil(F.col("size") / tree).cast("int")
    # written, so that nothing stands between the join and its shuffle: a large shard can be split
    member = written(keyed.join(sizes, "key").select(
        "value", "key", shards.alias("parts"), F.pmod(F.xxhash64("value", "key"), shards).cast("int").alias("part")))
    n = sizes.agg(F.sum(F.col("size") * shards).alias("n")).first()["n"] or 0
    member = member.select("value", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("to")).select(
        "value", "key", "part", F.least("part", "to").alias("a"), F.greatest("part", "to").alias("b"))
    group = F.pmod(F.xxhash64("key", "a", "b"), F.lit(max(1, -(-n // GROUP_ROWS) * 4)))
    return (member.withColumn("group", group).groupBy("group")
            .applyInArrow(lambda table: _forest(table, radius), "key long, root long"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE, pieces: int = PIECES, tree: int = TREE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` (long), fingerprint (16 hexadecimal digits), component_id (long): one row for every row
    of ``docs``; other columns are not read.

    Texts are lower-cased (A to Z) and cut at ASCII white space; shingles are ``size`` words joined by one
    space, repeats included, hashed by XXH64 with seed 42. A text with fewer words is one shingle. A null
    text or one without words has the fingerprint 0 and is linked like any other. Fingerprints with
    ``radius`` or fewer differing bits are linked; component_id is the smallest id in a component.
    Repeated rows and ids are rows each; null ids count for nothing, and a component of such rows only has
    a null component_id. Texts of any length are read whole. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, size, id_col, text_col))
    nodes = written(rows.groupBy("value").agg(F.min("id").alias("least")))
    labels = components(written(links(nodes.select("value"), radius, pieces, tree)))
    labelled = nodes.join(labels.select(F.col("key").alias("value"), "label"), "value", "left").select(
        "value", "least", F.coalesce("label", "value").alias("label"))
    first = written(labelled.groupBy("label").agg(F.min("least").alias("component_id")))
    member = written(labelled.join(first, "label").select("value", "component_id"))
    return rows.join(member, "value").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id")
