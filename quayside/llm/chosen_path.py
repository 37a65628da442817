"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles. Sets are embedded as MinHash vectors, whose equal
coordinates are shared tokens: two sets share each with a probability equal to their similarity. A run
starts with all sets in one node; a node samples one or two coordinates and splits its sets by the
tokens they hold there, and buckets that are still large sample again along their own path. Small
buckets (and what no depth can split: groups of near copies) are compared by brute force, in blocks.
Runs are repeated until a pair at the threshold is found with the target recall. Pairs are compared
in the first of the buckets that they share, by their signatures first, and those that may be similar by their
whole sets. Equal sets are one set with a count of copies throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import mix, replace_columns, slices, written
from quayside.llm.wordscan import Words, inside, scan, windows

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
#: Tokens of the embedding.
TOKENS = 64
#: Buckets up to this size are compared at once; larger ones are split along the path.
BUCKET = 256
#: Levels of splitting. What is together after them is compared by brute force, in blocks.
DEPTH = 4
#: Sets, and shingles in all, of a block of a large bucket.
BLOCK = 512
BLOCK_SHINGLES = 400_000
#: Chance that a node samples a second coordinate.
SECOND = 0.25

_U = np.uint64
_SEEDS = mix(np.arange(1, TOKENS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def run_recall(similarity: float, depth: int) -> float:
    """Chance that a pair meets in a leaf ``depth`` levels down a run."""
    p = 1.0
    for _ in range(depth):
        x = similarity * p
        p = (1 - SECOND) * x + SECOND * (1 - (1 - x) ** 2)
    return p


def runs_for(similarity: float, recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, were every one of
    its buckets split to the full depth."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - run_recall(similarity, depth))))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, ascending in each, and where each text begins. A
    text with fewer words than a shingle has one, all of its words; one without words has none."""
    count = np.diff(words.first)
    text = np.repeat(np.arange(len(count)), np.maximum(count - size + 1, 0))
    h = windows(words.hash, size)[inside(words.first, size)]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = [windows(words.hash[words.first[i] : words.first[i + 1]], int(count[i]), int(count[i]))[0] for i in short]
        text, h = np.concatenate([text, short]), np.concatenate([h, np.array(extra, _U)])
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    text, h = text[new], h[new]
    return h, np.searchsorted(text, np.arange(len(count) + 1))


def signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash vectors of the sets; a row of zeros for an empty set."""
    out = np.zeros((len(first) - 1, TOKENS), np.uint32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        for i, seed in enumerate(_SEEDS):
            token = ((h ^ (seed >> _U(7))) * seed >> _U(32)).astype(np.uint32)
            out[full, i] = np.minimum.reduceat(token, first[:-1][full])
    return out


def _digests(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """128 bits of each set, whatever the order."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(h) + 1, _U)
        np.cumsum(mix(h ^ _U(salt)), out=total[1:])
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out


def _columns(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    c = batch.column(name)
    return c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type)


def _row_key(ident: Column, text: Column) -> list[Column]:
    """128 bits of a row's id and text; a null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(ident.cast("long"), text).alias("k1"), F.xxhash64(F.lit(1), ident.cast("long"), text).alias("k2")]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"),
                       *_row_key(F.col(id_col), text))


_SKETCH = "id long, k1 long, k2 long, n int, d1 long, d2 long, sig binary"


def sketches(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every row: id, k1 and k2 (128 bits of id and text), n shingles, 128 bits of the set, MinHash vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, first = shingles(scan(part.column("text")), size)
                d1, d2 = _digests(h, first)
                sig = signatures(h, first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("k1"), part.column("k2"), pa.array(np.diff(first), pa.int32()),
                     pa.array(d1), pa.array(d2), pa.array([s.tobytes() for s in sig], pa.binary())],
                    names=["id", "k1", "k2", "n", "d1", "d2", "sig"])

    return _keyed(docs, id_col, text_col).mapInArrow(run, _SKETCH)


def _children(path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and paths of the children that each set goes to from its node."""
    draw = mix(path ^ _U(0xA4093822299F31D0))
    first = (draw % _U(TOKENS)).astype(np.int64)
    other = ((first + 1 + ((draw >> _U(16)) % _U(TOKENS - 1)).astype(np.int64)) % TOKENS)
    second = (draw >> _U(32)).astype(np.float64) < SECOND * 2.0**32
    rows = np.concatenate([np.arange(len(path)), np.flatnonzero(second)])
    at = np.concatenate([first, other[second]])
    token = sig[rows, at].astype(_U)
    return rows, mix(mix(path[rows] ^ (at.astype(_U) << _U(40))) ^ token)


def _split(nodes: DataFrame) -> DataFrame:
    """key, n, bucket of every child; ``nodes``: key, n, path, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, TOKENS)
                rows, path = _children(batch.column("path").to_numpy().view(_U), sig)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(at), batch.column("n").take(at), pa.array(path.view(np.int64))],
                    names=["key", "n", "bucket"])

    return nodes.select("key", "n", "path", "sig").mapInArrow(run, "key long, n int, bucket long")


def leaves(sets: DataFrame, runs: int, bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """key, bucket, size and weight (sets and shingles in it) of every set in every leaf bucket that it
    shares with another set."""
    roots = [int(x) for x in mix(np.arange(1, runs + 1, dtype=_U) * _U(0x452821E638D01377)).view(np.int64)]
    nodes = sets.select("key", "n", F.explode(F.array(*[F.lit(r) for r in roots])).alias("path"), "sig")
    out = None
    for level in range(1, depth + 1):
        rows = written(_split(nodes))
        # written, so that no aggregate stands between the join and its shuffle: a hot bucket can be split
        sizes = written(rows.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
                        .filter("size > 1"))
        shared = written(rows.join(sizes, "bucket"))
        leaf = shared if level == depth else shared.filter(F.col("size") <= bucket)
        out = leaf if out is None else out.unionByName(leaf)
        if level == depth:
            break
        large = shared.filter(F.col("size") > bucket)
        if large.isEmpty():
            break
        nodes = large.select("key", "n", F.col("bucket").alias("path")).join(sets.select("key", "sig"), "key")
    return out


def _candidates(sig_a, n_a, sig_b, n_b, least: float, similarity: float) -> np.ndarray:
    """Which pairs may be similar, by sizes and by signature."""
    agree = np.zeros((len(n_a), len(n_b)), np.uint8)
    for i in range(TOKENS):
        agree += sig_a[:, i][:, None] == sig_b[:, i][None, :]
    small = np.minimum(n_a[:, None], n_b[None, :])
    return (agree >= least * TOKENS) & (small >= similarity * np.maximum(n_a[:, None], n_b[None, :]) - 1e-9)


def _met_before(lists_a: list[np.ndarray], lists_b: list[np.ndarray], bucket: int) -> np.ndarray:
    """Which pairs share a bucket with a smaller number than this one."""
    earlier = [[x[x < bucket] for x in side] for side in (lists_a, lists_b)]
    both = np.intersect1d(np.concatenate(earlier[0]), np.concatenate(earlier[1]))
    if not len(both):
        return np.zeros((len(lists_a), len(lists_b)), bool)
    marks = []
    for side in earlier:
        m = np.zeros((len(side), len(both)), np.float32)
        for i, x in enumerate(side):
            m[i, np.searchsorted(both, x[np.isin(x, both)])] = 1
        marks.append(m)
    return marks[0] @ marks[1].T > 0


class _Group:
    """The sets of one bucket, or of two blocks of a large one."""

    def __init__(self, bucket: int, a: int, b: int, table: pa.Table, least: float, similarity: float):
        key = _columns(table, "key").to_numpy()
        # a set comes once, in whatever order rows arrive
        _, keep = np.unique(key, return_index=True)
        table = table.take(pa.array(keep))
        self.key, self.block = key[keep], _columns(table, "block").to_numpy()
        self.table = table
        self.n = _columns(table, "n").to_numpy().astype(np.int64)
        self.copies = _columns(table, "copies").to_numpy()
        lists = [np.asarray(x, np.int64) for x in _columns(table, "buckets").to_pylist()]
        sig = np.frombuffer(b"".join(_columns(table, "sig").to_pylist()), np.uint32).reshape(-1, TOKENS)
        self.left, self.right = np.flatnonzero(self.block == a), np.flatnonzero(self.block == b)
        if len(self.left) and len(self.right):
            pairs = _candidates(sig[self.left], self.n[self.left], sig[self.right], self.n[self.right], least, similarity)
            if a == b:
                pairs = np.triu(pairs, 1)
            if pairs.any():
                pairs &= ~_met_before([lists[i] for i in self.left], [lists[i] for i in self.right], bucket)
        else:
            pairs = np.zeros((len(self.left), len(self.right)), bool)
        self.pairs = pairs

    def involved(self) -> np.ndarray:
        on = np.zeros(len(self.key), bool)
        on[self.left[self.pairs.any(axis=1)]] = True
        on[self.right[self.pairs.any(axis=0)]] = True
        return np.flatnonzero(on)

    def similar(self, similarity: float) -> np.ndarray:
        """The pairs whose whole sets are similar enough."""
        sets = [np.frombuffer(x, _U) for x in _columns(self.table, "shingles").to_pylist()]
        whole = np.concatenate(sets)
        _, token = np.unique(whole, return_inverse=True)
        first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        side = np.full(len(sets), -1)
        side[self.right] = np.arange(len(self.right))
        owner = np.repeat(side, np.diff(first))
        order = np.argsort(token, kind="stable")
        order = order[owner[order] >= 0]
        posted, holder = token[order], owner[order]
        out = np.zeros_like(self.pairs)
        for i, x in enumerate(self.left):
            if not self.pairs[i].any():
                continue
            t = token[first[x] : first[x + 1]]
            lo, hi = np.searchsorted(posted, t), np.searchsorted(posted, t, side="right")
            span = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(span)[:-1]]), span) + np.arange(span.sum())
            common = np.bincount(holder[at], minlength=len(self.right))
            union = self.n[x] + self.n[self.right] - common
            out[i] = self.pairs[i] & (common >= similarity * union - 1e-9)
        return out


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each member's connected component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _least_agreement(similarity: float) -> float:
    """Agreement that a pair at the threshold misses once in some ten thousand times."""
    return similarity - 3.7 * math.sqrt(similarity * (1 - similarity) / TOKENS)


def similar_links(docs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
                  size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, root, links, copies_linked for sets with similar ones: links to other sets, the documents
    behind them, and the smallest key of the sets linked to it in one bucket. ``sets``: one row of
    :func:`sketches` for each distinct non-empty set, with copies and a key of its own."""
    least = _least_agreement(similarity)
    leaf = written(leaves(sets, runs_for(similarity, recall)))
    lists = leaf.groupBy("key").agg(F.array_sort(F.collect_list("bucket")).alias("buckets"))
    known = written(sets.select("key", "k1", "k2", "n", "copies", "sig").join(lists, "key"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    blocks = F.least(blocks, F.col("size").cast("int"))
    member = leaf.select("key", "bucket", blocks.alias("blocks"),
                         F.pmod(F.xxhash64("key", "bucket"), blocks).cast("int").alias("block"))
    # a set meets every block of its bucket once: (a, b) with a <= b
    member = member.select("key", "bucket", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"))
    member = member.select("key", "bucket", "block", F.least("block", "to").alias("a"), F.greatest("block", "to").alias("b"))
    groups = ["bucket", "a", "b"]

    def shortlist(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket, a, b = (x.as_py() for x in group)
        g = _Group(bucket, a, b, table, least, similarity)
        on = g.involved()
        same = lambda v, kind: pa.array(np.full(len(on), v), kind)
        return pa.table({"key": pa.array(g.key[on]), "bucket": same(bucket, pa.int64()), "a": same(a, pa.int32()),
                         "b": same(b, pa.int32()), "block": pa.array(g.block[on].astype(np.int32))})

    listed = written(member.join(known.drop("k1", "k2"), "key").groupBy(*groups).applyInArrow(
        shortlist, "key long, bucket long, a int, b int, block int"))

    wanted = (listed.groupBy("key").agg(F.collect_list(F.struct("bucket", "a", "b", "block")).alias("to"))
              .join(known, "key"))

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, first = shingles(scan(part.column("text")), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array([h[i:j].tobytes() for i, j in zip(first, first[1:])], pa.binary())],
                    names=["key", "shingles"])

    texts = _keyed(docs, id_col, text_col).join(wanted.select("key", "k1", "k2"), ["k1", "k2"]).select("key", "text")
    # a row that is repeated many times is one set
    whole = texts.mapInArrow(whole_sets, "key long, shingles binary").dropDuplicates(["key"])
    dealt = (whole.join(wanted, "key")
             .select("key", "shingles", "n", "copies", "sig", "buckets", F.explode("to").alias("to"))
             .select("key", "shingles", "n", "copies", "sig", "buckets", "to.*"))

    def verify(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket, a, b = (x.as_py() for x in group)
        g = _Group(bucket, a, b, table, least, similarity)
        sim = g.similar(similarity)
        i, j = np.nonzero(sim)
        left, right = g.left[i], g.right[j]
        n = len(g.key)
        links = np.bincount(left, minlength=n) + np.bincount(right, minlength=n)
        copies = (np.bincount(left, weights=g.copies[right], minlength=n)
                  + np.bincount(right, weights=g.copies[left], minlength=n)).astype(np.int64)
        root = _roots(n, left, right)  # keys ascend, so the first member has the smallest key
        on = np.flatnonzero(links)
        return pa.table({"key": pa.array(g.key[on]), "root": pa.array(g.key[root[on]]),
                         "links": pa.array(links[on].astype(np.int64)), "copies_linked": pa.array(copies[on])})

    return dealt.groupBy(*groups).applyInArrow(verify, "key long, root long, links long, copies_linked long")


def components(edges: DataFrame) -> DataFrame:
    """key, label: the smallest key of each connected component; ``edges``: key, root. Labels spread
    to neighbours and through each other until none changes, in as many rounds as the logarithm of a
    component's width."""
    both = written(edges.select(F.col("key").alias("a"), F.col("root").alias("b")).filter("a != b").distinct())
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("key"), F.least("a", "m").alias("label")))
    while True:
        heard = (both.join(labels, both.b == labels.key).groupBy("a").agg(F.min("label").alias("heard")))
        near = (labels.join(heard, labels.key == heard.a)
                .select("key", "label", F.least("label", "heard").alias("low")))
        jump = near.select(F.col("key").alias("k2"), F.col("low").alias("far"))
        new = written(near.join(jump, near.low == jump.k2)
                      .select("key", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved")))
        labels = new.select("key", "label")
        if new.filter("moved").isEmpty():
            return labels


def similar_documents(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, size: int = SHINGLE,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and, for every row, class_id (the smallest id among all documents that
    similar pairs connect to this one), n_links (other rows with a similar or equal set), n_text_links
    (other sets that are similar), class_size (rows), first_of_class (true for one distinct row of each
    class: the smallest by id, then by hash; repeated rows are equal in it).

    Similar means a Jaccard index of at least ``similarity`` over sets of ``size`` consecutive words.
    Shorter texts have one shingle, all their words. Null texts and texts without words are similar to
    nothing, each distinct row a class of its own. A null id orders last; a class of such rows has a null
    class_id. Repeated ids with different texts are different documents. Empty tables give no rows. An
    input column with the name of a result column (in any case) is replaced by it.
    """
    every = written(sketches(docs, size, id_col, text_col))
    # a text without words is a set of its own: the row's key tells it from others
    same = [F.when(F.col("n") > 0, F.col(d)).otherwise(F.col(k)).alias(d) for d, k in (("d1", "k1"), ("d2", "k2"))]
    rows = every.select("id", "k1", "k2", "n", *same, "sig")
    # sets are numbered, so no two share a key; once written, the numbers stay
    sets = written(rows.groupBy("n", "d1", "d2").agg(
        F.min(F.struct("k1", "k2")).alias("one"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("key"), "n", "d1", "d2", "one.k1", "one.k2", "copies", "sig"))
    links = written(similar_links(docs, sets.filter("n > 0"), similarity, recall, size, id_col, text_col))
    counts = links.groupBy("key").agg(F.sum("links").alias("n_text_links"), F.sum("copies_linked").alias("linked"))
    labels = components(links)
    zero = F.lit(0).cast("long")
    classed = (sets.drop("sig", "k1", "k2").join(counts, "key", "left").join(labels, "key", "left")
               .select("n", "d1", "d2", "copies", F.coalesce("label", "key").alias("label"),
                       F.coalesce("n_text_links", zero).alias("n_text_links"), F.coalesce("linked", zero).alias("linked")))
    member = written(rows.select("id", "k1", "k2", "n", "d1", "d2").join(classed, ["n", "d1", "d2"])
                     .select("id", "k1", "k2", "label", "n_text_links", (F.col("linked") + F.col("copies") - 1).alias("n_links")))
    # heads and results are written: no aggregate stands between a join and its shuffle, so a class or a
    # repeated row with a third of all rows can be split
    head = written(member.groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2")).alias("head"), F.count("*").alias("class_size")))
    first = (F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2"))
    result = written(member.join(head, "label")
                     .groupBy("k1", "k2").agg(  # rows equal in id and text have one result
                         F.first(F.col("head.id")).alias("class_id"), F.first("n_links").alias("n_links"),
                         F.first("n_text_links").alias("n_text_links"), F.first("class_size").alias("class_size"),
                         F.first(first).alias("first_of_class")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    carried = docs.select(row, *_row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    return replace_columns(carried.join(result, ["k1", "k2"]), "row",
                           ["class_id", "n_links", "n_text_links", "class_size", "first_of_class"])
