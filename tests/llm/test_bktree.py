import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quayside.llm import bktree
from quayside.llm.queries import QUERIES

from . import brute

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = brute.words((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_of(values, radius=2):
    """Smallest place that links reach from each value, all pairs compared."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def expected(rows, radius=2):
    values = [fingerprint(t) for _, t in rows]
    root = component_of(values, radius)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted([(i, f"{v:016x}", least.get(r)) for (i, _), v, r in zip(rows, values, root)], key=repr)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_random_near_copies_against_brute_force(spark):
    r = random.Random(12)
    voc = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        text = [r.choice(voc) for _ in range(r.choice([1, 2, 3, 40, 300]))]
        rows.append((i, " ".join(text)))
        for k in range(r.randint(0, 4)):  # some words changed: a chain of near copies
            text = [*text]
            text[r.randrange(len(text))] = r.choice(voc)
            rows.append((1000 + i * 10 + k, "\t".join(text).upper()))
    want = expected(rows)
    assert len({c for *_, c in want}) < len({f for _, f, _ in want}) < len(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("FINGERPRINT", F.lit(1))
    for pieces, tree in ((4, 2048), (3, 2), (5, 3)):  # trees of a few nodes: large shards are several trees
        assert rows_of(bktree.near_duplicates(docs, pieces=pieces, tree=tree)) == want
    assert rows_of(bktree.near_duplicates(docs, radius=5, pieces=7)) == expected(rows, 5)


@pytest.mark.parametrize("tree", [5, 64, 2048])
def test_links_of_a_dense_family(spark, tree):
    """All values within a few bits of one another, so that every shard is hot."""
    r = random.Random(5)
    base = r.getrandbits(64)
    values = sorted({base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(700)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {}
    edges = bktree.links(spark.createDataFrame([(v,) for v in signed], "value long"), tree=tree)
    label = {v: v for v in signed}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for e in edges.collect():
        a, b = find(e.key), find(e.root)
        label[max(a, b)] = min(a, b)
    for v, root in zip(signed, component_of(values)):
        got.setdefault(find(v), set()).add(root)
    assert all(len(x) == 1 for x in got.values()) and len(got) == len(set(component_of(values))) > 1


def test_trees_find_what_a_full_comparison_finds():
    r = np.random.default_rng(3)
    value = np.concatenate([r.integers(0, 1 << 12, 300), r.integers(0, 1 << 60, 100)]).astype(np.uint64)
    shard = np.sort(r.integers(0, 5, 400))
    trees = bktree.Trees(value, shard, 5)
    for radius in (0, 2, 6):
        got = {p for q, n in trees.within(value, shard, radius) for p in zip(q.tolist(), n.tolist())}
        d = np.bitwise_count(value[:, None] ^ value[None, :])
        assert got == set(zip(*(x.tolist() for x in np.nonzero((d <= radius) & (shard[:, None] == shard[None, :])))))


def test_odd_rows_and_empty_table(spark, odd, no_docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(bktree.near_duplicates(odd)) == expected(rows)
    assert bktree.near_duplicates(no_docs).count() == 0
    with pytest.raises(ValueError):
        bktree.near_duplicates(odd, radius=4)


def test_query_against_brute_force(spark, small):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{small}/documents.parquet").collect()]
    df = QUERIES["op12_bk_trees"](spark, small)
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    assert rows_of(df) == expected(rows)
