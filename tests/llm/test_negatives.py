import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import negatives
from quayside.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, most=3, every=50):
    """Rows by the contract; scores with Python's whole numbers."""
    ok = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
          if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, y in {(i, tuple(v), y) for i, v, y in ok if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in ok if j != i)
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            near = [(t, j) for t, j, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, p, k, j, -s, -t) for k, (t, j) in enumerate(near[:most], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(r, n, dims, labels, scale=1.0):
    centre = [[r.gauss(0, scale) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        y = r.randrange(labels)
        rows.append((i, [c + r.gauss(0, scale) for c in centre[r.randrange(labels)]], y))
    return rows


@pytest.mark.parametrize("dims,scale", [(64, 0.2), (13, 1.0), (8, 300.0), (1, 1.0), (200, 40.0)])
def test_random_vectors_against_brute_force(spark, dims, scale):
    r = random.Random(dims)
    rows = vectors(r, 400, dims, 4, scale)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, every=10)
    anchors = F.col("id") % 10 == 0
    assert want and rows_of(negatives.hard_negatives(df, anchors)) == want
    assert rows_of(negatives.hard_negatives(df, anchors, candidates=37, anchors=7)) == want  # many small cells


def test_scores_by_tables_are_inner_products():
    r = np.random.default_rng(1)
    a, b = r.integers(-900, 900, (70, 21)), r.integers(-900, 900, (50, 21))
    for kind in (np.int32, np.int64):
        got = negatives.scores(negatives.subset_sums(a, kind), negatives.pack_planes(b, 11))
        assert (got == b @ a.T).all()


def test_odd_rows_ties_and_repeats(spark):
    v = [1.0, -0.5, 0.25]
    rows = [(0, v, 1), (0, v, 1), (0, [0.9, -0.5, 0.25], 1), (50, v, 2), (None, v, 1), (3, None, 1), (4, v, None),
            (5, [1.0, None, 1.0], 1), (6, [1.0, float("nan"), 1.0], 1), (7, [float("inf"), 0.0, 0.0], 2), (8, [], 1), (9, [0.5], 1),
            (-50, [0.6, -0.3, 0.2], 1), (100, [0.0, 0.0, 0.0], 3), (101, [0.0, 0.0, 0.0], 3)]
    rows += [(10 + k // 2, [1.0 - k % 3 / 10, -0.5, 0.25], 1 + k % 2) for k in range(40)]  # equal ids, equal scores
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash"))
    assert rows_of(negatives.hard_negatives(df)) == brute(rows)
    huge = spark.createDataFrame([*rows, (200, [1e300, 0.0, 0.0], 1), (201, [3e38, 0.0, 0.0], 2)], SCHEMA)
    assert rows_of(negatives.hard_negatives(huge)) == brute(rows)  # scores beyond a long: no part
    assert negatives.hard_negatives(df.limit(0)).count() == 0
    assert negatives.hard_negatives(df.filter("vec_id = 3")).count() == 0


def test_one_vector_and_label_with_a_third_of_all_rows(spark):
    r = random.Random(4)
    rows = vectors(r, 300, 16, 3)
    rows = [(i, rows[0][1] if i % 3 else v, 0 if i % 3 else y) for i, v, y in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(negatives.hard_negatives(df, candidates=40)) == brute(rows)


def test_query_against_brute_force(spark, small):
    docs = [(x.vec_id, list(x.embedding), (x.label + 1) % 10 if x.vec_id % 7 == 0 else x.label)
            for x in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    df = QUERIES["op11_four_russians"](spark, small)
    assert df.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                         ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert rows_of(df) == brute(docs) and "op11_four_russians" in ORACLE_SQL
