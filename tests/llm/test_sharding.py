import zlib

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import sharding
from quayside.llm.queries import QUERIES


def test_the_curve_visits_each_cell_once_by_steps_of_one():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.indices((1 << bits,) * dims).reshape(dims, -1)
        at = sharding.hilbert_index(list(cells), bits)
        assert sorted(at) == list(range(len(at)))
        path = cells[:, np.argsort(at)]
        assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def _check(rows, n, shards=16):
    sizes = [0] * shards
    for r in rows:
        sizes[r.shard] += 1
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
    for s in range(shards):
        slots = sorted((r.slot, r.curve) for r in rows if r.shard == s)
        assert [x for x, _ in slots] == list(range(len(slots)))
        assert [c for _, c in slots] == sorted(c for _, c in slots)
    ends = [(min(r.curve for r in rows if r.shard == s), max(r.curve for r in rows if r.shard == s))
            for s in range(shards) if any(r.shard == s for r in rows)]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_query_against_brute_force(spark, small):
    rows = QUERIES["op2_hilbert_shards"](spark, small).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    _check(rows, len(docs))
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_shards_prune_files(spark, small, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sharded = sharding.hilbert_shards(docs, sharding.document_dims())
    out = str(tmp_path / "shards")
    sharding.write_shards(sharded, out)
    back = spark.read.parquet(out)
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 16
    ranges = back.groupBy("shard").agg(F.min("n_chars").alias("a"), F.max("n_chars").alias("b"),
                                       F.countDistinct("source").alias("k")).collect()
    assert sum(r.k for r in ranges) < 16 * 20 * 0.8  # a filter on the source skips shards
    assert sum(r.a <= 50 <= r.b for r in ranges) < 16  # so does one on the length


def test_odd_rows_ties_and_clashes(spark, odd, no_docs):
    clash = odd.withColumn("Shard", F.lit("x")).withColumn("curve", F.lit("y")).withColumn("extra", F.lit(1))
    out = sharding.hilbert_shards(clash, sharding.document_dims())
    assert out.columns == [*odd.columns, "extra", "curve", "shard", "slot"]
    rows = out.collect()
    _check(rows, 11)
    assert sharding.hilbert_shards(no_docs, sharding.document_dims()).count() == 0
    same = spark.createDataFrame([(1, "x", "en", "a", 1)] * 100, odd.schema)
    _check(sharding.hilbert_shards(same, sharding.document_dims()).collect(), 100)
