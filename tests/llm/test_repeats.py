import hashlib
import random

from pyspark.sql import functions as F

from quayside.llm import repeats
from quayside.llm.queries import ORACLE_SQL, QUERIES

from . import brute


def rows_of(df):
    return sorted(([r.doc_id, r.text, r.n_words, r.n_removed] for r in df.collect()), key=repr)


def test_random_documents_against_brute_force(spark):
    r = random.Random(3)
    voc = [f"w{i}" for i in range(50)] + ["é", "日本", "x" * 300]
    passages = [[r.choice(voc) for _ in range(r.randint(10, 30))] for _ in range(5)]
    rows = []
    for _ in range(250):
        w = []
        for _ in range(r.randint(0, 6)):
            w += r.choice(passages) if r.random() < 0.4 else [r.choice(voc) for _ in range(r.randint(1, 25))]
        rows.append((r.randint(0, 200), " \n".join(w) + r.choice(["", " ", "\t"])))
    rows += [(None, None), (None, rows[5][1]), (7, ""), rows[3], rows[3], (-5, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_removed", F.lit("clash"))
    want = sorted(([*x] for x in brute.repeats(rows)), key=repr)
    assert sum(x[3] for x in want) > 1000
    for blocks in (6000, 8 << 20):  # many blocks, and one
        for depth in (1, 3):
            assert rows_of(repeats.remove_repeats(docs, block_bytes=blocks, depth=depth)) == want


def test_a_passage_in_all_documents_stays_once(spark):
    hot = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} {hot} end{i}") for i in range(400)]
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=20_000).collect()}
    assert got == {0: 0, **{i: 60 for i in range(1, 400)}}


def test_odd_rows_and_empty_table(spark, odd, no_docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(repeats.remove_repeats(odd)) == sorted(([*x] for x in brute.repeats(rows)), key=repr)
    assert repeats.remove_repeats(no_docs).count() == 0


def test_query_against_brute_force_with_one_text_shuffle(spark, small):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{small}/documents.parquet").collect()]
    df = QUERIES["op8_substring_dedup"](spark, small)
    got = sorted([r.doc_id, r.n_words, r.n_removed, r.kept_sha256] for r in df.collect())
    assert got == sorted([i, n, k, hashlib.sha256(t.encode()).hexdigest()] for i, t, n, k in brute.repeats(docs))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "op8_substring_dedup" in ORACLE_SQL
