import random

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import chosen_path as C
from quayside.llm.queries import QUERIES

from . import brute


def rows_of(df):
    return sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in df.collect()), key=repr)


def wanted(rows):
    return sorted(((i, *x) for (i, _), x in zip(rows, brute.similar(rows))), key=repr)


def near_copies(r, base, n, edits):
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        yield " ".join(w)


def test_near_copies_against_brute_force(spark, monkeypatch):
    r = random.Random(11)
    rows, n = [], 0
    for size in (1, 2, 3, 10, 60):
        base = [f"b{r.randrange(10**6)}" for _ in range(r.randint(40, 120))]
        for text in near_copies(r, base, size, 3):
            rows.append((n, text))
            n += 1
    rows += [(n + i, f"license line shared by all of them {i} " + " ".join(f"o{r.randrange(10**6)}" for _ in range(20)))
             for i in range(80)]
    rows += [(1000 + i, "one two three") for i in range(4)] + [(1010, "one two three four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(C.similar_documents(docs)) == wanted(rows)
    # deep paths, blocks of large buckets: the same
    monkeypatch.setattr(C, "BLOCK", 16)
    small = C.leaves
    monkeypatch.setattr(C, "leaves", lambda sets, runs: small(sets, runs, bucket=4, depth=3))
    assert rows_of(C.similar_documents(docs)) == wanted(rows)


def test_odd_rows_and_clashes(spark, odd, no_docs):
    docs = odd.withColumn("Class_Id", F.lit("x")).withColumn("extra", F.lit(1))
    out = C.similar_documents(docs)
    assert out.columns == [*odd.columns, "extra", "class_id", "n_links", "n_text_links", "class_size", "first_of_class"]
    rows = out.collect()
    assert len(rows) == 11
    by = {(r.doc_id, r.text): r for r in rows}
    copies = [r for r in rows if r.doc_id in (1, 6)]
    assert {(r.class_id, r.n_links, r.n_text_links, r.class_size) for r in copies} == {(1, 2, 0, 3)}
    assert [r.doc_id for r in copies if r.first_of_class] == [1]
    for text in ("", " \t\n "):
        assert next(r for r in rows if r.text == text).n_links == 0
    assert by[(2, None)].n_links == 0 and by[(None, None)].class_id is None
    assert [r.class_size for r in rows if r.doc_id == 7] == [1, 1]
    assert C.similar_documents(no_docs).count() == 0


def test_recall_of_the_runs():
    """The runs find a pair at the threshold with the target recall even if all buckets split to the full depth."""
    assert C.run_recall(1.0, 4) == 1.0
    runs = C.runs_for(C.SIMILARITY, C.RECALL)
    assert (1 - C.run_recall(C.SIMILARITY, C.DEPTH)) ** runs <= 1 - C.RECALL
    r = np.random.default_rng(1)
    pairs = 3000
    a = r.integers(0, 1 << 32, (pairs, C.TOKENS)).astype(np.uint32)
    b = np.where(r.random(a.shape) < 0.8, a, r.integers(0, 1 << 32, a.shape).astype(np.uint32))
    met = 0
    for seed in range(6):
        roots = C.mix(np.arange(pairs, dtype=np.uint64) + np.uint64(1000 * seed))
        (ra, pa), (rb, pb) = C._children(roots, a), C._children(roots, b)
        met += len({*zip(ra.tolist(), pa.tolist())} & {*zip(rb.tolist(), pb.tolist())})
    assert 0.9 < met / (6 * pairs) < 1.1  # 1.25 children, 0.8 of them shared


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)] + [(7, 7)]
    edges = [(b, a) for a, b in edges]
    got = {r.key: r.label for r in C.components(spark.createDataFrame(edges, "key long, root long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_query_against_brute_force(spark, small):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert rows_of(QUERIES["op5_jaccard_join"](spark, small)) == wanted(rows)


def test_a_row_repeated_many_times_is_one_set(spark):
    """Its copies count as rows and links, but no group holds its text more than once."""
    words = [f"w{i}" for i in range(40)]
    near = " ".join([*words[:39], "other"])
    rows = [(1, " ".join(words))] * 300 + [(2, near), (3, " ".join(words)), (4, "nothing like it at all , really")] + [(None, None)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = C.similar_documents(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.class_id, r.n_links, r.n_text_links, r.class_size, r.first_of_class) for r in got}
    assert by == {1: (1, 301, 1, 302, True), 2: (1, 301, 1, 302, False), 3: (1, 301, 1, 302, False), 4: (4, 0, 0, 1, True),
                  None: (None, 299, 0, 300, True)}


def test_joins_by_class_can_be_split(spark, small):
    """Under both joins of the result there is a scan on either side, no aggregate: adaptive execution may split them."""
    plan = QUERIES["op5_jaccard_join"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Scan parquet") == 2
