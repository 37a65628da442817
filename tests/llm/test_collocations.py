import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import collocations as C
from quayside.llm.queries import ORACLE_SQL, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most=3, least=10, share=50, top=2000):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            counts.update((lang, tuple(w[i:i + m])) for m in range(1, most + 1) for i in range(len(w) - m + 1))
    found = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    gone = {(lang, p[i:j]) for (lang, p), f in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * f >= share * counts[lang, p[i:j]]}
    out = []
    for lang in words:
        scored = []
        for (x, p), a in found.items():
            if x == lang and (x, p) not in gone:
                s, k = min((1_000_000 * a * a // (counts[x, p[:k]] * counts[x, p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), counts[x, p[:k]], counts[x, p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, words[lang], -s)
                for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(r, n):
    voc = [f"w{i}" for i in range(60)] + ["É", "日本", "a-b", " x"]
    set_phrases = [[r.choice(voc) for _ in range(r.randint(2, 4))] for _ in range(12)]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(r.randint(0, 25)):
            w += r.choice(set_phrases) if r.random() < 0.4 else [r.choice(voc)]
            if r.random() < 0.15:
                w[-1] += r.choice([".", ",", "; ", "!\n", "?", ":", "\x0b", "\r\n", "\t"])
        rows.append((r.choice(["en", "de", None, "und"]), r.choice([" ", "  ", " \t"]).join(w).title() if r.random() < 0.3 else " ".join(w)))
    return rows


def test_random_texts_against_brute_force(spark):
    rows = corpus(random.Random(9), 1500)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("rank", F.lit("clash"))
    want = brute(rows)
    assert len(want) > 100
    assert rows_of(C.collocations(docs)) == want
    # many blocks and partitions, so that summaries have to give up counters
    assert rows_of(C.collocations(docs, block_bytes=3000, part_mass=2000)) == want
    assert rows_of(C.collocations(docs, most=4, least=5, share=80, top=7, block_bytes=9000)) == brute(rows, 4, 5, 80, 7)


@pytest.mark.parametrize("least", [3, 10])
def test_summaries_lose_no_frequent_key(least):
    r = np.random.default_rng(least)
    parts = [(np.unique(k, return_counts=True)) for k in np.array_split(np.concatenate(
        [r.permutation(20000), r.zipf(1.4, 20000) % 3000]), 40)]
    summary = C.Summary(sum(int(c.sum()) for _, c in parts) // least + 1)
    exact = Counter()
    for k, c in parts:
        summary.merge([k.astype(np.int64)], [c.astype(np.int64)])
        exact.update(dict(zip(k.tolist(), c.tolist())))
        assert len(summary.keys) <= summary.capacity
    assert 0 < summary.error < least
    found = set(summary.frequent(least).tolist())
    assert {k for k, c in exact.items() if c >= least} <= found < set(exact)


def test_counts_beyond_what_messages_hold_in_a_byte(spark):
    rows = [("en", "new york " * 400)] * 3 + [("en", "new jersey. " * 40), ("en", "york, new")]
    assert rows_of(C.collocations(spark.createDataFrame(rows, "lang string, text string"))) == brute(rows)


def test_odd_rows_and_empty_table(spark, odd, no_docs):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert rows_of(C.collocations(odd, least=2)) == brute(rows, least=2)
    assert C.collocations(no_docs).count() == 0
    assert C.collocations(odd.filter("text is null")).count() == 0


def test_scores_past_64_bits(spark):
    a, l, r = 3_000_000_000_000, 5_000_000_000_000, 7_000_000_000_000
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(C._exact_score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert row.first().s == 1_000_000 * a * a // (l * r)


def test_query_against_brute_force_with_one_text_shuffle(spark, small):
    rows = [(d.lang, d.text) for d in spark.read.parquet(f"{small}/documents.parquet").collect()]
    df = QUERIES["op13_misra_gries"](spark, small)
    assert sorted(tuple(r) for r in df.collect()) == brute(rows) and "op13_misra_gries" in ORACLE_SQL
    found = C.frequent_phrases(spark.read.parquet(f"{small}/documents.parquet"))
    found.collect()  # the plan that ran
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
