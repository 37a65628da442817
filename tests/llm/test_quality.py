import math
import random

import pytest
from pyspark.sql import functions as F

from quayside.llm import quality
from quayside.llm.queries import QUERIES

from . import brute


def test_base_columns_against_brute_force(spark, small):
    got = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (*(r[c] for c in quality.BASE), r.base_failed) == brute.base(d.text)
        assert not (r.base_failed and r.kept)


def test_base_columns_of_odd_documents(spark, odd):
    rows = quality.score_quality(odd.withColumn("Kept", F.lit("clash")).withColumn("extra", F.lit(1)),
                                 spark.createDataFrame([], "doc_id long"))
    assert "Kept" not in rows.columns and rows.columns[:5] == odd.columns and "extra" in rows.columns
    rows = rows.collect()
    assert len(rows) == 11
    for r in rows:
        assert (*(r[c] for c in quality.BASE), r.base_failed) == brute.base(r.text)
        assert r.score == (pytest.approx(0.0, abs=1e-9) if r.n_words else None)  # nothing trusted: every ratio is 0
        assert bool(r.kept) == (not r.base_failed)


def test_scores_against_brute_force(spark, monkeypatch):
    """Junk scores far below what trusted documents look like; the score is the mean of the n-grams' ratios."""
    monkeypatch.setattr(quality, "PRIOR", 50.0)
    good = [(i, " ".join(f"w{(i * 7 + k * k) % 40}" for k in range(60))) for i in range(40)]
    junk = [(100 + i, " ".join(f"#x{(i + k) % 50}%" for k in range(60))) for i in range(10)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)] + [(100, 0, 0), (1, 1, 1), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    trusted = quality.trusted_ids(labels)
    assert sorted(r.doc_id for r in trusted.collect()) == list(range(0, 40, 2))
    got = {r.doc_id: r.score for r in quality.score_quality(docs, trusted).collect()}
    grams = {}
    hashed = docs.select("doc_id", quality._hashed(F.col("text")).alias("h"))
    hashed = hashed.select("doc_id", quality._buckets(F.col("h"), quality._pairs(F.col("h"), F.col("h"), 1), quality.BUCKETS).alias("b"))
    for r in hashed.collect():
        grams[r.doc_id] = r.b
    n, k = {}, {}
    for i, bs in grams.items():
        for b in bs:
            n[b] = n.get(b, 0) + 1
            k[b] = k.get(b, 0) + (i in range(0, 40, 2))
    total_n, total_k = sum(n.values()) + quality.BUCKETS, sum(k.values())
    corpus = {b: (n[b] + 1) / total_n for b in n}
    for i, bs in grams.items():
        want = sum(math.log((k[b] + 50 * corpus[b]) / (total_k + 50) / corpus[b]) for b in bs) / len(bs)
        assert got[i] == pytest.approx(want, abs=1e-9)
    assert max(got[i] for i, _ in junk) < min(min(got[i] for i, _ in good), quality.THRESHOLD)


def test_good_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = QUERIES["op1_quality_rules"](spark, sf).join(labels, "doc_id").filter("not base_failed")
    by = {r.quality: r.share for r in seen.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert by[1] > 0.97 and by[0] < 0.1


def test_empty_tables_and_native_plan(spark, no_docs, small):
    trusted = spark.createDataFrame([], "doc_id long")
    assert quality.score_quality(no_docs, trusted).count() == 0
    assert quality.trusted_ids(spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    plan = QUERIES["op1_quality_rules"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_a_filter_on_a_result_stays_above_the_arrays(spark, small):
    """Pushed below, it would make every array again for each place that its condition uses it in."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = quality.score_quality(docs, quality.trusted_ids(spark.read.parquet(f"{small}/labels.parquet"))).filter("kept")
    plan = kept._jdf.queryExecution().optimizedPlan().toString().split("\n")
    filters = [line for line in plan if "Filter" in line and "Relation" not in line]
    assert len(filters) == 1 and "transform" not in filters[0]


@pytest.mark.parametrize("size,folds", [("sf0.001", 5), ("sf0.01", 2), ("sf0.1", 1)])
def test_clean_documents_outside_the_trusted_set_stay(spark, size, folds):
    sf = f"/root/testdata/{size}"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    clean = labels.filter("quality = 1 and coalesce(toxic, 0) = 0")
    kept = n = 0
    for f in range(folds):
        out = F.crc32(F.col("doc_id").cast("string")) % 5 == f
        got = quality.score_quality(docs, quality.trusted_ids(clean.filter(~out))).filter("not base_failed")
        r = got.join(clean.filter(out), "doc_id", "left_semi").agg(F.count_if("kept").alias("k"), F.count("*").alias("n")).first()
        kept, n = kept + r.k, n + r.n
    assert n >= 50 and kept >= 0.98 * n


@pytest.mark.parametrize("out", ["de", "fr", "es", "en"])
def test_a_language_without_trusted_documents_has_a_cut_from_the_others(spark, out):
    """Against brute force, row by row; its clean documents stay."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    clean = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    trusted = quality.trusted_ids(labels.join(docs.filter(F.col("lang") != out).select("doc_id"), "doc_id", "left_semi"))
    got = {r.doc_id: r for r in quality.score_quality(docs, trusted).collect()}
    h = quality._hashed(F.col("text"))
    grams = {r.doc_id: r.b for r in docs.select(
        "doc_id", quality._buckets(h, quality._pairs(h, h, 1), quality.BUCKETS).alias("b")).collect()}
    cut = brute.cut_of_other_languages(grams, {i: r.lang for i, r in got.items()}, {r.doc_id for r in trusted.collect()},
                                       {i: r.base_failed for i, r in got.items()}, quality.BUCKETS, quality.THRESHOLD, quality.PRIOR)
    able = [r for r in got.values() if r.lang == out and not r.base_failed]
    assert able and all(r.kept == (r.score >= cut) for r in able if abs(r.score - cut) > 1e-7)
    good = {r.doc_id for r in clean.collect()}
    stay = [r.kept for r in able if r.doc_id in good]
    assert sum(stay) >= 0.98 * len(stay)


def test_junk_of_a_language_without_trusted_documents_goes(spark):
    """Words that no trusted document of any language has; what languages share keeps clean documents."""
    def text(lang, i):
        draw = random.Random(f"{lang}{i}")
        return " ".join(f"name{draw.randrange(10)}" if k % 2 else f"{lang}{draw.randrange(10)}" for k in range(60))

    docs = [(n * 200 + i, text(lang, i), lang) for n, lang in enumerate(["a", "b", "c"]) for i in range(150)]
    junk = [(1000 + i, " ".join(f"q{i}x{k}" for k in range(60)), "c") for i in range(10)]
    rows = spark.createDataFrame(docs + junk, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(d[0],) for d in docs if d[2] != "c"], "doc_id long")
    kept = {r.doc_id for r in quality.score_quality(rows, trusted).filter("kept").collect()}
    able = {d[0] for d in docs if not brute.base(d[1])[5]}
    assert kept == able and len(able) > 400
    none = quality.score_quality(rows.drop("lang"), trusted).filter("kept").count()
    assert none >= len(able)  # without languages there is one for all


def test_one_trusted_language_alone_says_nothing_of_others(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    english = docs.filter("lang = 'en'").select("doc_id")
    got = quality.score_quality(docs, quality.trusted_ids(labels.join(english, "doc_id", "left_semi")))
    assert got.filter("lang <> 'en' and not base_failed and not kept").count() == 0
    assert got.filter("lang = 'en' and not base_failed and not kept").count() > 0
