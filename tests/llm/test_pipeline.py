import corpus_pipeline as P
from pyspark.sql import functions as F

from quayside.llm import pieces, pseudonyms, quality, templates
from quayside.llm.queries import pii_key, piece_model

from . import brute


def test_run_against_stages_by_brute_force(spark, small):
    docs = {d.doc_id: d for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in P.run(spark, small).collect()}
    failed = {i: brute.base(d.text)[5] for i, d in docs.items()}
    h = quality._hashed(F.col("text"))
    grams = {r.doc_id: r.b for r in spark.read.parquet(f"{small}/documents.parquet").select(
        "doc_id", quality._buckets(h, quality._pairs(h, h, 1), quality.BUCKETS).alias("b")).collect()}
    folds = {r.doc_id: r.f for r in spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1 and coalesce(toxic, 0) = 0")
             .select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)).alias("f")).collect()}
    scores, cuts = brute.quality_cuts(grams, {i: d.lang for i, d in docs.items()}, folds, failed,
                                      quality.BUCKETS, quality.THRESHOLD, quality.PRIOR)
    assert set(cuts) == {d.lang for d in docs.values()} and min(cuts.values()) < quality.THRESHOLD
    kept = [i for i, d in docs.items() if not failed[i] and scores[i] >= cuts[d.lang] - 1e-9]
    rows = [(i, docs[i].text) for i in kept]
    kept = [i for (i, _), (first, _, _) in zip(rows, brute.similar(rows)) if i == first]
    flat = lambda t: " ".join(t.lower().split())
    items = [flat(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    kept = [i for i in kept if not any(x in flat(docs[i].text) for x in items)]
    assert sorted(got) == sorted(kept) and kept
    who, library = pseudonyms.Pseudonymiser(pii_key(spark)), pieces.MergeVocabulary(piece_model()).library
    for i in kept:
        text = who.replace(docs[i].text)[0]
        assert (got[i].text, got[i].n_chars, got[i].lang, got[i].source) == (text, len(text), docs[i].lang, docs[i].source)
        assert got[i].ids == library.encode(text) and got[i].n_tokens == len(got[i].ids)


def test_stages_take_odd_and_empty_tables(spark, odd, small):
    for docs in (odd.withColumn("extra", F.lit(1)), odd.limit(0)):
        for k, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, small)
            assert out.columns[:5] == P.DOCUMENT_COLUMNS and (k == 4 or len(out.columns) == 5), name
            assert out.count() <= 11
    one = P.near_duplicates(spark, odd, small).collect()
    assert sorted(str(r.doc_id) for r in one) == ["1", "2", "3", "4", "5", "7", "7", "None", "None"]


def test_toxic_or_clean_text_is_not_lost_between_stages(spark):
    """Clean documents pass every filter: trusted ones of the labels stay but for copies and benchmark items."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 AND toxic = 0").select("doc_id")
    kept = P.quality_rules(spark, docs, sf).join(good, "doc_id").count()
    able = quality.score_quality(docs, quality.trusted_ids(spark.read.parquet(f"{sf}/labels.parquet"))).filter(
        "not base_failed").join(good, "doc_id").count()
    assert kept >= 0.98 * able
    clean = templates.decontaminate(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).filter("not contaminated").count()
    assert clean > 900
