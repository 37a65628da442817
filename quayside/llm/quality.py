"""Quality rules: how much likelier a text's hashed n-grams are under trusted documents than under
the whole corpus.

Every word and every pair of neighbouring words falls into one of ``buckets`` counters. Two
multinomials are counted, one over all documents and one over a bounded set of trusted documents;
a document's score is the mean over its n-grams of log(p_trusted / p_corpus). A document is kept if
its base rules hold and its score reaches its language's cut: ``threshold``, or less where trusted
documents, scored without their own counts, reach less. A language without trusted documents has the cut
that trusted documents of other languages show when scored without their whole language. Only built-in
functions run.
"""

from __future__ import annotations

from statistics import mean, stdev

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WHITE, count_chars, replace_columns, words, written

#: Counters of the hashed multinomials. It bounds the model: one number each.
BUCKETS = 10_000
#: At most so many trusted documents, those with the smallest hash of their id, give the target counts.
TRUSTED_LIMIT = 20_000
#: Mean log-likelihood ratio below which a document is rejected, unless clean documents score as low.
THRESHOLD = -0.05
#: Added to each count of the corpus.
SMOOTHING = 1.0
#: N-grams' worth of the corpus multinomial that the trusted one starts from: what few trusted documents
#: have not shown yet counts neither for nor against a text.
PRIOR = 100_000.0
#: Parts of the trusted documents, by hashed id; each is scored by the counts of the others.
FOLDS = 5
#: The cut is at most this quantile of a language's held-out scores, and so many deviations below their mean.
LOW, DEVIATIONS = 0.01, 3.0
#: Languages, those with the most trusted documents, that are scored without all documents of their own.
LANGUAGES = 8
SYMBOLS = "#*$%&|<>"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _pairs(left: Column, right: Column, skip: int) -> Column:
    """A hash of left[i] and right[i + skip] for every i that has both."""
    n = F.size(right) - skip
    return F.when(n > 0, F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(skip + 1), n),
                                    lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column, size: int) -> Column:
    """Words inside the windows (hashes, in order, each of ``size`` words) that occur twice or more."""
    ordered = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:  # equal windows are neighbours in s
        return F.array_sort(F.transform(F.filter(s, lambda x, k: (
            F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"]))), lambda x: x["i"]))

    return _with(ordered, lambda s: F.aggregate(
        places(s), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"]))


def _with(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once for a row."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _numbers(values: list[float]) -> Column:
    """The numbers as one literal; an expression for each would keep the planner busy."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _hashed(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _buckets(word_hash: Column, pair_hash: Column, buckets: int) -> Column:
    """Counter of each word and of each pair of neighbouring words."""
    return F.transform(F.concat(word_hash, pair_hash), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_LIMIT) -> DataFrame:
    """Ids of documents labelled good and not toxic, at most ``limit`` of them: those whose hashed id
    is smallest, so that the choice has nothing to do with their order or text."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    return (good.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(FOLDS)).cast("int")


def _language(row: str, df: DataFrame) -> Column:
    """The language of struct column ``row`` ("" for the frame's own columns); empty where there is none."""
    names = df.schema[row].dataType.names if row else df.columns
    if "lang" not in names:
        return F.lit("")
    return F.coalesce(F.col(f"{row}.lang" if row else "lang").cast("string"), F.lit(""))


def trusted_rows(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``trusted``, which must be bounded, as :func:`trusted_ids` makes
    it: it is broadcast. It has no more than the id column."""
    own = docs.join(F.broadcast(trusted.select(F.col("doc_id").alias("__trusted"))), F.col("doc_id") == F.col("__trusted"))
    return own.select(*[F.col(f"`{c}`") for c in docs.columns])


def shown_languages(own: DataFrame) -> list[str]:
    """At most ``LANGUAGES`` languages of the trusted rows, those with the most rows first."""
    n = own.groupBy(_language("", own).alias("lang")).count().filter("lang <> ''")
    return [r["lang"] for r in n.orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]


def fit_ratios(docs: DataFrame, own: DataFrame, languages: list[str], buckets: int = BUCKETS) -> DataFrame:
    """One row: array ``ratios``, log(p_trusted / p_corpus) of each counter, and arrays of arrays: ``held_out``,
    the same without the trusted documents of each fold, and ``unseen``, without those of each language.
    ``lowest``: the ratio, without each language, of a counter that no trusted document has; last that of
    ``ratios``. All rows of ``docs`` count in the corpus; ``own`` are its trusted rows
    (:func:`trusted_rows`). Without a trusted row every ratio is 0."""

    def grams(rows: DataFrame, *more: Column) -> DataFrame:
        hashed = rows.select(*more, _hashed(F.col("text")).alias("h"))
        return hashed.select(*[c for c in hashed.columns if c != "h"],
                             F.explode(_buckets(F.col("h"), _pairs(F.col("h"), F.col("h"), 1), buckets)).alias("b"))

    parts = [F.col("f") == f for f in range(FOLDS)] + [F.col("lang") == x for x in languages]
    corpus_counts = grams(docs).groupBy("b").agg(F.count("*").alias("n"))
    trusted_counts = (grams(own, _fold(F.col("doc_id")).alias("f"), _language("", own).alias("lang")).groupBy("b")
                      .agg(F.count("*").alias("k"), F.array(*[F.count_if(x) for x in parts]).alias("own")))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    none = F.array(*[F.lit(0).cast("long")] * len(parts))
    one = (every.join(corpus_counts, "b", "left").join(trusted_counts, "b", "left")
           .select("b", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"),
                   F.coalesce("own", none).alias("own"))
           .agg(F.sum("n").alias("n_all"), F.sum("k").alias("k_all"),
                F.array(*[F.sum(F.get("own", F.lit(f))) for f in range(len(parts))]).alias("own_all"),
                F.array_sort(F.collect_list(F.struct("b", "n", "k", "own"))).alias("c")))

    def seen(part: int | None) -> Column:
        return F.col("k_all") if part is None else F.col("k_all") - F.get("own_all", F.lit(part))

    def ratios(part: int | None) -> Column:
        def ratio(c: Column) -> Column:
            k = c["k"] if part is None else c["k"] - F.get(c["own"], F.lit(part))
            corpus = (c["n"] + SMOOTHING) / (F.col("n_all") + SMOOTHING * buckets)
            trusted_ = (k + PRIOR * corpus) / (seen(part) + PRIOR)
            return F.log(trusted_) - F.log(corpus)

        return F.transform("c", ratio)

    whole = range(FOLDS, len(parts))
    return one.select(
        ratios(None).alias("ratios"), F.array(*[ratios(f) for f in range(FOLDS)]).alias("held_out"),
        F.array(*[ratios(x) for x in whole]).cast("array<array<double>>").alias("unseen"),
        F.array(*[F.log(F.lit(PRIOR) / (seen(x) + PRIOR)) for x in [*whole, None]]).alias("lowest"))


def held_out_scores(own: DataFrame, languages: list[str], held_out: list[list[float]],
                    unseen: list[list[float]]) -> DataFrame:
    """The trusted rows that pass the base rules and have a score: all columns of ``own`` in the struct
    ``row``, ``score`` without their own fold's counts, and ``unseen`` without those of their language
    (null where it is none of ``languages``)."""
    buckets = len(held_out[0])
    place = F.array_position(F.array(*[F.lit(x) for x in languages]).cast("array<string>"), F.col("row_lang"))
    firsts = {"score": _fold(F.col("row.doc_id")) * buckets,
              "unseen": F.when(place > 0, (place.cast("int") + FOLDS - 1) * buckets)}
    return _measured(own, _numbers(sum(held_out + unseen, [])), buckets, firsts).filter(
        ~F.col("base_failed") & F.col("score").isNotNull())


def _limits(scores: DataFrame, lang: Column, score: Column, quantile: float, side: int) -> dict[str, float]:
    """For each language how far clean documents' scores go: the quantile, or where more ``DEVIATIONS``
    from the mean, upwards (``side`` 1) or downwards (-1). Where a language has few scores, the spread is that of all."""
    # at most as many languages as trusted documents
    seen = scores.filter(score.isNotNull()).groupBy(lang.alias("lang")).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean"), F.coalesce(F.var_samp(score), F.lit(0.0)).alias("var"),
        F.percentile(score, quantile).alias("end")).collect()
    free = max(1, sum(r["n"] - 1 for r in seen))
    spread = sum((r["n"] - 1) * r["var"] for r in seen) / free
    far = {r["lang"]: r["mean"] + side * DEVIATIONS * (max(spread, r["var"]) * (1 + 1 / r["n"])) ** 0.5 for r in seen}
    return {r["lang"]: side * max(side * r["end"], side * far[r["lang"]]) for r in seen}


def _cut(held_out: DataFrame, languages: list[str], lowest: list[float], threshold: float) -> Column:
    """The score from which a row is kept, by its language (column ``lang``, if there is one).

    A language without a trusted document has a cut from the others: each trusted document, scored without
    its whole language, reaches some share of the lowest score there is, and languages differ in how far their
    clean documents go. The cut is the share that a further language is expected not to pass (``DEVIATIONS``
    from the mean of the languages, and no less than any of them), of the lowest score. One language shows
    no difference, and the cut is the lowest score. A row without language takes the lowest cut of all."""
    lang = _language("row", held_out)
    cuts = {x: round(min(threshold, end), 9) for x, end in _limits(held_out, lang, F.col("score"), LOW, -1).items()}
    least = F.try_element_at(F.create_map(*[F.lit(x) for pair in zip(languages, lowest) for x in pair]), lang) \
        if languages else F.lit(None).cast("double")
    share = F.when(least < 0, F.col("unseen") / least)
    shares = list(_limits(held_out, lang, share, 1 - LOW, 1).values())
    further = 1.0
    if len(shares) > 1:
        further = mean(shares) + DEVIATIONS * stdev(shares) * (1 + 1 / len(shares)) ** 0.5
    # a score may be below the lowest by the rounding of its sum
    other = min(threshold, round(lowest[-1] * min(1.0, max([further, *shares])), 9) - 1e-6)
    if not cuts:
        return F.lit(other)
    known = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
    return (F.when(lang == "", F.lit(min(other, *cuts.values())))
            .otherwise(F.coalesce(F.try_element_at(known, lang), F.lit(other))))


def score_quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD,
                  buckets: int = BUCKETS) -> DataFrame:
    """All columns of ``docs`` (``doc_id``, ``text`` and any others) and, for every row, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, score (double), kept.

    A null text counts as an empty one: no words, base_failed true, score null. Texts of any length
    are read whole. Repeated rows and repeated or null ids are judged row by row; they all count in
    the corpus counts. Empty tables give no rows. ``threshold`` is the highest cut: see :func:`_cut`. An input column with the name of a result column
    (in any case) is replaced by it. Equal inputs give equal scores on every run: the counts are whole
    numbers, and a document's ratios are added in the order of its text.
    """
    own = written(trusted_rows(docs, trusted))
    languages = shown_languages(own)
    fitted = fit_ratios(docs, own, languages, buckets).first()
    scored = _measured(docs, _numbers(fitted["ratios"]), buckets, {"score": F.lit(0)})
    held_out = written(held_out_scores(own, languages, fitted["held_out"], fitted["unseen"]))
    cut = _cut(held_out, languages, fitted["lowest"], threshold)
    scored = scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= cut))
    return replace_columns(scored, "row", [*BASE, "base_failed", "score", "kept"])


def _measured(docs: DataFrame, model: Column, buckets: int, firsts: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` as the struct ``row``, what the base rules count, base_failed and a score for each
    of ``firsts``: where a row's ratios begin in ``model`` (over ``row`` and ``row_lang``; null: no score)."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    # Each array is used more than once after the select that makes it, so it is made once.
    stage = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    stage = stage.select("row", _language("row", stage).alias("row_lang"), lines.alias("lines"), _hashed(text).alias("h"))
    stage = stage.withColumn("pairs", _pairs(F.col("h"), F.col("h"), 1))
    fours = _pairs(F.col("pairs"), F.col("pairs"), 2)
    stage = stage.withColumn("windows", _pairs(fours, F.col("h"), 4))
    unique = F.size(F.array_distinct("windows")) == F.size("windows")

    def mean_ratio(first: Column) -> Column:
        return F.when(F.size("h") > 0, F.aggregate(
            _buckets(F.col("h"), F.col("pairs"), buckets), F.lit(0.0),
            lambda a, x: a + F.get(model, first + x)) / (F.size("h") + F.size("pairs")))

    scored = stage.select("row", F.struct(
        F.size("h").cast("long").alias("n_words"),
        (F.length(text) - count_chars(text, WHITE)).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(unique, F.lit(0).cast("long")).otherwise(_covered(F.col("windows"), 5)).alias("n_repeat_words"),
        *[mean_ratio(first).alias(name) for name, first in firsts.items()],
        # not deterministic, so no filter on a result moves below this select, where it would make
        # every array anew for each place that it is used in
        F.spark_partition_id().alias("here")).alias("r"))
    scored = scored.select("row", *[F.col(f"r.{c}") for c in (*BASE, *firsts)])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.withColumn("base_failed", failed)
