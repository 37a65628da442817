"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (bktree, chats, chosen_path, collocations, negatives, pieces, pseudonyms, quality, repeats,
                          secret_scan, sharding, templates, wrappers)
from quayside.llm.common import shared_dir, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.score_quality(table(spark, sf_dir, "documents"), trusted).select(
        "doc_id", *quality.BASE, "base_failed", "kept", "score")


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    return sharding.hilbert_shards(docs, sharding.document_dims()).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def pii_key(spark: SparkSession) -> str:
    """The key of the pseudonyms: from the session's settings; without one, that of the tests."""
    return spark.conf.get("spark.quayside.pii.key", "for tests only")


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, pii_key(spark))


def op4_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.collapse_snapshots(table(spark, sf_dir, "conversations"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "class_id", "n_links", "n_text_links", "class_size")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries into one ledger: about half of the rows, then the whole table, of which only blobs
    that the ledger does not hold by then are scanned. Findings of both are joined to all rows."""
    docs = table(spark, sf_dir, "documents")
    ledger = shared_dir(spark)
    secret_scan.update_ledger(docs.filter(F.xxhash64("doc_id") < 0), ledger)
    found = secret_scan.scan_secrets(docs, ledger)
    base = secret_scan.of_kind(F.col("secrets"), *secret_scan.BASE_KINDS)
    return found.select(
        "doc_id", *[F.size(secret_scan.of_kind(F.col("secrets"), k)).cast("long").alias(f"n_{k}")
                    for k in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"), secret_scan.spans_text(F.col("secrets")).alias("spans"))


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "contaminated", "items", "covered")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(), check=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.hard_negatives(vectors)


def op12_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bktree.near_duplicates(table(spark, sf_dir, "documents"))


def op13_misra_gries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_hilbert_shards": op2_hilbert_shards,
    "op3_feistel_pseudonyms": op3_feistel_pseudonyms,
    "op4_chat_snapshots": op4_chat_snapshots,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_secret_scan": op6_secret_scan,
    "op7_template_decontamination": op7_template_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_html_wrappers": op10_html_wrappers,
    "op11_four_russians": op11_four_russians,
    "op12_bk_trees": op12_bk_trees,
    "op13_misra_gries": op13_misra_gries,
}

#: DuckDB SQL for the same rows, where SQL can express them.
ORACLE_SQL: dict[str, str] = {
    "op5_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE
                  WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
              FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y, c = nx.n AND c = ny.n AS same FROM p
              JOIN n AS nx ON x = nx.doc_id JOIN n AS ny ON y = ny.doc_id
              WHERE c >= 0.8 * (nx.n + ny.n - c) - 1e-9),
        r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.y FROM r JOIN l ON r.b = l.x),
        f AS (SELECT d.doc_id, least(d.doc_id, min(l.y)) AS first_copy
              FROM d LEFT JOIN l ON d.doc_id = l.x AND l.same GROUP BY d.doc_id),
        k AS (SELECT x, count(*) AS n_links, count(DISTINCT CASE WHEN NOT same THEN first_copy END) AS n_text_links
              FROM l JOIN f ON l.y = f.doc_id GROUP BY x)
        SELECT a AS doc_id, min(b) AS class_id, coalesce(any_value(n_links), 0) AS n_links,
               coalesce(any_value(n_text_links), 0) AS n_text_links, count(*) AS class_size
        FROM r LEFT JOIN k ON r.a = k.x GROUP BY a""",
    "op8_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
                   FROM documents),
             p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d),
             v AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM p),
             m AS (SELECT k, min(doc_id) AS first_id FROM v GROUP BY k HAVING min(doc_id) < max(doc_id)),
             g AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS gone
                   FROM v JOIN m USING (k) WHERE doc_id > first_id GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
               sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
                   [w[j] FOR j IN range(1, len(w) + 1) IF NOT list_contains(gone, j)] END, ' ')) AS kept_sha256
        FROM d LEFT JOIN g USING (doc_id)""",
    "op4_chat_snapshots": """
        WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                          role NULLS FIRST, text NULLS FIRST) AS place FROM conversations),
             p AS (SELECT *, string_agg(md5(coalesce('r' || role, '')) || md5(coalesce('t' || text, '')), '')
                             OVER (PARTITION BY conv_id ORDER BY place) AS prefix,
                          count(*) OVER (PARTITION BY conv_id) AS n_turns FROM t),
             w AS (SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM p
                   WHERE place = n_turns GROUP BY prefix),
             m AS (SELECT * FROM w WHERE prefix NOT IN (SELECT prefix FROM p WHERE place < n_turns))
        SELECT conv_id, count(*) AS n_turns, any_value(n_copies) AS n_copies,
               string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
                          ORDER BY place) AS rendered
        FROM m JOIN t USING (conv_id) GROUP BY conv_id""",
    "op11_four_russians": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
                          list_dot_product(a.e, c.e)::BIGINT AS score
                   FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
             p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id
                   ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND label <> anchor_label
                     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
    "op13_misra_gries": r"""
        WITH w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
                       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                       FROM documents)),
             t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
             f AS (SELECT lang, m, phrase, count(*) AS f FROM (
                       SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
                       FROM w, (VALUES (1), (2), (3)) AS s(m)) GROUP BY ALL HAVING count(*) >= 10),
             c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
             s AS (SELECT c.lang, c.m, c.phrase, a, k, l.f AS l, r.f AS r,
                          ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
                   FROM c JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(w[:k], ' ')
                          JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
                   QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
             o AS (SELECT lang, phrase, max(a) AS longer FROM (
                       SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
                       FROM c WHERE m = 3 AND k = 1) GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INTEGER AS rank, phrase, a, l, r, n, score
        FROM s LEFT JOIN o USING (lang, phrase) JOIN t USING (lang)
        WHERE longer IS NULL OR 100 * longer < 50 * a
        QUALIFY rank <= 2000""",
}
