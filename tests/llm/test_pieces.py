import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import pieces
from quayside.llm.queries import QUERIES, piece_model


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.MergeVocabulary(piece_model())


def test_random_texts_against_the_library(vocabulary):
    r = random.Random(2)
    parts = [*"abcdethin▁ \n\t.0123é中😀ßA\x00<>", "the", "ing", " of ", "    ", "<0x0A>", "<s>", "\r\n", "tion"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 80))) for _ in range(3000)]
    assert vocabulary.encode(texts) == vocabulary.library.encode(texts)


def test_long_units_and_both_agendas(vocabulary):
    r = random.Random(4)
    text = "".join(r.choice("aehinorst") for _ in range(30_000)) + " " * 5000 + "é" * 3000
    assert vocabulary.encode([text])[0] == vocabulary.library.encode(text)
    units = ["▁" + "".join(r.choice("aehinorst") for _ in range(r.randint(0, 38))) for _ in range(500)]
    assert {u: vocabulary.encode_long(u) for u in units} == vocabulary.encode_units(units)


def test_forgotten_units_are_encoded_again(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    texts = [f"some words {i} and others {i % 7}" for i in range(60)]
    for t in texts:
        assert vocabulary.encode([t]) == [vocabulary.library.encode(t)]


def test_memory_of_units_is_bounded_in_bytes(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 100_000)
    vocabulary.known, vocabulary.older, vocabulary.held = {}, {}, 0
    r = random.Random(6)
    word = lambda n: "".join(r.choice("abcdefghijklmnop0123456789+/") for _ in range(n))
    for _ in range(15):
        texts = [" ".join(word(r.choice([3, 9, 400])) for _ in range(40)) for _ in range(10)]
        assert vocabulary.encode(texts) == vocabulary.library.encode(texts)
        held = [u for side in (vocabulary.known, vocabulary.older) for u in side]
        assert max(map(len, held)) <= pieces.LONG and len(held) * pieces.OVERHEAD < 4 * pieces.REMEMBERED


def test_a_difference_from_the_library_fails_the_batch(spark, monkeypatch, vocabulary):
    class Other:
        def __init__(self):
            self.library = vocabulary.library

        def encode_arrow(self, text):
            return vocabulary.encode_arrow(text.slice(0, len(text) - 1))

    batch = pa.record_batch({"text": pa.array(["one text", "another"])})
    run = pieces.encoder("model", "text", True)
    monkeypatch.setattr(pieces, "vocabulary", lambda model: vocabulary)
    assert run(batch)[0].to_pylist() == vocabulary.library.encode(["one text", "another"])
    monkeypatch.setattr(pieces, "vocabulary", lambda model: Other())
    with pytest.raises(ValueError):
        run(batch)


def test_query_against_the_library_and_odd_rows(spark, small, odd, no_docs, vocabulary):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in QUERIES["op9_sentencepiece"](spark, small).collect():
        ids = vocabulary.library.encode(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(vocabulary.library.decode(ids)))
    out = pieces.encode_pieces(odd.withColumn("IDS", F.lit("x")).withColumn("extra", F.lit(1)), piece_model(), check=True)
    assert out.columns == [*odd.columns, "extra", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == 11 and all(r.ids == vocabulary.library.encode(r.text or "") for r in rows)
    assert all(r.decoded == (r.text or "") for r in rows)
    assert pieces.encode_pieces(no_docs, piece_model()).count() == 0
