import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import templates as T
from quayside.llm.queries import QUERIES

from . import brute

ITEM = ("Last summer Anna Bergman bought 12 kg of apples for 30 euros, then Anna gave 5 kg of them to her neighbour. "
        "How many kg of apples did Anna keep for herself at the end of that day?")


def kinds(text):
    return T.Tokens(pa.array([text])).kind.tolist()


def test_tokens():
    assert kinds("He paid 12 kg, or 7.5% of Anna's twenty euros.") == [0, 0, 1, 3, 0, 1, 0, 2, 1, 3]
    assert kinds("Start. Then Go! km BIG Éva été\nNew") == [0, 0, 2, 0, 0, 2, 0, 0]
    same = T.Tokens(pa.array(["The (cat), sat!", "the cat sat", "THE CAT SAT"])).hash.reshape(3, 3)
    assert (same[0] == same[1]).all() and (same[1] == same[2]).all()
    assert T.Tokens(pa.array(["", None, " ?! ", "x"])).first.tolist() == [0, 0, 0, 0, 1]


def found(spark, texts, items=((1, ITEM),)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(items), "item_id long, text string").withColumn("more", F.lit(1))
    return {r.doc_id: r.items for r in T.decontaminate(docs, bench).collect()}


@pytest.mark.parametrize("text,held", [
    (ITEM, True), (f"Intro words, quite a few of them. {ITEM} And more words after it.", True), (ITEM.lower(), True), (ITEM.upper(), True),
    # other numbers and another name throughout
    (ITEM.replace("12", "48").replace("30", "99").replace("5 kg", "17 kg").replace("Anna", "Clara").replace("Bergman", "Holm"), True),
    # the name changes in the last sentence: windows with it do not count, the others do
    (ITEM.replace("Anna keep", "Otto keep"), True),
    (ITEM.replace("apples", "pears").replace("summer", "winter").replace("gave", "sold").replace("many", "few"), False),
    ("Last summer Anna Bergman bought 12 kg of apples for 30 euros, and that was that for the whole long and sunny year.", False),
    ("", False), (None, False),
])
def test_reparameterised_items_are_found_and_others_not(spark, text, held):
    assert found(spark, [text]) == {0: [1] if held else []}


def test_odd_rows_items_and_clashes(spark, odd, no_docs):
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM), (2, None), (3, ""), (4, "word1 alpha beta1 word2 alpha"),
                                   (5, "plain words that say little but say it twice")], "item_id long, text string")
    out = T.decontaminate(odd.withColumn("Items", F.lit("x")).withColumn("extra", F.lit(1)), bench)
    assert out.columns == [*odd.columns, "extra", "contaminated", "items", "covered"]
    rows = out.collect()
    assert len(rows) == 11
    assert {r.doc_id: r["items"] for r in rows if r["items"]} == {1: [5], 6: [5], 5: [4]}  # short items are one window
    assert all(r.contaminated == bool(r["items"]) and (r.covered > 0) == r.contaminated for r in rows)
    assert T.decontaminate(no_docs, bench).count() == 0
    assert T.decontaminate(odd, bench.limit(0)).filter("contaminated").count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    flat = lambda t: " ".join((t or "").lower().split())
    items = {r.item_id: flat(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r.doc_id: flat(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r["items"] for r in QUERIES["op7_template_decontamination"](spark, sf).collect()}
    assert got == {i: sorted(k for k, x in items.items() if x in t) for i, t in docs.items()}
    assert sum(map(bool, got.values())) > 10


HOURS = ("A baker needs 2 apples for every small cake that is sold at the old market in town, and after that the same baker "
         "walks home for 2 hours along the quiet river before the evening meal is ready.")


@pytest.mark.parametrize("text,item", [
    # one value in two roles, re-parameterised to two values
    (HOURS.replace("2 apples", "3 apples").replace("2 hours", "5 hours"), HOURS),
    # one name of a copied item changed in its last sentence, after more than half of it
    (ITEM.replace("neighbour. ", "neighbour. " + "She put the rest in a wide basket by the door of the old house and went to bed. ")
     .replace("Anna keep", "Otto keep"),
     ITEM.replace("neighbour. ", "neighbour. " + "She put the rest in a wide basket by the door of the old house and went to bed. ")),
    # a passage of a long item
    (" ".join(f"tok{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100, 200)),
     " ".join(f"tok{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(250))),
])
def test_partial_contamination_is_found(spark, text, item):
    assert found(spark, [text], [(1, item)]) == {0: [1]}


def changed(text, r):
    """Other numbers throughout, the same one for each."""
    new = {}
    return re.sub(r"\d+", lambda m: new.setdefault(m.group(), str(r.randint(100, 9999))), text)


def test_whole_tables_with_reparameterised_items_against_brute_force(spark, small):
    r = random.Random(7)
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{small}/benchmark.parquet").collect()][:25]
    items += [(1000, HOURS), (1001, ITEM), (1002, "Ein Bauer verkauft 14 Kilogramm Äpfel in drei Tagen, und danach ruht er sich 2 Wochen aus.")]
    docs = [(x.doc_id, x.text) for x in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    docs = [(i, (t or "")[:4000]) for i, t in docs]
    docs += [(5000 + k, f"Some words before it. {changed(t, r)} And after it.") for k, (_, t) in enumerate(items)]
    docs += [(6000 + k, changed(t, r).replace("kg", "pounds").replace("drei Tagen", "sieben Stunden")) for k, (_, t) in enumerate(items)]
    docs += [(7000 + k, " ".join(t.split()[: len(t.split()) // 3])) for k, (_, t) in enumerate(items)]
    numbers, units = set(T.NUMBER_WORDS), set(T.UNITS)
    tokens = {i: brute.template(t, numbers, units) for i, t in docs}
    out = T.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"))
    got = {x.doc_id: set(x["items"]) for x in out.collect()}
    hits = 0
    for k, t in items:
        item = brute.template(t, numbers, units)
        for i, _ in docs:
            want = brute.holds_item(tokens[i], item)
            assert want is None or (k in got[i]) == want, (i, k)
            hits += bool(want)
    assert hits >= 2 * len(items)


@pytest.mark.parametrize("item,same,other,held", [
    # three plain words: also with other numbers
    ("What is 12 x 13 ?", "Now tell: What is 12 x 13 ? Quick!", "Now tell: What is 7 x 9 ? Quick!", True),
    # fewer: word for word only
    ("Compute 12 + 15 - 7 + 3 = 23", "so compute 12 + 15 - 7 + 3 = 23 and", "so compute 1 + 2 - 3 + 4 = 5 and", False),
    ("Is Paris bigger?", "I ask you: is Paris bigger? Who knows", "I ask you: is Otto bigger? Who knows", False),
    ("法国的首都是哪座城市？", "问题 法国的首都是哪座城市？ 巴黎", "问题 德国的首都是哪座城市？ 柏林", False),
    ("1 2 3 4 5 6 7 8 9 10 11 12", "row 1 2 3 4 5 6 7 8 9 10 11 12 end", "row 11 21 31 41 51 61 71 81 91 101 111 121 end", False),
    ("Zwölf Meter und dreißig Tage", "Es sind zwölf Meter und dreißig Tage vergangen", "Es sind neun Meter und vierzig Tage vergangen", False),
])
def test_items_without_a_usable_window(spark, item, same, other, held):
    clean = ["Is it bigger?", "What is it? 12", "compute", "12 15 7 3 23", "", None, "法国", "one of many " * 20]
    assert found(spark, [same, other, *clean], [(3, item)]) == {0: [3], 1: [3] if held else [], **{2 + i: [] for i in range(len(clean))}}


def test_very_short_items_are_not_looked_for(spark):
    assert found(spark, ["yes", "Yes, 12"], [(1, "Yes"), (2, "12"), (3, "?!")]) == {0: [], 1: []}
