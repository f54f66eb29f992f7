"""Template windows: leaks, re-parameterised questions, slot consistency, brute force on whole texts."""

import re

import pytest

from fichario.llm import decontaminate as d
from fichario.llm.catalog import op3_decontamination

QUESTION = ("If a train with 12 wagons leaves Lyon at 9 and travels 300 km in 4 hours, then with 12 wagons "
            "what mean speed did driver Paul keep on the way to Lyon and back home again")


def pairs(spark, texts, items):
    docs = spark.createDataFrame(texts, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = d.leaks(docs, bench).drop("text_key").collect()
    return sorted(((r.doc_id, r.item_id, r.n_changed) for r in rows), key=str)


def test_slots_are_typed_and_aligned(spark):
    from pyspark.sql import functions as F

    text = "Ana said, Bob ran 3.5 km and 20kg, about 7 %. The Cat x"
    frame = spark.createDataFrame([(text,)], "text string")
    found = frame.select(d.tokens(F.col("text"))).first()[0]
    marks = {d.NAME: "N", d.NUMBER: "#", d.UNIT: "U"}
    shown = [marks[t[0]] + t[1:-1] if t[0] in marks else t for t in found]
    assert shown == ["Nana", "said", "Nbob", "ran", "#3.5", "Ukm", "and", "#20", "Ukg", "about", "#7", "U%", "Nthe", "Ncat", "x"]


ALICE = "Alice has 5 apples. Bob gives her 3 more. How many apples does Alice have now?"


def test_names_are_slots_wherever_they_stand(spark):
    carol = ALICE.replace("Alice", "Carol").replace("Bob", "David")
    texts = [(1, ALICE, 0), (2, carol, 0), (3, carol.replace("5", "8").replace(". ", ".\n"), 0), (4, ALICE.lower(), 0),
             (5, ALICE.upper(), 0), (6, 'He read: "' + carol + '" And then', 0), (7, "Mr. " + carol, 0),
             (8, ALICE.replace("How many", "how many").replace("Bob", "Émile"), 0),
             (9, "Carol has 5 apples. David gives her 3 more. How many apples does Erin have now?", 0),  # 11 of 12 agree
             (10, "Alice has two brothers. Bob gives her a book. How many books does Alice read?", 0)]
    found = {r[0]: r[2] for r in pairs(spark, texts, [(7, ALICE)])}
    assert found == {1: 0, 2: 2, 3: 3, 4: 0, 5: 0, 6: 2, 7: 2, 8: 1, 9: 2}
    item = "then Ann asked whether Ann could lend Ann her pen and Ann said that Ann had none"
    other = "then Eve asked whether Kim could lend Joe her pen and Lea said that Max had none"
    assert [r[0] for r in pairs(spark, [(1, other, 0), (2, item.replace("Ann", "Zoe"), 0)], [(7, item)])] == [2]


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "小明有5个苹果,小红又给了他3个,请问小明现在一共有多少个苹果?"
    items = [(1, "Name seven primes"), (2, chinese), (3, "2 + 2 = 4"), (4, "3, 5, 7, 9, 11, 13"), (5, "?!"),
             (6, "Paris London Rome Berlin Madrid Lisbon")]
    texts = [(1, "please name SEVEN primes, all of them", 0), (2, "题目:" + chinese + "答案是八。", 0),
             (3, chinese.replace("5", "9"), 0), (4, "so 2 + 2 = 4 holds", 0), (5, "so 2 + 2 = 5 does not", 0),
             (6, "first 3, 5, 7, 9, 11, 13 and so on", 0), (7, "first 4, 6, 8, 10, 12, 14 and so on", 0),
             (8, "Name eight primes", 0), (9, "小红有许多苹果", 0), (10, "?!", 0),
             (11, "Oslo Bergen Tromso Bodo Molde Narvik", 0), (12, "paris london rome berlin madrid lisbon", 0)]
    found = {r[:2] for r in pairs(spark, texts, items)}
    assert found == {(1, 1), (2, 2), (3, 2), (4, 3), (6, 4), (12, 6)}


def test_reparameterised_questions_are_found(spark):
    other = QUESTION.replace("12", "15").replace("300", "777").replace("Paul", "Marie").replace("Lyon", "Oslo")
    mixed = QUESTION.replace("12", "15", 1).replace("Lyon", "Oslo", 1)  # 12 -> 15 and 12, Lyon -> Oslo and Lyon
    texts = [(1, "Before. " + QUESTION + ", after.", 0), (2, other, 0), (3, mixed, 0), (4, QUESTION[: len(QUESTION) // 2], 0),
             (5, "If a train with nothing in common leaves", 0), (6, other + "\n" + QUESTION, 0)]
    found = pairs(spark, texts, [(7, QUESTION)])
    assert (1, 7, 0) in found and (2, 7, 4) in found
    assert {f[0] for f in found} == {1, 2, 6}


def test_versions_side_by_side_do_not_mix(spark):
    def short(length, time):
        return f"a train covers {length} km in {time} hours before it turns"

    def long(wagons, hour, length, time, word=""):
        return (f"if a train with {wagons} wagons leaves at {hour} and travels {length} km in {time} hours then with {wagons} "
                f"wagons {word}what mean speed of at least {length} km did the driver keep on the way back home again that day")

    texts = [(1, short(777, 5) + ". " + short(500, 9), 0), (2, f"{short(777, 5)}; {short(500, 9)}; so {short(600, 7)}", 0),
             (3, f"{short(777, 5)}; {short(300, 4)}; {short(777, 5)}", 0),
             (4, long(15, 8, 500, 9, "now ") + "\n" + long(20, 7, 777, 5, "now "), 0),
             (5, "a train covers 777 km in 5 days. in 9 hours before it turns", 0)]
    found = pairs(spark, texts, [(7, short(300, 4)), (8, long(12, 9, 300, 4))])
    assert {f[:2] for f in found} == {(1, 7), (2, 7), (3, 7), (4, 8)}
    assert (3, 7, 0) in found


def test_odd_rows(spark):
    texts = [(1, None, 0), (2, "", 0), (None, QUESTION, 0), (3, QUESTION, 0), (3, QUESTION, 0), (3, "else", 0),
             (4, " " * 10 + QUESTION, 0), (5, "word " * 30_000 + QUESTION, 0)]
    items = [(7, QUESTION), (7, QUESTION), (8, "too short"), (8, "..."), (None, QUESTION), (9, None)]
    found = pairs(spark, texts, items)
    assert found == sorted([(i, n, 0) for i in (None, 3, 4, 5) for n in (7, None)], key=str)
    assert pairs(spark, texts, []) == [] and pairs(spark, [], items) == []
    docs = spark.createDataFrame(texts, "doc_id long, text string, item_id int")
    kept = d.without_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3"]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_whole_query_against_brute_force(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        against_brute_force(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    assert not any(re.search("[0-9]", b.text) for b in bench)  # so plain words are the templates

    def windows(text):
        words = re.findall(r"[^\W\d_]+", text.lower())
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    items = {b.item_id: windows(b.text) for b in bench}
    want = {(r.doc_id, i) for r in docs for i, w in items.items() if w and len(w & windows(r.text)) >= 0.8 * len(w)}
    assert {(r.doc_id, r.item_id) for r in op3_decontamination(spark, folder).collect()} == want and want
