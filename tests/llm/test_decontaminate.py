import tracemalloc

import pyarrow as pa
import pytest

from tellerlake.llm import decontaminate
from tellerlake.llm.words import pieces

ITEM = (
    "A courier leaves the depot with 12 boxes of 3.5 kg and meets his friend Anna Brown after 40 minutes, then"
    " he gives 5 boxes to Anna Brown and keeps the rest. How many boxes does he still have?"
)


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM, "x"), (2, "too short", None), (3, None, None), (4, "", None)]
    return spark.createDataFrame(rows, "item_id long, text string, source string")


def found(docs, benchmark, rows):
    return {(r.doc_id, r.item_id): r.verbatim for r in decontaminate.leaks(docs(rows), benchmark).collect()}


def test_verbatim_and_reparameterised(docs, benchmark):
    other = ITEM.replace("12", "31").replace("3.5 kg", "2 lbs").replace("Anna Brown", "Peter Paul Jones").replace("40", "7")
    mixed = ITEM.replace("to Anna Brown and", "to Peter Jones and")
    rows = [(1, "Before. " + ITEM + "\nAfter."), (2, "Before. " + other + " After."), (3, mixed), (4, "A courier leaves the depot.")]
    assert found(docs, benchmark, rows) == {(1, 1): True, (2, 1): False}


def test_shouted_accented_and_long_texts(docs, benchmark):
    filler = "Noch ein Satz über Äpfel und Öl, 12 kg davon. " * 4000
    rows = [(1, ITEM.upper()), (2, filler + ITEM + filler), (3, filler)]
    assert (2, 1) in found(docs, benchmark, rows) and (3, 1) not in found(docs, benchmark, rows)


def test_a_word_more_or_less(docs, benchmark):
    """Any word between others, and any lower-case word left out; a name cut in two would be two other names."""
    words = ITEM.split()
    more = [" ".join([*words[:k], "about", *words[k:]]) for k in range(1, len(words)) if words[k] != "Brown"]
    less = [" ".join([*words[:k], *words[k + 1 :]]) for k in range(len(words)) if words[k].islower()]
    rows = list(enumerate(f"Before. {text} After." for text in more + less))
    assert {d for d, _ in found(docs, benchmark, rows)} == set(range(len(rows)))


def test_short_items_are_whole_sentences(docs, spark):
    items = spark.createDataFrame([(1, "Who wrote Hamlet?"), (2, "Why is 7 prime?"), (3, "Oh no")], "item_id long, text string")
    rows = [(1, "Quiz. Who wrote Hamlet? Next."), (2, "Who wrote Faust?"), (3, "He asked who wrote Hamlet, then left."),
            (4, "who wrote Hamlet"), (5, "Why is 7 prime?\nWhy is 8 even?"), (6, "Why is 9 prime?"), (7, "Oh no")]
    assert found(docs, items, rows) == {(1, 1): True, (4, 1): True, (5, 2): True}


def test_tables_of_numbers_meet_by_value(docs, spark):
    numbers = " ".join(str(k * k % 1009) for k in range(200))
    items = spark.createDataFrame([(1, numbers), (2, "Add these up as fast as you can: " + numbers)], "item_id long, text string")
    tables = [(k, " ".join(str(k + 7 * j) for j in range(300))) for k in range(10)]
    rows = [*tables, (20, f"Given {numbers} then."), (21, "Add these up as fast as you can: " + tables[3][1])]
    assert found(docs, items, rows) == {(20, 1): True, (21, 2): False}
    flags = decontaminate._flags(decontaminate.windows(items, ["item_id"]))
    assert decontaminate.windows(docs(tables).select("doc_id", "text"), ["doc_id"], flags).count() < 10


def test_edges(docs, benchmark):
    rows = [(1, None), (2, ""), (None, ITEM), (None, "clean"), (5, ITEM), (5, ITEM), (5, "clean"), (6, "too short")]
    assert found(docs, benchmark, rows) == {(None, 1): True, (5, 1): True}
    kept = decontaminate.drop_leaking(docs(rows), benchmark)
    assert kept.columns == docs([]).columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("1", "None"), ("2", ""), ("5", "clean"), ("6", "too short"), ("None", "clean"),
    ]
    assert found(docs, benchmark, []) == {}
    assert found(docs, benchmark.limit(0), rows) == {}


def test_given_passages(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    planted = {(d, i) for d, t in texts.items() for i, q in items.items() if q in t}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op8_decontamination(spark, sf_dir).collect()}
    assert planted <= got
    assert len(got - planted) <= 1 + len(got) // 20


def test_steps_take_little_memory():
    texts = pa.array([f"{ITEM} {k}. " * 20 for k in range(1200)])
    tracemalloc.start()
    for piece in pieces(texts):
        decontaminate._cut(*decontaminate.templates(piece), False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts.nbytes > 4 << 20 and peak < 48 << 20


def test_only_texts_that_may_leak_are_shuffled(docs, benchmark):
    rows = [(k, f"clean text {k} " * 50) for k in range(2000)] + [(9000, ITEM), (9000, "clean"), (None, ITEM)]
    given = docs(rows)
    kept = decontaminate.drop_leaking(given, benchmark)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [*range(2000), 9000]))
    # The left side of the join, all documents before, is under a filter by flags.
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "held" in plan.split("LeftAnti")[1].split("Relation")[0]
