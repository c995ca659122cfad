import random
import re

from pyspark.sql import functions as F

from tellerlake.llm import lines


def plain(rows):
    """Lines kept of each (doc_id, text), by comparison with all earlier lines."""
    earlier, kept = [], {}
    for doc, text in sorted(rows):
        out = []
        for line in text.split("\n"):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w)
            if not words or not any(5 * len(words & e) >= 4 * len(words | e) for e in earlier):
                out.append(line)
            if words:
                earlier.append(words)
        kept[doc] = "\n".join(out)
    return kept


def varied(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["the", "of", "f", "x", " odd", "É"]
    base = [[draw.choice(vocabulary) for _ in range(draw.randint(1, 30))] for _ in range(25)]
    rows = []
    for doc in range(40):
        text = []
        for _ in range(draw.randint(0, 6)):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 3)):
                line[draw.randrange(len(line))] = draw.choice(vocabulary)
            text.append(draw.choice([" ", "\t", "  "]).join(line))
        rows.append((doc * 7 % 40, "\n".join(text)))
    return rows


def test_equals_brute_force(docs):
    for seed in (1, 2):
        rows = varied(seed)
        found = {r.doc_id: r.text for r in lines.dedup_lines(docs(rows)).collect()}
        assert found == plain(rows)


def test_given_documents(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in given.collect()]
    found = {r.doc_id: r.text for r in lines.dedup_lines(given).collect()}
    assert found == plain(rows)


def test_long_lines_with_many_common_words(docs):
    common = [f"c{i}" for i in range(400)]
    rows = [(0, " ".join(common)), (1, " ".join(common[:-60])), (2, " ".join(common[:-90])), (3, " ".join(common[150:]))]
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs(rows)).collect()} == plain(rows)


def test_edges(docs):
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "a b c"), (None, "a b c"), (4, "a b c"), (5, "c b a a\nend"), (4, "a b c")]
    found = lines.dedup_lines(docs(rows)).orderBy(F.col("doc_id").asc_nulls_first())
    assert found.columns == docs([]).columns
    assert [(r.doc_id, r.text) for r in found.collect()] == [
        (None, "a b c"), (None, "a b c"), (1, None), (2, ""), (3, "\n\n"), (4, "a b c"), (4, "a b c"), (5, "end"),
    ]
    assert lines.dedup_lines(docs([])).collect() == []


def test_one_id_with_two_texts(docs):
    found = lines.dedup_lines(docs([(1, "first line here"), (2, "x"), (3, "first line here\nown"), (3, "other\nfirst line here")]))
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [(1, "first line here"), (2, "x"), (3, "other"), (3, "own")]


def test_many_similar_lines_meet_their_leaders(docs):
    draw = random.Random(5)
    base = [f"b{i}" for i in range(20)]
    rows = []
    for doc in range(600):
        line = list(base)
        for _ in range(draw.randint(0, 4)):
            line[draw.randrange(20)] = f"n{draw.randrange(9)}"
        rows.append((doc * 7 % 600, " ".join(line)))
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs(rows)).collect()} == plain(rows)
