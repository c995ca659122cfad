import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerlake.llm import language

TRAIN = [
    ("the cat and the dog were in the house with that thing", "en"),
    ("le chat et le chien sont dans la maison avec cette chose", "fr"),
    ("кошка и собака были в доме с этой вещью", "ru"),
    ("ignored text", None),
    (None, "fr"),
]
NAMES = ["lang_pred", "score", "span_langs", "span_words"]


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.createDataFrame(TRAIN, "text string, lang string"))


def test_spans_scripts_and_texts_without_letters(docs, model):
    english, french, russian = "the dog and the cat in that house", "le chien dans cette maison avec le chat", "собака в доме"
    rows = [
        (1, english), (2, f"{french} {english}. {russian}"), (3, None), (4, "12 :-) 3"), (5, ""), (6, russian), (6, russian),
        (None, french), (7, " ".join([english] * 4000)), (8, "→ …"),
    ]
    found = language.identify(docs(rows), model)
    assert found.drop("__language").columns == docs([]).columns
    got = {(r.doc_id, r.text): r["__language"] for r in found.collect()}
    assert found.count() == len(rows)
    plain = {k[0]: tuple(v) for k, v in got.items()}
    assert plain[1] == ("en", 1.0, ["en"], [8])
    assert plain[2][2:] == (["fr", "en", "ru"], [8, 8, 3]) and plain[2][0] == "fr"
    assert plain[6][0] == "ru" and plain[None][0] == "fr"
    assert plain[7] == ("en", 1.0, ["en"], [32000])
    for i in (3, 4, 5, 8):
        assert plain[i] == ("und", 0.0, [], [])


def test_viterbi_equals_enumeration():
    random = np.random.default_rng(0)
    lengths = [0, 1, 4, 6, 3]
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores = random.normal(0, 3, (first[-1], 3)).astype(np.float32)
    labels = language.viterbi(scores, first, 2.0)
    for low, high in zip(first[:-1], first[1:]):
        def worth(path, at=scores[low:high]):
            return sum(at[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(3), repeat=high - low), key=worth)
        assert worth(tuple(labels[low:high])) == pytest.approx(worth(best), abs=1e-4)


def test_nothing_learned_and_empty_table(spark, docs):
    nothing = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert [tuple(r["__language"]) for r in language.identify(docs([(1, "abc")]), nothing).collect()] == [("und", 0.0, [], [])]
    assert language.identify(docs([]), nothing).collect() == []


def test_held_out_rows_of_given_documents(spark, sf_dir):
    found = language.op5_language_id(spark, sf_dir)
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    assert found.count() == given.count()
    held = found.join(given, "doc_id").where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count()
    assert found.where("score < 0 OR score > 1").count() == 0


def test_stage_drops_only_texts_without_letters(spark, docs):
    rows = docs([(i, "the cat") for i in range(9)] + [(20, "12"), (21, None)]).withColumn("lang", F.lit("en"))
    assert {r.doc_id for r in language.with_language(rows).collect()} == set(range(9))
