import random

import numpy as np
import pytest

from tellerlake.llm import quality, toxicity
from tellerlake.llm.tables import held_out

LABELS = "doc_id long, quality int, toxic int, text string"


def area(scores, truth):
    scores, truth = np.array(scores), np.array(truth)
    good, bad = scores[truth > 0], scores[truth == 0]
    return (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2


def test_quality_of_given_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = quality.op6_quality(spark, sf_dir)
    assert found.count() == 1000
    rows = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    assert area([r.score for r in rows], [r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_is_the_same_however_rows_are_dealt(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    from pyspark.sql import functions as F

    one, other = (
        {r.doc_id: r.score for r in quality.classify(docs.repartition(n), labels, F.lit(True)).collect()} for n in (2, 7)
    )
    assert one.keys() == other.keys() and max(abs(one[i] - other[i]) for i in one) < 1e-6


@pytest.fixture
def toxic_rows():
    draw = random.Random(2)
    vocabulary = ["".join(draw.choices(["lo", "ra", "ti", "men", "sa", "vo"], k=draw.randint(1, 4))) for _ in range(400)]
    rows = []
    for i in range(500):
        text = draw.choices(vocabulary, k=draw.randint(5, 80))
        if i % 4 == 0:
            for _ in range(draw.randint(1, 4)):
                text.insert(draw.randint(0, len(text)), "zkurv" + draw.choice(vocabulary) + draw.choice(["", "!", ","]))
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return rows


def test_toxicity_knows_unseen_forms(spark, docs, toxic_rows):
    held = held_out
    labels = spark.createDataFrame([(i, None, y, "clash") for i, _, y in toxic_rows] + [(1, 1, None, "")], LABELS)
    from pyspark.sql import functions as F

    trains = ~held(F.col("doc_id"), 4, 2)
    more = [(900, None), (901, ""), (902, " ... "), (903, "zkurvxyz"), (None, "sa vo"), (904, "lo ra ti " * 20000 + "zkurvati " + "men sa " * 9)]
    found = toxicity.classify(docs([(i, t) for i, t, _ in toxic_rows] + more), labels, trains)
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == found.count() == len(toxic_rows) + len(more)
    unseen = [(got[r.doc_id].score, y) for r, y in ((got[i], y) for i, _, y in toxic_rows)]
    assert area(*zip(*unseen)) > 0.97
    assert got[900].score == got[901].score == 0 and got[904].predicted == got[903].predicted == 1


def test_edges_of_both(spark, docs):
    from pyspark.sql import functions as F

    none = spark.createDataFrame([], LABELS)
    one = spark.createDataFrame([(1, 1, 1, ""), (1, 1, 1, ""), (None, 0, 0, "")], LABELS)
    for module in (quality, toxicity):
        assert module.classify(docs([]), none, F.lit(True)).collect() == []
        for labels in (none, one):
            found = module.classify(docs([(1, "some text"), (1, "some text"), (None, "x"), (2, None)]), labels, F.lit(True)).collect()
            assert len(found) == 4 and all(0 <= r.score <= 1 for r in found)


def test_network_and_temperature():
    random_ = np.random.default_rng(1)
    pools = random_.normal(0, 1, (4000, 6))
    truth = (pools[:, 0] * pools[:, 1] + 0.5 * random_.normal(size=4000) > 0).astype(float)
    net = quality.train(pools, truth, np.ones(4000))
    fresh = random_.normal(0, 1, (4000, 6))
    real = (fresh[:, 0] * fresh[:, 1] + 0.5 * random_.normal(size=4000) > 0).astype(float)
    scores = net.scores(fresh)
    assert area(scores, real) > 0.85
    for low in np.arange(0, 1, 0.25):
        some = (scores >= low) & (scores < low + 0.25)
        assert abs(scores[some].mean() - real[some].mean()) < 0.08
