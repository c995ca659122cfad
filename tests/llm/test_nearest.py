import numpy as np
from pyspark.sql import functions as F

from tellerlake.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, asked, k):
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i in asked:
        far = np.sqrt(((vectors - vectors[list(ids).index(i)]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), far[j]) for j in order]
    return out


def found(spark, rows, condition="vec_id % 100 = 0", k=10):
    frame = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], SCHEMA)
    out = {}
    for r in nearest.nearest(frame, F.expr(condition), k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_few_vectors_are_exact_with_ties(spark):
    rows = [(i, [float(i % 5), 1.0]) for i in range(60)]
    got, want = found(spark, rows, "vec_id % 10 = 0"), brute(rows, range(0, 60, 10), 10)
    assert got == want
    assert [len(v) for v in found(spark, rows[:4], "vec_id = 0").values()] == [3]


def test_bad_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (200, [0.0, 0.0]), (300, [nan, 1.0]), (400, [inf, 1.0]), (500, [None, 1.0]), (600, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (700, [])]
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [9.0, 0.0]), (2, [0.0, 3.0])]
    got = found(spark, rows + bad)
    assert got == {0: [(1, 1.0), (2, np.sqrt(10.0))]}
    assert found(spark, []) == {} and found(spark, bad[:3]) == {}


def test_a_third_of_equal_vectors_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nearest, "PART_ROWS", 50)
    monkeypatch.setattr(nearest, "PART_QUERIES", 3)
    monkeypatch.setattr(nearest, "LIST_ROWS", 40)
    random = np.random.default_rng(0)
    rows = [(i, [1.0, 1.0, 1.0] if i % 3 == 0 else random.normal(0, 1, 3).tolist()) for i in range(900)]
    got, want = found(spark, rows, "vec_id % 50 = 0"), brute(rows, range(0, 900, 50), 10)
    hits = sum(len({a for a, _ in got[i]} & {a for a, _ in want[i]}) for i in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert got[0] == want[0]  # all ties, to the smaller ids


def test_recall_on_given_vectors(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in given.collect()]
    got = {}
    for r in nearest.op10_nearest(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows, [i for i, _ in rows if i % 100 == 0], 10)
    assert sum(len(got[i] & {a for a, _ in want[i]}) for i in want) >= 0.9 * sum(map(len, want.values()))
