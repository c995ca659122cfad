import numpy as np
import pytest

from tellerlake.llm import likelihood


def naive(units, first, w):
    out = []
    inner = w["inner"].reshape(6, likelihood.DIM, -1)
    for low, high in zip(first[:-1], first[1:]):
        for t in range(low, high):
            total = w["inner_bias"].astype(float)
            for k, offset in enumerate((-3, -2, -1, 1, 2, 3)):
                other = units[t + offset] if low <= t + offset < high else likelihood.NOTHING
                total = total + w["embed"][other] @ inner[k]
            hidden, c, p = np.tanh(total), units[t] // 64, units[t] % 64
            one = hidden @ w["outer"] + w["outer_bias"]
            two = hidden @ w["leaf"][c] + w["leaf_bias"][c]
            out.append(one[c] - np.log(np.exp(one).sum()) + two[p] - np.log(np.exp(two).sum()))
    return np.array(out)


def test_log_probabilities_equal_naive_ones():
    random = np.random.default_rng(0)
    weights = likelihood._start(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), np.ones(likelihood.TAIL))
    weights = {k: (v + random.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in weights.items()}
    units, first = random.integers(0, likelihood.UNITS, 40), np.array([0, 0, 7, 8, 40])
    assert likelihood.log_probabilities(units, first, weights) == pytest.approx(naive(units, first, weights), rel=1e-3)


def test_context_beats_frequencies(docs):
    random = np.random.default_rng(1)
    rows = []
    for i in range(300):
        text = []
        for _ in range(100):
            k = random.integers(0, 20)
            text += [f"left{k}", f"right{k}"]
        rows.append((i, " ".join(text)))
    start = likelihood.fit(docs(rows), rounds=0)
    trained = likelihood.fit(docs(rows), rounds=3)
    fresh = docs([(1, "left3 right3 left9 right9 left1 right1 left0 right0"), (2, "right3 left9 left1 right0 right2 left8 right5 left4")])
    before = {r.doc_id: r.per_word for r in likelihood.score(fresh, start).collect()}
    after = {r.doc_id: r.per_word for r in likelihood.score(fresh, trained).collect()}
    assert after[1] > before[1] + 0.3 and after[1] > after[2] + 0.3


def test_training_predicts_every_word(docs):
    rows = [(1, " ".join(f"word{k}" for k in range(40)))]
    start, trained = (likelihood.fit(docs(rows), rounds=n) for n in (0, 1))
    gain = (trained.weights["leaf_bias"] - start.weights["leaf_bias"]).ravel()
    assert (gain[start.unit] > 0).all() and (np.delete(gain[:64], start.unit) < 0).all()


def test_each_word_is_dealt_to_one_round():
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 3000).astype(np.uint64)
    first = np.array([0, 0, 10, 3000])
    assert (likelihood._turns(hashes, first, 1) == 0).all()
    n = np.bincount(likelihood._turns(hashes, first, 3), minlength=3)
    assert n.sum() == 3000 and len(n) == 3 and n.min() > 800


def test_edges(docs):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "some words here"), (4, "some words here"), (4, "some words here"), (5, "a b " * 30000)]
    model = likelihood.fit(docs(rows))
    found = likelihood.score(docs(rows), model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: tuple(r)[1:] for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == (0, 0.0, 0.0)
    assert by_id[None] == by_id[4] and by_id[4][0] == 3 and by_id[4][1] < 0 and by_id[5][0] == 60000
    assert likelihood.score(docs([]), likelihood.fit(docs([]))).collect() == []


def naive_step(w, squares, units, around):
    """The slopes of each word by itself, added up, and AdaGrad's step from them."""
    slopes, n = {k: np.zeros(v.shape) for k, v in w.items()}, len(units)
    share = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for unit, others in zip(units, around):
        c, p, seen = unit // 64, unit % 64, w["embed"][others].astype(float).ravel()
        hidden = np.tanh(seen @ w["inner"] + w["inner_bias"])
        one, two = share(hidden @ w["outer"] + w["outer_bias"]), share(hidden @ w["leaf"][c] + w["leaf_bias"][c])
        one[c] -= 1
        two[p] -= 1
        back = (w["outer"] @ one + w["leaf"][c] @ two) * (1 - hidden**2)
        slopes["outer"] += np.outer(hidden, one) / n
        slopes["outer_bias"] += one / n
        slopes["leaf"][c] += np.outer(hidden, two) / n
        slopes["leaf_bias"][c] += two / n
        slopes["inner"] += np.outer(seen, back) / n
        slopes["inner_bias"] += back / n
        np.add.at(slopes["embed"], others, (w["inner"] @ back).reshape(len(others), -1) / n)
    slopes["embed"][likelihood.NOTHING] = 0
    moved = {k: squares[k] + s**2 for k, s in slopes.items()}
    return {k: w[k] - likelihood.RATE * s / np.sqrt(moved[k]) for k, s in slopes.items()}, moved


@pytest.mark.parametrize("far", [0.3, 40])
def test_a_step_moves_weights_by_the_words_own_slopes(far):
    # Most contexts hold one of three units, so their slopes have many rows; with ``far`` weights logits exceed floats.
    random = np.random.default_rng(3)
    weights = likelihood._start(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), np.ones(likelihood.TAIL))
    weights = {k: (v + random.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in weights.items()}
    weights["outer"] *= np.float32(far / 0.3)
    weights["embed"][likelihood.NOTHING] = 0
    squares = {k: np.full_like(v, 1e-2) for k, v in weights.items()}
    units = random.integers(0, likelihood.UNITS, 150)
    around = np.where(random.random((150, 6)) < 0.7, random.integers(0, 3, (150, 6)), random.integers(0, likelihood.UNITS + 1, (150, 6)))
    want, held = naive_step(weights, squares, units, around)
    likelihood._step(weights, squares, units, around)
    for name in want:
        assert np.allclose(weights[name], want[name], atol=1e-4), name
        assert np.allclose(squares[name], held[name], rtol=1e-3, atol=1e-6), name


def test_scores_are_those_of_any_way_of_cutting(monkeypatch):
    random = np.random.default_rng(4)
    weights = likelihood._start(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), np.ones(likelihood.TAIL))
    units, first = random.integers(0, likelihood.UNITS, 500), np.array([0, 3, 3, 499, 500])
    whole = likelihood.log_probabilities(units, first, weights)
    monkeypatch.setattr(likelihood, "SCORED", 7)
    assert whole == pytest.approx(likelihood.log_probabilities(units, first, weights), abs=1e-5)
    assert whole == pytest.approx(naive(units, first, weights), rel=1e-3)


def test_a_step_takes_each_exponent_once(monkeypatch):
    weights = likelihood._start(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), np.ones(likelihood.TAIL))
    squares = {k: np.full_like(v, 1e-2) for k, v in weights.items()}
    taken, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *rest, **more: taken.append(np.size(x)) or exp(x, *rest, **more))
    likelihood._step(weights, squares, np.arange(50), np.full((50, 6), 7))
    assert sum(taken) == 2 * 50 * 64


def test_search_finds_where_hashes_stand():
    random = np.random.default_rng(5)
    common = np.sort(np.append(random.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2), np.arange(9, dtype=np.uint64)))
    ends = np.array([0, 3, 9, 2**64 - 1], np.uint64)
    asked = np.concatenate([common, common + np.uint64(1), ends, random.integers(0, 1 << 63, 3000).astype(np.uint64)])
    for some in (common, common[:1]):
        assert (likelihood._search(some, asked) == np.searchsorted(some, asked)).all()


def test_words_are_counted_once(spark, docs):
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    given = docs([(i, f"some words of text {i}") for i in range(50)])
    model = likelihood.fit(given.mapInArrow(passing, given.schema), rounds=0)
    assert read.value == 50 and len(model.common) == 54
    assert len(likelihood.fit(given.limit(0)).common) == 0
