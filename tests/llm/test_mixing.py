import pytest

from tellerlake.llm import mixing


@pytest.mark.parametrize("shares", [{"": 1}, {"a": 1, "b": 2, "": 4}, mixing.SHARES, {"a": 97, "b": 2, "": 1}])
def test_every_block_is_in_its_window(shares):
    total, given = sum(shares.values()), dict.fromkeys(shares, 0)
    for name, block, slot in mixing.period(shares):
        assert block == given[name]
        assert block * total // shares[name] <= slot < -(-(block + 1) * total // shares[name])
        given[name] += 1
        for other, count in given.items():
            assert abs(count - shares[other] * (slot + 1) / total) < 1
    assert given == shares


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, slot string, text string")


def test_equals_plain_schedule(spark):
    rows = [(i, ["a", "a", "a", "b", "c", None][i % 6], "clash", None) for i in range(300)]
    shares = {"a": 2, "b": 3, "": 1}
    found = mixing.mix(frame(spark, rows), shares, block_rows=4).collect()
    assert sorted(r.doc_id for r in found) == list(range(300))
    by_slot = {}
    for r in found:
        by_slot.setdefault(r.slot, []).append(r)
    period = {(name, block): slot for name, block, slot in mixing.period(shares)}
    for slot, members in by_slot.items():
        names = {r.component for r in members}
        assert len(names) == 1
        name, block = names.pop(), members[0].block
        assert slot == block // shares[name] * 6 + period[name, block % shares[name]]
        assert members[0].release <= slot < members[0].deadline
        assert sorted(r.place for r in members) == list(range(len(members)))
        assert {r.source if r.source in ("a", "b") else "" for r in members} == {name}
    counts = {n: sum(r.component == n for r in found) for n in shares}
    assert {n: len({r.block for r in found if r.component == n}) for n in shares} == {n: -(-c // 4) for n, c in counts.items()}


def test_buckets_do_not_change_numbers(spark, monkeypatch):
    rows = frame(spark, [(i, "a", None, "t") for i in range(100)] + [(None, "a", None, str(i)) for i in range(20)] + [(3, "a", None, "t")])
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    found = mixing.mix(rows, {"a": 1, "": 1}, block_rows=7).collect()
    assert len(found) == 121
    assert sorted(r.block * 7 + r.place for r in found) == list(range(121))


def test_edges(spark):
    assert mixing.mix(frame(spark, []), mixing.SHARES).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(frame(spark, []), {"a": 1})
    with pytest.raises(ValueError):
        mixing.period({"a": -1, "": 2})
