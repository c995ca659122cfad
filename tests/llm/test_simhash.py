import itertools
import random
import re

import xxhash

from tellerlake.llm import simhash
from tellerlake.llm.components import connected
from .conftest import union_find


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    ids = {i for i, _ in prints}
    edges = [(a, b) for (a, f), (b, g) in itertools.combinations(prints, 2) if bin(f ^ g).count("1") <= 2]
    return prints, union_find(ids, edges)


def some_texts():
    draw = random.Random(5)
    words = ["alpha", "Beta", "GAMMA", "delta", "É", "zeta eta", "x"]
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 9))) for _ in range(60)]
    long = " ".join(draw.choices(words, k=4000))
    return [*texts, long, long + " end", long.replace("x", "y", 1), "", " \t\n", None, "one", "one two", texts[0], texts[0].upper()]


def test_groups_equal_brute_force(docs):
    rows = list(enumerate(some_texts()))
    random.Random(1).shuffle(rows)
    prints, groups = plain_groups(rows)
    found = {r.doc_id: r for r in simhash.near_duplicates(docs(rows)).collect()}
    assert {i: f"{f:016x}" for i, f in prints} == {i: r.fingerprint for i, r in found.items()}
    assert groups == {i: r.component_id for i, r in found.items()}
    kept = {r.doc_id for r in simhash.keep_one(docs(rows)).collect()}
    assert kept == set(groups.values())


def test_links_at_two_bits_and_not_at_three(spark):
    rows = [(0,), (0b11,), (0b1111,), (0b111 << 20,), (-1,), (2**63 - 1,), (5 << 40,)]
    edges = simhash.links(spark.createDataFrame(rows, "fp long"))
    groups = {r.node: r.component for r in connected(edges).collect()}
    assert groups[0b1111] == groups[0b11] == groups[0] == 0
    assert groups[-1] == groups[2**63 - 1]
    assert groups[5 << 40] == 0  # two bits from zero
    assert 0b111 << 20 not in groups


def test_odd_distance(spark):
    edges = simhash.links(spark.createDataFrame([(0,), (0b111,), (0b1111 << 9,)], "fp long"), distance=3)
    assert {frozenset(r) for r in edges.collect()} == {frozenset((0, 0b111))}


def test_repeated_rows_and_rows_without_id(docs):
    found = simhash.near_duplicates(docs([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t u v")])).collect()
    assert len(found) == 4
    assert {r.component_id for r in found if r.fingerprint == found[0].fingerprint} <= {3, None}
    kept = simhash.keep_one(docs([(3, "a b c d"), (3, "a b c d"), (None, "a b c d")])).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["3", "None"]


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []
    assert simhash.keep_one(docs([])).collect() == []


def test_components_of_random_graph_and_chain(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)]
    edges += [(7, 7), (5, 9), (9, 5), (5, 9)]
    groups = union_find({n for e in edges for n in e if e[0] != e[1]}, [e for e in edges if e[0] != e[1]])
    found = connected(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == groups
    assert found.count() == len(groups)
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []
