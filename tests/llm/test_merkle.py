import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tellerlake.llm import merkle
from tellerlake.llm.merkle import TAMPERED, build, derive, fold, height_of, lacking, op13_merkle, path, prove

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, at int, digest string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def frame(spark, rows):
    """Rows (doc_id, source, lang, n_chars, text) beside columns that clash with the operator's own."""
    return spark.createDataFrame([(i, t, l, s, n, "x", 1, "y") for i, s, l, n, t in rows], SCHEMA)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def whole_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def proof(levels, at):
    steps = []
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        steps.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return steps


def plain(rows):
    """Every proof by itself from whole trees."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        mine = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((mine, whole_tree([leaf_of(r) for r in mine])))
    top = whole_tree([levels[-1][0] for _, levels in trees])
    root, out = top[-1][0], []
    for tree, (mine, levels) in enumerate(trees):
        for at, row in enumerate(mine):
            steps = proof(levels, at) + proof(top, tree)
            folded = leaf_of(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                folded = leaf_of((*row[:4], lowered))
            for before, after in steps:
                folded = H(*before, folded, *after)
            told = H(*itertools.chain.from_iterable(before + after for before, after in steps))
            out.append((row[0], levels[0][at], levels[-1][0], root, told, folded, folded == root))
    return sorted(out, key=str)


def rows_of(sizes, seed=1):
    rng, out = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Héllo World", "lower only", "A" * 50_000, f"T{rng.random()}"])
            out.append((rng.choice([None, rng.randrange(10**6)]) if rng.random() < 0.1 else rng.randrange(10**6),
                        source, rng.choice([None, "en", ""]), rng.choice([None, 7]), text))
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {"one": 1},
        {"a": 16, "b": 17},
        {None: 3, "": 1, "hot": 700, "é": 40, "z": 256},
        {f"s{i:03}": 1 + i % 3 for i in range(40)},
    ],
)
def test_equals_plain_proofs(spark, sizes):
    rows = rows_of(sizes)
    rows += rows[:2]  # repeated rows
    got = prove(build(frame(spark, rows).repartition(3), TAMPERED)).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_trees_above_one_partition(spark, monkeypatch):
    """Partitions of 16 leaves and parts of two readers make every level be fetched from copies of nodes."""
    monkeypatch.setattr(merkle, "SPAN", 1)
    monkeypatch.setattr(merkle, "READERS", 2)
    rows = rows_of({"hot": 600, "b": 30, **{f"s{i}": 2 for i in range(20)}})
    got = prove(build(frame(spark, rows), TAMPERED)).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_some_leaves_only(spark):
    rows = rows_of({"a": 300, "b": 5, None: 20})
    manifest = build(frame(spark, rows), TAMPERED)
    some = prove(manifest, manifest.leaves.where("PMOD(at, 7) = 3")).select(COLUMNS).collect()
    assert 40 < len(some) < 60 and {tuple(r) for r in some} <= set(plain(rows))


def test_edges(spark):
    assert prove(build(frame(spark, []), TAMPERED)).collect() == []
    assert build(frame(spark, [])).root == H()
    untouched = prove(build(frame(spark, rows_of({"a": 50})))).where("NOT verified")
    assert untouched.count() == 0


def test_lacking_is_minimal_and_enough():
    rng = random.Random(3)
    for size in (1, 2, 16, 17, 255, 257, 5000):
        leaves = [hashlib.sha256(bytes([i % 251, i // 251])).digest() for i in range(size)]
        whole = {(0, at): digest for at, digest in enumerate(leaves)}
        derive(whole, list(range(size)), size)
        for n in (1, 3, 40):
            wanted = [rng.randrange(size) for _ in range(n)]
            missing = lacking(wanted, size)
            assert len(set(missing)) == len(missing)
            nodes = {(0, at): leaves[at] for at in wanted} | {c: whole[c] for c in missing}
            derive(nodes, wanted, size)
            root = whole[height_of(size), 0]
            assert nodes[height_of(size), 0] == root
            assert all(fold(leaves[at], path(nodes, at, size)) == root for at in wanted)
            for gone in missing[:5]:
                less = {c: d for c, d in nodes.items() if c != gone and c[0] <= gone[0] and c in (*missing, *((0, w) for w in wanted))}
                with pytest.raises(KeyError):
                    derive(less, wanted, size)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = op13_merkle(spark, sf_dir).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == plain([tuple(r) for r in docs.collect()])
    assert got.where(~F.col("verified")).count() > 0
