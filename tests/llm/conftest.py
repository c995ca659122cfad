import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int"


@pytest.fixture
def docs(spark):
    """A frame of documents from (doc_id, text) pairs; it has more columns than operators use."""

    def build(rows):
        full = [(i, t, None, "src1", 0, 7) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


def union_find(nodes, edges):
    """The smallest node that each one reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
