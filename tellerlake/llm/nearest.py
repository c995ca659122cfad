"""Approximate nearest neighbours over balanced posting lists.

Centroids come from a bounded sample (``SAMPLE_BYTES``), halved again and again at the median, so lists
start out equal. Every vector goes to its nearest list, and one near a boundary to the lists beyond it
as well (``REPLICAS``, ``BOUNDARY``), unless a list already chosen lies closer to that one than the
vector does. A query finds lists by a beam search in a graph of the centroids, held in memory, and reads
those whose centroid is at most a certain ratio farther than the nearest. The ratio is measured, not
guessed: the least one by which ``PROBED`` of the true neighbours of ``TRIALS`` vectors are found, their
neighbours coming from brute force over all rows. Clustered vectors need few lists; where distances hardly
differ, as between random directions, no ratio spares much, and most lists are read.

At most ``MOST_LISTS`` centroids reach the driver and the tasks. Lists and the queries of a list are dealt
in parts of bounded size, so neither a list of equal vectors nor a busy one lands in one task.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerlake.llm.tables import store, table

SAMPLE_BYTES = 32 << 20
MOST_LISTS = 8192
LIST_ROWS = 512
REPLICAS = 6
BOUNDARY = 1.25
TRIALS = 128
PROBED = 0.96
BEAM = 64
DEGREE = 16
ENTRIES = 64
PART_ROWS = 20_000
PART_QUERIES = 5_000
#: Postings that a query's lists hold at least, as long as there are more lists.
LEAST_POSTINGS = 400


@dataclass
class Index:
    """Centroids, each one's neighbours in the graph, and where searches enter it."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray


def _distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, not below zero."""
    squares = (rows**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * rows @ centroids.T
    return np.maximum(squares, 0)


def _halves(rows: np.ndarray, random) -> np.ndarray:
    """Which half of the rows each belongs to: the median along the line between two means."""
    one, two = rows[random.choice(len(rows), 2, replace=False)]
    for _ in range(4):
        upper = np.zeros(len(rows), bool)
        upper[np.argsort(rows @ (two - one), kind="stable")[len(rows) // 2 :]] = True
        one, two = rows[~upper].mean(axis=0), rows[upper].mean(axis=0)
    return upper


def build(sample: np.ndarray, lists: int, seed: int = 0) -> Index:
    """The index of a sample of vectors, with about ``lists`` centroids."""
    random = np.random.default_rng(seed)
    groups = [np.arange(len(sample))]
    while len(groups) < lists and max(map(len, groups)) > 1:
        halved = []
        for group in groups:
            if len(group) < 2:
                halved.append(group)
                continue
            upper = _halves(sample[group], random)
            halved += [group[~upper], group[upper]]
        groups = halved
    centroids = np.unique(np.stack([sample[g].mean(axis=0) for g in groups]).astype(np.float32), axis=0)
    degree = min(DEGREE, len(centroids))
    graph = np.empty((len(centroids), degree), np.int64)
    for at in range(0, len(centroids), 512):
        near = _distances(centroids[at : at + 512], centroids)
        graph[at : at + 512] = np.argpartition(near, degree - 1, axis=1)[:, :degree]
    entries = [0]
    far = _distances(centroids, centroids[:1])[:, 0]
    while len(entries) < min(ENTRIES, len(centroids)):
        entries.append(int(far.argmax()))
        far = np.minimum(far, _distances(centroids, centroids[entries[-1:]])[:, 0])
    return Index(centroids, graph, np.array(entries))


def assign(rows: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs: each row's nearest list, and those beyond a near boundary."""
    near = _distances(rows, index.centroids)
    most = min(REPLICAS * 3, len(index.centroids))
    some = np.argpartition(near, most - 1, axis=1)[:, :most]
    order = np.take_along_axis(some, np.take_along_axis(near, some, 1).argsort(axis=1, kind="stable"), 1)
    far = np.take_along_axis(near, order, 1)
    taken = np.zeros(order.shape, bool)
    taken[:, 0] = True
    for k in range(1, most):
        within = (far[:, k] <= BOUNDARY**2 * far[:, 0]) & (taken.sum(axis=1) < REPLICAS)
        for j in range(k):
            gap = ((index.centroids[order[:, k]] - index.centroids[order[:, j]]) ** 2).sum(axis=1)
            within &= ~taken[:, j] | (gap > 0.36 * far[:, k])
        taken[:, k] = within
    row, k = np.nonzero(taken)
    return row, order[row, k]


def search(queries: np.ndarray, index: Index, sizes: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, list) pairs that the beam search finds and the distance ratio keeps; all queries step together.

    A search opens ``BEAM`` centroids, and goes on while one within the ratio is not yet opened.
    """
    count = len(index.centroids)
    every = np.arange(len(queries))
    far = np.full((len(queries), count), np.inf)
    far[:, index.entries] = _distances(queries, index.centroids[index.entries])
    open_ = far.copy()
    for turn in range(count):
        best = open_.argmin(axis=1)
        nearest_open = open_[every, best]
        live = np.isfinite(nearest_open) & ((turn < BEAM) | (nearest_open <= ratio**2 * far.min(axis=1)))
        if not live.any():
            break
        open_[every, best] = np.inf
        rows, next_ = every[live], index.graph[best[live]]
        apart = ((queries[rows][:, None, :] - index.centroids[next_]) ** 2).sum(axis=2)
        fresh = ~np.isfinite(far[rows[:, None], next_])
        at, k = np.nonzero(fresh)
        far[rows[at], next_[at, k]] = apart[at, k]
        open_[rows[at], next_[at, k]] = apart[at, k]
    order = far.argsort(axis=1, kind="stable")
    sorted_ = np.take_along_axis(far, order, 1)
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    kept = np.isfinite(sorted_) & ((sorted_ <= ratio**2 * sorted_[:, :1]) | (before < LEAST_POSTINGS))
    query, k = np.nonzero(kept)
    return query, order[query, k]


def calibrate(rows: DataFrame, index: Index, k: int) -> float:
    """The least ratio that reads a list of ``PROBED`` of the true neighbours of ``TRIALS`` vectors."""
    trials = rows.orderBy(F.xxhash64("vec_id", F.lit("trial")), "vec_id").limit(TRIALS).toArrow()
    if not trials.num_rows:
        return 1.0
    ids, vectors = trials.column("vec_id").to_numpy(), _matrix(trials.column("vec").combine_chunks())

    def search_all(batches):
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros((0, vectors.shape[1])))] * len(ids)
        for batch in batches:
            other, those = batch.column(0).to_numpy(), _matrix(batch.column(1))
            near = _distances(vectors, those)
            near[ids[:, None] == other] = np.inf
            for i in range(len(ids)):
                some = np.flatnonzero(near[i] <= np.partition(near[i], min(k, len(other)) - 1)[min(k, len(other)) - 1])[:k]
                merged = [np.concatenate(x) for x in zip(best[i], (near[i][some], other[some], those[some]))]
                top = np.lexsort((merged[1], merged[0]))[:k]
                best[i] = tuple(m[top] for m in merged)
        for i in range(len(ids)):
            found = np.isfinite(best[i][0])
            yield pa.record_batch(
                [pa.array(np.full(found.sum(), i, np.int32)), pa.array(best[i][0][found]), pa.array(list(best[i][2][found]), pa.list_(pa.float64()))],
                names=["trial", "far", "vec"],
            )

    all_best = rows.mapInArrow(search_all, "trial int, far double, vec array<double>")
    turn = F.row_number().over(Window.partitionBy("trial").orderBy("far"))
    found = all_best.withColumn("turn", turn).where(F.col("turn") <= k).toArrow()  # TRIALS times k rows
    if not found.num_rows:
        return 1.0
    trial, those = found.column("trial").to_numpy(), _matrix(found.column("vec").combine_chunks())
    apart = _distances(vectors, index.centroids.astype(float))
    row, lists = assign(those.astype(np.float32), index)
    needed = np.full(len(those), np.inf)
    np.minimum.at(needed, row, apart[trial[row], lists])
    return float(np.quantile(np.sqrt(needed / np.maximum(apart.min(axis=1)[trial], 1e-12)), PROBED)) + 1e-6


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of the vectors that take part: of the commonest length, finite, not zero, with an id."""
    vec = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(
        "vec_id IS NOT NULL AND vec IS NOT NULL"
        " AND FORALL(vec, x -> x IS NOT NULL AND NOT ISNAN(x) AND ABS(x) < DOUBLE('Infinity'))"
        " AND EXISTS(vec, x -> x != 0)"
    )
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (common.n if common else 0))


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _dealt(rows: DataFrame, kind: str, find) -> DataFrame:
    """(list, id, vec): the rows repeated for each list that ``find`` names, in steps of bounded size."""

    def deal(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, lists = find(_matrix(part.column(1)))
                row = pa.array(row)
                yield pa.record_batch(
                    [pa.array(lists, pa.int32()), part.column(0).take(row), part.column(1).take(row)],
                    names=["list", kind, "vec"],
                )

    return rows.mapInArrow(deal, f"list int, {kind} long, vec array<double>")


def _best(k: int):
    """The ``k`` nearest postings of each query of one part; own rows left out, ties to the smaller id."""

    def best(key, queries: pa.Table, postings: pa.Table) -> pa.Table:
        found = ([], [], [])
        if queries.num_rows and postings.num_rows:
            asked, ids = queries.column("query_id").to_numpy(), postings.column("vec_id").to_numpy()
            q, rows = (_matrix(t.column("vec").combine_chunks()) for t in (queries, postings))
            for at in range(0, len(q), 64):
                near = _distances(q[at : at + 64], rows)
                near[asked[at : at + 64, None] == ids] = np.inf
                least = min(k, len(ids)) - 1
                limit = np.partition(near, least, axis=1)[:, least]
                slack = 1e-9 * ((q[at : at + 64] ** 2).sum(axis=1) + (rows**2).sum(axis=1).max())
                for i in range(len(near)):
                    some = np.flatnonzero((near[i] <= limit[i] + slack[i]) & np.isfinite(near[i]))
                    exact = np.sqrt(((rows[some] - q[at + i]) ** 2).sum(axis=1))
                    top = np.lexsort((ids[some], exact))[:k]
                    found[0].append(np.full(len(top), asked[at + i]))
                    found[1].append(ids[some][top])
                    found[2].append(exact[top])
        columns = [np.concatenate(x) if x else np.zeros(0) for x in found]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c).cast(t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    return best


def nearest(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each vector where ``queries`` holds.

    ``queries`` is a condition on vec_id. Score is the Euclidean distance in double precision. Vectors
    that are null, zero, of an uncommon length, or that hold null or non-finite components take no part,
    nor do rows without id. Rows that share an id are one candidate, at their nearest, and one query. An
    empty table gives no rows; a query without candidates has none; other columns are ignored.
    """
    rows = store(usable(vectors, id_col, vector_col))
    total = rows.count()
    width = len(rows.select("vec").first().vec) if total else 1
    most = max(SAMPLE_BYTES // (8 * width), 1)
    spot = F.pmod(F.xxhash64("vec_id", F.lit("index")), F.lit(1 << 30))
    sample = rows.where(spot < int(min(1.0, most / max(total, 1)) * (1 << 30))).limit(2 * most).orderBy("vec_id")
    found = sample.select("vec").toArrow().column("vec").combine_chunks()
    sampled = _matrix(found).astype(np.float32) if len(found) else np.zeros((1, width), np.float32)
    index = build(sampled, min(max(total // LIST_ROWS, 1), MOST_LISTS))

    ratio = calibrate(rows, index, k)
    postings = store(_dealt(rows, "vec_id", lambda m: assign(m.astype(np.float32), index)))
    sizes = np.zeros(len(index.centroids), np.int64)
    for list_, n in postings.groupBy("list").count().collect():  # a row for each list, MOST_LISTS at most
        sizes[list_] = n
    asked = rows.where(queries).withColumnRenamed("vec_id", "query_id")
    probes = store(_dealt(asked, "query_id", lambda m: search(m.astype(np.float32), index, sizes, ratio)))
    busy = probes.groupBy("list").count().withColumnRenamed("count", "asked")
    full = postings.groupBy("list").count().withColumnRenamed("count", "held")
    parts = busy.join(full, "list").select(
        "list",
        F.ceil(F.col("held") / PART_ROWS).cast("int").alias("row_parts"),
        F.ceil(F.col("asked") / PART_QUERIES).cast("int").alias("query_parts"),
    )
    parts = F.broadcast(store(parts))  # a row for each list, MOST_LISTS at most
    spot_of = lambda name, n: F.pmod(F.xxhash64(name), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = postings.join(parts, "list").select(
        "list", spot_of("vec_id", "row_parts").alias("row_part"), each("query_parts").alias("query_part"), "vec_id", "vec"
    )
    sought = probes.join(parts, "list").select(
        "list", each("row_parts").alias("row_part"), spot_of("query_id", "query_parts").alias("query_part"), "query_id", "vec"
    )
    keys = ["list", "row_part", "query_part"]
    near = sought.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
        _best(k), "query_id long, vec_id long, score double"
    )
    once = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
