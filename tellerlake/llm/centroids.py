"""Clustering around centroids in exact integers, filtered by n-simplex projection.

Distances of a vector to a few pivots place it as the apex of a simplex over them: a few coordinates that are
computed once and stored. For two such apexes the distance of the points is at least that of the apexes, and at
most that with one altitude turned over. Every round these bounds leave a few centroids a vector, which are then
compared exactly, in integers; so rounding can cost time but never changes a result, and sums don't depend on the
order of rows or tasks.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerlake.llm.tables import store, table

#: Integers up to this size have squared distances over 64 components within 63 bits; larger ones are compared as
#: Python's, which have no bound.
NARROW = 1 << 27
#: Sums go to Spark in digits of so many bits, so that adding them up never overflows.
DIGIT = 40
#: Relative error allowed to the bounds, far above that of their arithmetic.
SLACK = 1e-6
#: A pivot nearer to the flat of those before it than this share of its distance is not used.
FLAT = 1e-3


def as_integers(values: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of doubles, exactly: 64-bit integers, or Python's where one does not fit ``NARROW``."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * 1024.0)
    if not scaled.size or np.abs(scaled).max() <= NARROW:
        return scaled.astype(np.int64)
    # Doubles from 2 ** 53 on are whole numbers, and 1024 times them may not be one.
    exact = [int(x) * 1024 if abs(x) >= 2.0**53 else math.floor(x * 1024) for x in values.ravel().tolist()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(values.shape)


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to an integer point."""
    wide = object if object in (rows.dtype, point.dtype) or _widest(point) > NARROW else np.int64
    apart = rows.astype(wide) - point.astype(wide)
    return (apart * apart).sum(axis=1)


def _widest(point: np.ndarray) -> int:
    return max((abs(int(x)) for x in point.tolist()), default=0)


class Simplex:
    """Pivots, and the coordinates of the simplex that they span."""

    def __init__(self, candidates: list[np.ndarray]):
        self.pivots: list[np.ndarray] = []
        self.base = np.zeros((0, 0))
        for pivot in sorted(candidates, key=_widest):
            if self.pivots:
                apex = self.apexes(pivot[None, :])[0]
                if not np.isfinite(apex).all() or apex[-1] <= FLAT * max(np.linalg.norm(apex), 1.0):
                    continue
                grown = np.zeros((len(self.pivots) + 1, len(self.pivots)))
                grown[:-1, : self.base.shape[1]] = self.base
                grown[-1] = apex
            else:
                grown = np.zeros((1, 0))
            self.pivots.append(pivot)
            self.base = grown

    def apexes(self, rows: np.ndarray) -> np.ndarray:
        """Coordinates of each row: its place over the pivots' flat, then its altitude, which is not negative.

        Distances beyond what a double holds give coordinates that are no numbers, which rule nothing out.
        """
        to = np.stack([_as_doubles(squared(rows, pivot)) for pivot in self.pivots], axis=1)
        side = self.base[1:]
        with np.errstate(invalid="ignore", over="ignore"):
            right = (to[:, :1] + (side * side).sum(axis=1) - to[:, 1:]) / 2
            flat = np.linalg.solve(side, right.T).T if len(side) else right
            altitude = np.sqrt(np.maximum(to[:, 0] - (flat * flat).sum(axis=1), 0.0))
        return np.concatenate([flat, altitude[:, None]], axis=1)


def _as_doubles(values: np.ndarray) -> np.ndarray:
    if values.dtype != object:
        return values.astype(np.float64)
    return np.array([float(v) if v < 1 << 1000 else np.inf for v in values.tolist()])


def may_be_nearest(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids (columns) the bounds leave to each row."""
    with np.errstate(invalid="ignore", over="ignore"):
        scale = (apexes * apexes).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None, :]
        flat = apexes[:, None, :-1] - centroids[None, :, :-1]
        flat = (flat * flat).sum(axis=2)
        high, low = apexes[:, -1:], centroids[None, :, -1]
        least = flat + (high - low) ** 2 - SLACK * scale
        most = flat + (high + low) ** 2 + SLACK * scale
        return ~(least > most.min(axis=1)[:, None])


def nearest(rows: np.ndarray, apexes: np.ndarray, centroids: list[np.ndarray], corners: np.ndarray):
    """Number of the nearest centroid and exact squared distance of each row; of equals the smaller number."""
    left = may_be_nearest(apexes, corners)
    wide = rows.dtype == object or any(_widest(c) > NARROW for c in centroids)
    number = np.full(len(rows), -1)
    distance = np.zeros(len(rows), object if wide else np.int64)
    for k, centroid in enumerate(centroids):
        at = np.flatnonzero(left[:, k])
        found = squared(rows[at], centroid)
        closer = (number[at] < 0) | (found < distance[at])
        number[at[closer]] = k
        distance[at[closer]] = found[closer]
    return number, distance


def digits(value: int) -> list[int]:
    """A whole number in digits of ``DIGIT`` bits, the lowest first, all of its sign."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value or not out:
        out.append(sign * (value & ((1 << DIGIT) - 1)))
        value >>= DIGIT
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def kept(vectors: DataFrame, components: int) -> DataFrame:
    """(vec_id, embedding) of the vectors with so many components, none of them null or not finite."""
    finite = "FORALL(embedding, x -> x IS NOT NULL AND ABS(x) < DOUBLE('Infinity') AND NOT ISNAN(x))"
    return vectors.select("vec_id", "embedding").where(f"SIZE(embedding) = {components} AND {finite}")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[np.ndarray]:
    """The k vectors with the smallest digests of seed and id. Each of 256 parts gives its first k before they meet."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("vec_id").cast("string")), 256)
    order = Window.partitionBy("part").orderBy("digest", "embedding")
    first = (
        vectors.withColumn("digest", digest)
        .withColumn("part", F.substring("digest", 1, 2))
        .withColumn("turn", F.row_number().over(order))
        .where(F.col("turn") <= k)
    )
    rows = first.orderBy("digest", "embedding").limit(k).collect()
    return [as_integers(np.array(row.embedding, np.float64)) for row in rows]


def moved(rows: DataFrame, centroids: list[np.ndarray], simplex: Simplex) -> list[np.ndarray]:
    """The centroids after one round: each the floor of its vectors' mean, or where it was without any.

    A task returns a count and sums per centroid; Spark adds them up, so what reaches the driver depends on the
    number of centroids and components only.
    """
    width = len(centroids[0])
    corners = simplex.apexes(np.stack(centroids))

    def summed(batches):
        counts, sums = [0] * len(centroids), [[0] * width for _ in centroids]
        for batch in batches:
            values = as_integers(_matrix(batch.column("embedding"), width))
            number, _ = nearest(values, _matrix(batch.column("apex"), corners.shape[1]), centroids, corners)
            for k in range(len(centroids)):
                mine = values[number == k]
                if len(mine):
                    counts[k] += len(mine)
                    sums[k] = [a + int(b) for a, b in zip(sums[k], mine.sum(axis=0))]
        out = [(k, -1, 0, counts[k]) for k in range(len(centroids))]
        out += [
            (k, i, place, digit)
            for k in range(len(centroids))
            for i, value in enumerate(sums[k])
            for place, digit in enumerate(digits(value))
        ]
        names = ["centroid", "component", "place", "digit"]
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*out), [pa.int32()] * 3 + [pa.int64()])], names)

    parts = rows.select("embedding", "apex").mapInArrow(summed, "centroid int, component int, place int, digit long")
    totals = parts.groupBy("centroid", "component", "place").agg(F.sum("digit").alias("digit")).collect()
    value = [dict.fromkeys(range(-1, width), 0) for _ in centroids]
    for row in totals:
        value[row.centroid][row.component] += row.digit << (DIGIT * row.place)
    out = []
    for k, centroid in enumerate(centroids):
        count = value[k][-1]
        mean = [value[k][i] // count for i in range(width)] if count else centroid.tolist()
        out.append(np.array(mean, np.int64 if max(map(abs, mean)) <= NARROW else object))
    return out


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, components: int = 64, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that is kept.

    Vectors that are null, of other length, or hold a null or a component that is not finite are left out. Repeated
    rows count as often as they come, and get equal results; ids may be null. With fewer than k vectors each is a
    centroid; equal ones share the smallest number. Without any vector there are no rows. Components may be of any
    size: a squared distance or a sum of them beyond 63 bits is null, the clusters are exact all the same. Other
    columns are ignored.
    """
    spark = vectors.sparkSession
    whole = kept(vectors, components)
    kind = whole.schema["vec_id"].dataType.simpleString()
    result = f"vec_id {kind}, cluster int, distance long"
    centroids = first_centroids(whole, k, seed)
    if not centroids:
        shape = f"{result}, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], shape)
    simplex = Simplex(centroids)

    def projected(batches):
        for batch in batches:
            apexes = simplex.apexes(as_integers(_matrix(batch.column("embedding"), components)))
            flat = pa.array(apexes.ravel())
            offsets = pa.array(np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1])
            yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "embedding", "apex"])

    stored_as = whole.schema["embedding"].dataType.simpleString()
    rows = store(whole.mapInArrow(projected, f"vec_id {kind}, embedding {stored_as}, apex array<double>"))
    for _ in range(rounds):
        centroids = moved(rows, centroids, simplex)
    corners = simplex.apexes(np.stack(centroids))

    def assigned(batches):
        for batch in batches:
            values = as_integers(_matrix(batch.column("embedding"), components))
            number, distance = nearest(values, _matrix(batch.column("apex"), corners.shape[1]), centroids, corners)
            fits = [int(d) if d < 1 << 63 else None for d in distance.tolist()]
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(fits, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    found = store(rows.mapInArrow(assigned, result))
    exact = "SUM(CAST(distance AS DECIMAL(38,0)))"
    sums = found.groupBy("cluster").agg(F.expr(f"IF(COUNT(distance) = COUNT(*), {exact}, NULL) AS total")).collect()
    of_cluster = {row.cluster: None if row.total is None else int(row.total) for row in sums}
    whole_sum = None if None in of_cluster.values() else sum(of_cluster.values())
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]

    def fitting(total):
        return total if total is not None and total < 1 << 63 else None

    per_cluster = [(n, fitting(total), fitting(whole_sum), digest[n]) for n, total in of_cluster.items()]
    named = spark.createDataFrame(
        per_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of ``embeddings`` in eight clusters after ten rounds."""
    return cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, components=64, seed=3)


def oracle(k: int = 8, rounds: int = 10, components: int = 64, seed: int = 3) -> str:
    """The same in DuckDB's SQL: every vector against every centroid, component by component."""
    text = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: cast(x AS double)) AS e
  FROM embeddings WHERE len(embedding) = {components}),
whole AS MATERIALIZED (
  SELECT * FROM kept WHERE len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = {components}),
parts AS MATERIALIZED (
  SELECT rid, vec_id, i, cast(floor(1024 * e[i]) AS bigint) AS x FROM whole, range(1, {components + 1}) r(i)),
seeds AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('{seed}:' || cast(vec_id AS varchar)), e) - 1 AS c FROM whole
  ORDER BY c LIMIT {k}),
c_0 AS MATERIALIZED (SELECT c, i, x FROM seeds JOIN parts USING (rid))"""
    for n in range(rounds + 1):
        text += f""",
a_{n} AS MATERIALIZED (
  SELECT rid, c, d FROM (
    SELECT rid, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS turn FROM (
      SELECT p.rid, q.c, cast(sum((p.x - q.x) * (p.x - q.x)) AS bigint) AS d
      FROM parts p JOIN c_{n} q USING (i) GROUP BY p.rid, q.c) all_pairs) ranked WHERE turn = 1)"""
        if n < rounds:
            text += f""",
m_{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a_{n} JOIN parts USING (rid) GROUP BY c, i),
c_{n + 1} AS MATERIALIZED (
  SELECT c, i, coalesce(cast(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS bigint), x) AS x
  FROM c_{n} LEFT JOIN m_{n} USING (c, i))"""
    return text + f""",
digests AS (SELECT c, sha256(string_agg(cast(x AS varchar), ',' ORDER BY i)) AS h FROM c_{rounds} GROUP BY c)
SELECT vec_id, cast(c AS int) AS cluster, d AS distance,
       cast(sum(d) OVER (PARTITION BY c) AS bigint) AS cluster_inertia, cast(sum(d) OVER () AS bigint) AS inertia,
       h AS centroid_sha256
FROM a_{rounds} JOIN whole USING (rid) JOIN digests USING (c)"""
