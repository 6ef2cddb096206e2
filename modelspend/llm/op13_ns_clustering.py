"""Centroid clustering: exact rounds of Lloyd's method that skip distances by ns-bounds.

A vector stores, for every centroid, a lower bound on its distance and the round
in which that distance was last evaluated.  The centroids of all rounds are
kept.  Since then centroid j has moved by the norm of its *total* displacement,
``|C_now[j] - C_then[j]|``, which is never more than the sum of the drifts of
the rounds between, so the stored bound is loosened by that one norm.  A
centroid whose loosened bound lies above the exact distance to the vector's own
centroid can be neither nearer nor as near; all others are evaluated exactly,
and their bounds renewed.  Assignments are therefore those of a full scan.

Vectors and bounds are whole numbers: a bound is a distance rounded down, which
keeps it a bound and the state small.  Every round is written to the shared
folder and the round before it is deleted; a lost executor costs its running
tasks only.  Tasks receive the centroid history, rounds x centroids x dimensions
numbers whatever the number of vectors, refused beyond ``HISTORY_LIMIT``.
Spark adds up the clusters with partial sums, so a cluster may hold any
share of the vectors.

Edge cases: a null vector, one of another length, or one with a null, NaN or
infinite component is left out.  Repeated rows are vectors of their own.  A null
vec_id hashes as the empty text when the first centroids are chosen and is returned
as null; equal hashes are ordered by the vectors.  With fewer vectors than
centroids, each is a centroid.  An empty table gives no rows; other columns are
ignored.  A component beyond ``LIMIT`` after scaling raises an error: squared
distances would not fit into 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.llm.shared import discard, read_table, stage

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Largest magnitude of a component; keeps squared distances within 63 bits.
LIMIT = 1 << 26
#: Most numbers in the centroid history that tasks receive (256 MB).
HISTORY_LIMIT = 1 << 25
#: Rows evaluated at once.
BLOCK = 4096

STATE = "vec_id {kind}, point array<int>, cluster int, distance bigint, bounds array<int>, seen array<tinyint>"


# ---------------------------------------------------------------- in the tasks


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows."""
    gap = points - centroids
    return np.einsum("ij,ij->i", gap, gap)


def all_squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every point to every centroid."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)), 1)
    if 4 * points.shape[1] * top * top < 1 << 53:  # then doubles hold every sum exactly
        a, b = points.astype(np.float64), centroids.astype(np.float64)
        out = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
        return out.astype(np.int64)
    return np.stack([squared(points, c[None, :]) for c in centroids], axis=1)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """For every round and centroid, the norm of its way from there to where it is now, rounded up."""
    now = history[-1]
    way = [np.sqrt(np.einsum("ij,ij->i", now - c, now - c).astype(np.float64)) for c in history]
    return np.ceil(np.stack(way) * (1 + 1e-12)).astype(np.int64)


def root_down(squares: np.ndarray) -> np.ndarray:
    """Whole-number square roots, never above the true ones."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    return root - (root * root > squares)


def first_scan(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, ...]:
    """(cluster, distance, bounds, rounds of evaluation) by evaluating everything."""
    d = all_squared(points, centroids)
    cluster = d.argmin(1)
    return cluster, d[np.arange(len(d)), cluster], root_down(d), np.zeros(d.shape, np.int8)


def rescan(
    points: np.ndarray, cluster: np.ndarray, bounds: np.ndarray, seen: np.ndarray, history: list[np.ndarray], moved: np.ndarray
) -> tuple[np.ndarray, ...]:
    """The next assignment, and the bounds renewed where a distance was evaluated."""
    now, rows = history[-1], np.arange(len(points))
    own = squared(points, now[cluster])
    loose = bounds - moved[seen, np.arange(len(now))[None, :]]
    # loose is a lower bound of a distance, so this keeps every centroid that may be as near
    suspect = (loose <= 0) | (loose * loose <= own[:, None])
    suspect[rows, cluster] = False
    i, j = np.nonzero(suspect)
    found = squared(points[i], now[j])
    bounds, seen = bounds.copy(), seen.copy()
    for r, c, d in ((rows, cluster, own), (i, j, found)):
        bounds[r, c] = root_down(d)
        seen[r, c] = len(history) - 1
    # nearest of the evaluated ones; of equally near ones the smallest number
    best, winner = own.copy(), cluster.copy()
    order = np.lexsort((j, found, i))
    i, j, found = i[order], j[order], found[order]
    first = np.ones(len(i), bool)
    first[1:] = i[1:] != i[:-1]
    i, j, found = i[first], j[first], found[first]
    better = (found < best[i]) | ((found == best[i]) & (j < winner[i]))
    best[i[better]], winner[i[better]] = found[better], j[better]
    return winner, best, bounds, seen


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * (values.shape[1] if len(values) else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def assigner(history: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One round over the stored state; with a single round of history, the first one."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = displacements(history)
        k, width = history[0].shape
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                points = matrix(block.column(1), width).astype(np.int64)
                if len(history) == 1:
                    after = first_scan(points, history[0])
                else:
                    cluster = block.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                    bounds, seen = matrix(block.column(4), k).astype(np.int64), matrix(block.column(5), k)
                    after = rescan(points, cluster, bounds, seen, history, moved)
                cluster, distance, bounds, seen = after
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), block.column(1), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()),
                     listed(bounds, pa.int32()), listed(seen, pa.int8())],
                    names=["vec_id", "point", "cluster", "distance", "bounds", "seen"],
                )

    return assign


# ------------------------------------------------------------------ the driver


def whole_points(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, point) of the vectors with exactly ``dimensions`` finite components, scaled and floored."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    fits = F.forall("point", lambda v: F.abs(v) <= LIMIT)
    kept = vectors.filter((F.size(x) == dimensions) & finite).select("vec_id", scaled.alias("point"))
    error = F.raise_error(F.lit(f"a component is beyond {LIMIT} after scaling"))
    checked = F.when(fits, F.col("point").cast("array<int>")).otherwise(error.cast("array<int>"))
    return kept.select("vec_id", checked.alias("point"))


def seeds(points: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``k`` points whose salted id hashes are smallest, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = points.select("point", F.sha2(text, 256).alias("hash")).orderBy("hash", "point").limit(k)
    return np.array([r.point for r in first.collect()], np.int64)


def means(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Floored means of the clusters; empty ones stay where they are."""
    sums = [F.sum(F.get("point", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(before.shape[1])]
    after = before.copy()
    for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        after[row[0]] = [s // row[1] for s in row[2:]]
    return after


def cluster_vectors(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector, stored, and the final centroids."""
    if k * dimensions * (rounds + 1) > HISTORY_LIMIT or rounds > 126:
        raise ValueError("the centroid history is too large to send to tasks")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("bounds", "array<int>"), ("seen", "array<tinyint>"))]
    state = stage(whole_points(vectors, dimensions, scale).select("vec_id", "point", *empty), "points")
    first = seeds(state, k, seed)
    if not len(first):
        return state.select("vec_id", "cluster", "distance"), np.zeros((0, dimensions), np.int64)
    history = [first]
    for number in range(rounds + 1):
        after = stage(state.mapInArrow(assigner(history), STATE.format(kind=kind)), "clusters")
        discard(state)
        state = after
        if number < rounds:
            history.append(means(state, history[-1]))
    return state.select("vec_id", "cluster", "distance"), history[-1]


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def by_cluster(values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster")) if values else F.lit(None).cast("string")


def op13_ns_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertias of every usable vector."""
    found, centroids = cluster_vectors(read_table(spark, sf_dir, "embeddings"))
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # one row per centroid
    sums = stage(sums, "inertia")
    total = sums.agg(F.sum("cluster_inertia")).scalar()
    sums = sums.select("cluster", "cluster_inertia", total.alias("inertia"), by_cluster([centroid_digest(c) for c in centroids]).alias("centroid_sha256"))
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


# ------------------------------------------------------------------------- SQL


def _sql() -> str:
    gap = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {DIMENSIONS})""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS j, x
  FROM (SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM kept ORDER BY h, x LIMIT {CENTROIDS}))""",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, arg_min(j, [d, j]) AS j, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT p.rid, c.j, {gap} AS d FROM kept p, c{r} c) GROUP BY rid)""")
        if r < ROUNDS:
            parts.append(f"""m{r} AS MATERIALIZED (
  SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
  FROM (SELECT a.j, i, sum(p.x[i]) AS s, count(*) AS n
        FROM a{r} a JOIN kept p USING (rid), range(1, {DIMENSIONS + 1}) t(i) GROUP BY a.j, i) GROUP BY j)""")
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (j))""")
    last = f"a{ROUNDS}"
    return f"""WITH {", ".join(parts)}
SELECT k.vec_id, a.j AS cluster, a.d AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM {last} a JOIN kept k USING (rid) JOIN c{ROUNDS} c ON c.j = a.j"""


SQL = _sql()
