"""Centroid clustering (Lloyd rounds) by Walsh-Hadamard progressive search.

Vectors of 64 components become integers. The Walsh-Hadamard transform keeps
distances up to the factor 64 and is exact on integers, so the squared
differences of coefficients, taken coarse to fine (few sign changes first),
add up to exact distances, and any partial sum is a lower bound. After each
group of coefficients, centroids whose partial sum is above the finished
distance of the leading one are strictly worse and go; the others are finished
over all 64 coefficients. Ties go to the smaller number.

A round is one pass: assignment and exact sums by cluster in the task, one
partial row per (centroid, component) to the shuffle, and the centroids (their
number is a parameter) to the driver.

Defined results: vectors that are null, hold null or non-finite values or have
another number of components are dropped, and so are vectors with an integer
beyond 2**27, whose distances might not fit a long. Null ids are kept; they
start a centroid only if there are fewer other vectors than centroids. Rows
that repeat count each, and may start a centroid each (equal hashes are ordered
by vector). With fewer vectors than centroids, each vector starts one. An empty
table gives no rows. Columns besides ``vec_id`` and ``embedding`` are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import stored
from hvault.llm.vectors import scaled

WIDTH = 64
SCALE, BOUND = 256, 1 << 27
CENTROIDS, ROUNDS = 40, 5
STEPS = (4, 12, 16, 32)  # coefficients added at a time
ZERO = 1 << 31
BLOCK = 2048  # rows searched together
FLOAT = 1 << 16  # up to here, double arithmetic on transformed integers is exact


def walsh(width: int = WIDTH) -> np.ndarray:
    """Hadamard matrix with its rows in order of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < width:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, exact squared distance) of each row of ``x``."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(x) > BLOCK:
        parts = [nearest(x[i : i + BLOCK], centroids) for i in range(0, len(x), BLOCK)]
        return tuple(np.concatenate(p) for p in zip(*parts))
    exact = float if max(np.abs(x).max(), np.abs(centroids).max()) <= FLOAT else object  # Python integers beyond
    h = walsh().astype(exact)
    a, b = x.astype(exact) @ h.T, centroids.astype(exact) @ h.T
    row, cen = np.repeat(np.arange(len(x)), len(b)), np.tile(np.arange(len(b)), len(x))
    at = STEPS[0]
    # the coarsest coefficients of all pairs as one product
    part = ((a[:, :at] ** 2).sum(axis=1)[:, None] + (b[:, :at] ** 2).sum(axis=1) - 2 * (a[:, :at] @ b[:, :at].T)).reshape(-1)
    lead = part.reshape(len(x), -1).argmin(axis=1)
    best = ((a - b[lead]) ** 2).sum(axis=1)  # the leading centroid's finished distance
    for step in (*STEPS[1:], 0):
        stay = part <= best[row]
        row, cen, part = row[stay], cen[stay], part[stay]
        if step:
            part = part + ((a[row, at : at + step] - b[cen, at : at + step]) ** 2).sum(axis=1)
            at += step
    # of the survivors, all finished, the least; the smaller number among equals
    distance = (part // WIDTH).astype(np.int64)
    order = np.lexsort((cen, distance, row))
    row, cen, distance = row[order], cen[order], distance[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    return cen[first], distance[first]


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors as 32-bit integers, moved up by 2**31 and big-endian, so that bytes sort as vectors do."""

    def run(it):
        for batch in it:
            x, at = scaled(batch.column("embedding"), WIDTH, SCALE, BOUND)
            raw = [r.tobytes() for r in (x + ZERO).astype(">u4")]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), pa.array(raw, pa.binary())], names=["vec_id", "v"])

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, v binary")


def numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">u4").reshape(-1, WIDTH).astype(np.int64) - ZERO


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("v")
    if not len(column):
        return np.zeros((0, WIDTH), np.int64)
    return numbers(b"".join(column.to_pylist()))


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes, in that order."""
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "v").select("v").limit(k).collect()
    return numbers(b"".join(r["v"] for r in rows))


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means of their vectors; empty ones stay."""

    def run(it):
        sums, counts = np.zeros(centroids.shape, object), np.zeros(len(centroids), np.int64)
        for batch in it:
            x = matrix(batch)
            cluster, _ = nearest(x, centroids)
            order = np.argsort(cluster, kind="stable")
            met, first, n = np.unique(cluster[order], return_index=True, return_counts=True)
            if len(met):
                sums[met] += np.add.reduceat(x[order], first, axis=0).astype(object)
                counts[met] += n
        met = np.flatnonzero(counts)
        columns = [np.repeat(met, WIDTH), np.tile(np.arange(WIDTH), len(met)), np.repeat(counts[met], WIDTH), sums[met].reshape(-1).astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cluster", "dim", "n", "total"])

    parts = vectors.select("v").mapInArrow(run, "cluster long, dim long, n long, total long")
    parts = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for r in parts.collect():  # at most one row per centroid and component
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def fit_centroids(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of ``whole_vectors`` rows after the rounds."""
    centroids = first_centroids(vectors, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of ``whole_vectors`` rows."""

    def run(it):
        for batch in it:
            cluster, distance = nearest(matrix(batch), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    The sums are exact; one beyond a long is null."""
    spark = embeddings.sparkSession
    vectors = stored(whole_vectors(embeddings), "vectors")
    centroids = fit_centroids(vectors, k, rounds)
    rows = stored(assigned(vectors, centroids), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {r["cluster"]: int(r["total"]) for r in rows.groupBy("cluster").agg(total).collect()}  # one row per centroid
    fits = lambda v: v if v < 1 << 63 else None
    everything = fits(sum(sums.values()))
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(c, fits(s), everything, sha[c]) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``cluster_vectors``: plain distances to all centroids, round by round."""
    apart = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"""kept AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, cluster := cluster)) AS best
  FROM (SELECT row, vec_id, v, cluster, CAST({apart} AS BIGINT) AS d FROM kept CROSS JOIN c{r}) GROUP BY row)"""
        )
        if r < rounds:
            parts.append(
                f"""m{r} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS c
  FROM (SELECT cluster, dim, sum(v[dim]) AS s, count(*) AS n
        FROM (SELECT best.cluster AS cluster, v, unnest(range(1, {WIDTH + 1})) AS dim FROM a{r}) GROUP BY cluster, dim)
  GROUP BY cluster)"""
            )
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, best.cluster AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(list_transform(c, lambda x: CAST(x AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.cluster = best.cluster"""


CLUSTER_SQL = cluster_sql()
