"""Embedding near-deduplication with randomised-rotation binary codes.

Vectors with equal, non-null labels and equal length are linked when their
cosine (double precision) is at least ``threshold``. Equal vectors are combined
first. Candidates meet in buckets: a bucket key is a group of sign bits of a
randomly rotated vector, and each vector enters several tables. Bits and
tables are chosen per label from its number of vectors: one bucket holds the
whole label up to ``BUCKET`` vectors (an exact search); beyond that a pair at
the threshold meets in no table with probability below ``MISS``, and closer
pairs far more rarely. Buckets over ``BLOCK`` rows are cut into blocks, and
pairs of blocks are compared in tasks of bounded size.

In a task a vector x is held as its binary code (the signs of the rotated
vector) with the stored correction factor f = <code, x>. <code, q> / f is an
unbiased estimate of <x, q>, and its error is at most
sqrt(1 - c^2) sqrt(1 - f^2) / f * min(1, width / sqrt(d - 1)), where c is the
true value: with the default width this bound holds always, smaller widths
make it a confidence bound. Pairs whose upper bound is below the threshold are
dropped; pairs whose lower bound is above it are linked; for the others the
cosine is computed again in double precision.

A task returns one link count per vector and a spanning forest of the links it
found, never pairs; a pair that meets in several tables counts in the first.

Defined results: vectors that are null, zero or hold null or non-finite
components, vectors with a null label and rows with a null vec_id link with
nothing (component_id = vec_id). Rows that share a vec_id count as vectors of
their own. Columns besides ``vec_id``, ``embedding`` and ``label`` are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import connected_components, stored
from hvault.llm.simhash import forest_edges

THRESHOLD = 0.93
BUCKET = 1024  # vectors of a label wished for in a bucket
BLOCK = 1024  # vectors compared with as many others in one task
MISS = 1e-4
SEED = 7


def rotation(dim: int, number: int) -> np.ndarray:
    """The number-th random rotation of ``dim`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def table_plan(n: int, threshold: float, bucket: int = BUCKET) -> tuple[int, int]:
    """Sign bits of a bucket key and number of tables for ``n`` vectors."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / bucket)))
    if not bits:
        return 0, 1
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - together))


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def linked(x: np.ndarray, y: np.ndarray, threshold: float, width: float | None) -> np.ndarray:
    """Pairs (i, j) of unit rows of x and y with cosine >= threshold: estimates from y's codes, exact where the bounds leave it open."""
    dim = x.shape[1]
    turn = rotation(dim, 0)
    qx, ry = x @ turn.T, y @ turn.T
    code = np.where(ry >= 0, 1.0, -1.0) / math.sqrt(dim)
    f = np.einsum("ij,ij->i", code, ry)  # stored correction factors
    est = (qx.astype(np.float32) @ code.T.astype(np.float32)) / f.astype(np.float32)
    spread = np.sqrt(np.maximum(1 - f * f, 0)) / f * (1.0 if width is None or dim < 2 else min(1.0, width / math.sqrt(dim - 1)))
    slack = 1e-4  # single precision of the estimate
    low = threshold - math.sqrt(1 - threshold * threshold) * spread - slack
    i, j = np.nonzero(est >= low.astype(np.float32)[None, :])
    e, s = est[i, j].astype(np.float64) - slack, spread[j]
    # smallest true value that gives this estimate: c + sqrt(1 - c^2) s = e
    sure = (e - s * np.sqrt(np.maximum(1 + s * s - e * e, 0))) / (1 + s * s) >= threshold + 1e-9
    sure &= e <= 1
    open_ = np.flatnonzero(~sure)
    keep = sure.copy()
    for at in range(0, len(open_), 1 << 16):
        k = open_[at : at + (1 << 16)]
        keep[k] = np.einsum("ij,ij->i", x[i[k]], y[j[k]]) >= threshold
    return np.stack([i[keep], j[keep]])


def dedup_embeddings(embeddings: DataFrame, threshold: float = THRESHOLD, width: float | None = None, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: see the module's description."""
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("v"))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are one value
    rows = stored(rows.withColumn("usable", usable).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))), "vectors")
    good = rows.where("usable").withColumn("key", F.struct("label", "v"))
    reps = good.groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    reps = stored(reps.select("id", "copies", "key.label", F.size("key.v").alias("dim"), "key.v"), "vectors")

    # bucket keys of every table
    sizes = reps.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))

    def keys(it):
        turns: dict = {}
        for batch in it:
            out_id, out_tables = [], []
            for i, n, dim, v in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "dim", "v"))):
                bits, tables = table_plan(n, threshold, bucket)
                if not bits:
                    out_tables.append([0])
                else:
                    need = math.ceil(bits * tables / dim)
                    while len(turns.setdefault(dim, [])) < need:
                        turns[dim].append(rotation(dim, 1 + len(turns[dim])))
                    signs = np.concatenate([t @ np.asarray(v) for t in turns[dim][:need]])[: bits * tables].reshape(tables, bits) >= 0
                    out_tables.append((signs @ (1 << np.arange(bits))).tolist())
                out_id.append(i)
            cols = [batch.column(c) for c in ("id", "copies", "label", "dim", "v")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out_tables, pa.list_(pa.int64()))], names=["id", "copies", "label", "dim", "v", "tables"])

    keyed = reps.join(sizes, ["label", "dim"]).select("id", "copies", "label", "dim", "v", "n")
    label_type = reps.schema["label"].dataType.simpleString()
    keyed = stored(keyed.mapInArrow(keys, f"id long, copies long, label {label_type}, dim int, v array<double>, tables array<long>"), "keyed")
    spots = keyed.select("*", F.posexplode("tables").alias("t", "value"))
    count = spots.groupBy("label", "dim", "t", "value").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("m"))
    placed = spots.join(stored(count, "buckets"), ["label", "dim", "t", "value"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("m")).cast("int"))
    meet = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).select(
        "label", "dim", "t", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "copies", "v", "tables"
    )

    def compare(key, data):
        t, first, second = key[2].as_py(), key[4].as_py(), key[5].as_py()
        data = data.combine_chunks()
        own, ids, copies = (data.column(c).to_numpy() for c in ("own", "id", "copies"))
        x = unit(np.asarray(data.column("v").combine_chunks().flatten()).reshape(len(ids), -1))
        tables = np.asarray(data.column("tables").combine_chunks().flatten()).reshape(len(ids), -1)
        a, b = np.flatnonzero(own == first), np.flatnonzero(own == second)
        i, j = linked(x[a], x[b], threshold, width)
        i, j = a[i], b[j]
        if first == second:
            i, j = i[i < j], j[i < j]
        once = ~(tables[i, :t] == tables[j, :t]).any(axis=1)  # pairs that met in an earlier table were counted there
        i, j = i[once], j[once]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        some = np.flatnonzero(links)
        root_of = dict(zip(*(z.tolist() for z in forest_edges(ids[i], ids[j])))) if len(i) else {}
        return pa.table({"id": ids[some], "links": links[some], "root": pa.array([root_of.get(v, v) for v in ids[some].tolist()], pa.int64())})

    found = stored(meet.groupBy("label", "dim", "t", "value", "i", "j").applyInArrow(compare, "id long, links long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("id <> root"), "id", "root")
    # ids are the smallest of their copies, so the smallest id of a component is its smallest vec_id
    done = reps.select("id", "copies", F.struct("label", "v").alias("key")).join(links, "id", "left").join(parts, F.col("id") == F.col("node"), "left")
    done = done.select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    good = good.select("vec_id", "key").join(stored(done, "classes"), "key").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
