"""SimHash near-deduplication with sharded BK-trees.

Fingerprint: texts with A-Z lower-cased are cut into words
``[^\\x20\\x09-\\x0D]+`` and word shingles (repeats included, joined by a space;
fewer words: the whole sequence; none: fingerprint zero). A bit is 1 when it is
set in over half of the shingles' XXH64 values (UTF-8, seed 42).

Links: two fingerprints that differ in at most ``radius`` bits agree on some
``blocks - radius`` of ``blocks`` bit blocks (pigeonhole). Every choice of that
many blocks gives each distinct fingerprint a shard key; a shard holds the
fingerprints of one key, so each linked pair meets in a shard. ``blocks`` is
chosen from the number of distinct fingerprints so that shards stay small.
In a shard, fingerprints form BK-trees (children keyed by integer Hamming
distance to the parent), and a query follows only edges whose distance lies
within the radius of its own distance to the node. A shard over
``SHARD_ROWS`` fingerprints is cut into several trees; each such tree, at most
``SHARD_ROWS`` nodes, is copied to all query blocks of its shard. Every search
batch returns a spanning forest of the links it found (at most one edge per
fingerprint), and connected components join the forests.

Defined results: null text has no words; a null doc_id takes part only through
its copies: its row comes back with the component of its fingerprint; equal
rows are equal documents. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import connected_components, stored

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD_ROWS = 4096
WISH_ROWS = 64  # rows wished for in a shard


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # ASCII letters and white space only, as bytes
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        parts = [line]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-1].tolist()]
        parts = [line[a:b] for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(p, SEED) for p in parts], np.uint64, len(parts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""

    def run(it):
        for batch in it:
            fp = [fingerprint(t.as_buffer().to_pybytes(), shingle) if t.is_valid else 0 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(fp, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


class Forest:
    """BK-trees over fingerprints, one for each tree number, as a child table (node, distance) -> node."""

    def __init__(self, fp: np.ndarray, tree: np.ndarray):
        self.fp = fp
        n = len(fp)
        self.child = np.full((n, 65), -1, np.int32)
        trees, root = np.unique(tree, return_index=True)
        self.trees, self.root = trees, root
        at = root[np.searchsorted(trees, tree)]
        live = np.flatnonzero(at != np.arange(n))
        at = at[live]
        while len(live):
            d = np.bitwise_count(fp[live] ^ fp[at]).astype(np.int64)
            slot = at * 65 + d
            # the first item that reaches an empty slot becomes the child there
            slots, first = np.unique(slot, return_index=True)
            empty = self.child.reshape(-1)[slots] < 0
            self.child.reshape(-1)[slots[empty]] = live[first[empty]]
            at = self.child.reshape(-1)[slot].astype(np.int64)
            rest = at != live
            live, at = live[rest], at[rest]

    def search(self, fp: np.ndarray, tree: np.ndarray, radius: int):
        """Pairs (query, node) within the radius; each query searches the tree of its number."""
        k = np.searchsorted(self.trees, tree)
        k[k == len(self.trees)] = 0
        q = np.flatnonzero(self.trees[k] == tree)
        node = self.root[k[q]]
        found = []
        while len(q):
            d = np.bitwise_count(fp[q] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            found.append((q[hit], node[hit]))
            nq, nn = [], []
            for step in range(-radius, radius + 1):
                e = d + step
                ok = (e >= 0) & (e <= 64)
                c = self.child[node[ok], e[ok]]
                live = c >= 0
                nq.append(q[ok][live])
                nn.append(c[live].astype(np.int64))
            q, node = np.concatenate(nq), np.concatenate(nn)
        return np.concatenate([a for a, _ in found]) if found else np.empty(0, np.int64), np.concatenate([b for _, b in found]) if found else np.empty(0, np.int64)


def forest_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) between labels as a spanning forest: each label with the least label of its component."""
    labels, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = idx[: len(a)], idx[len(a) :]
    root = np.arange(len(labels))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(labels))
    return labels[other], labels[root[other]]


def block_plan(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """Bit ranges (shift, width) of each shard key: all choices of blocks - radius out of the fewest blocks that keep shards small."""
    for blocks in range(radius + 1, radius + 9):
        edges = np.linspace(0, 64, blocks + 1).astype(int)
        bits = [(int(a), int(b - a)) for a, b in zip(edges, edges[1:])]
        plan = [list(c) for c in combinations(bits, blocks - radius)]
        least = min(sum(w for _, w in c) for c in plan)
        if n <= WISH_ROWS * 2.0**least:
            break
    return plan


def near_links(fps: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) of a spanning forest over all pairs of distinct fingerprints within ``radius`` bits.

    ``fps``: column fp, distinct; ``n``: their number."""
    plan = block_plan(n, radius)
    keys = []
    for i, choice in enumerate(plan):
        key, used = F.lit(0).cast("long"), 0
        for shift, width in choice:
            part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
            key = key.bitwiseOR(F.shiftleft(part, used))
            used += width
        keys.append(F.struct(F.lit(i).alias("choice"), key.alias("key")))
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("s")).select(F.xxhash64("s.choice", "s.key").alias("shard"), "fp")
    rows = stored(rows, "shards")
    large = stored(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_ROWS), "large")

    def edges(pairs):
        a = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, np.int64)
        b = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, np.int64)
        return forest_edges(a, b)

    def send(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def within(fp, tree, other_fp=None, other_tree=None):
        """Links of the fingerprints ``fp`` found in the forest of ``other`` (of themselves by default), as a forest."""
        forest = Forest((fp if other_fp is None else other_fp).view(np.uint64), tree if other_tree is None else other_tree)
        out: tuple = (np.empty(0, np.int64), np.empty(0, np.int64))
        for at in range(0, len(fp), 2048):
            q, node = forest.search(fp[at : at + 2048].view(np.uint64), tree[at : at + 2048], radius)
            a, b = fp[at + q], forest.fp.view(np.int64)[node]
            out = edges([out, (a[a != b], b[a != b])])
        return out

    def small_shards(it):
        """Rows sorted by shard: whole shards are gathered and searched together."""
        rest_s, rest_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in it:
            s = np.concatenate([rest_s, batch.column("shard").to_numpy(zero_copy_only=False)])
            f = np.concatenate([rest_f, batch.column("fp").to_numpy(zero_copy_only=False)])
            whole = np.searchsorted(s, s[-1]) if len(s) else 0
            if whole:
                a, b = within(f[:whole], s[:whole])
                if len(a):
                    yield send(a, b)
            rest_s, rest_f = s[whole:], f[whole:]
        if len(rest_s):
            a, b = within(rest_f, rest_s)
            if len(a):
                yield send(a, b)

    small = rows.join(large, "shard", "left_anti").repartition("shard").sortWithinPartitions("shard")
    out = small.mapInArrow(small_shards, "a long, b long")

    # hot shards: several trees, each copied to every query block of its shard
    cut = rows.join(large, "shard").withColumn("m", F.ceil(F.col("n") / SHARD_ROWS).cast("int")).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
    tree_side = cut.select("shard", "part", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("block"), F.lit(0).alias("role"), "fp")
    query_side = cut.select("shard", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part"), F.col("part").alias("block"), F.lit(1).alias("role"), "fp")
    meet = tree_side.where("block >= part").unionByName(query_side.where("block >= part"))

    def tree_meets_block(key, data):
        role, fp = data.column("role").to_numpy(), data.column("fp").to_numpy()
        t, q = fp[role == 0], fp[role == 1]
        a, b = within(q, np.zeros(len(q), np.int64), t, np.zeros(len(t), np.int64))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return out.unionByName(meet.groupBy("shard", "part", "block").applyInArrow(tree_meets_block, "a long, b long"))


def dedup_simhash(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: smallest doc_id reachable over links, itself included."""
    docs = stored(fingerprints(documents, shingle), "fingerprints")
    groups = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    parts = connected_components(near_links(groups.select("fp"), groups.count(), radius), "a", "b")
    linked = parts.join(groups, parts["node"] == groups["fp"])
    best = linked.groupBy("component").agg(F.min("least").alias("best"))
    member = linked.join(best, "component").select("fp", "best")
    labels = stored(groups.join(member, "fp", "left").select("fp", F.coalesce("best", "least").alias("component_id")), "labels")
    return docs.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group of linked fingerprints (the smallest id), with all its columns; rows that share an id go together."""
    marks = dedup_simhash(documents, shingle, radius)
    keep = marks.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id")).distinct()
    # the caller's columns travel as one struct, so no name can clash
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.alias("r").join(keep.alias("k"), F.col("r.id").eqNullSafe(F.col("k.id")), "left_semi").select("row.*")
