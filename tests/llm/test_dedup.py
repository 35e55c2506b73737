"""op1, op2 and op8 against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import CLASHING, awkward_documents, frame

from hvault.llm import embedding_neardup, exact_dedup, simhash
from hvault.llm.common import connected_components


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (201, 200), (200, 202), (202, 201)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    exp = components({x for e in edges for x in e}, edges)
    assert got == exp


@pytest.mark.parametrize("held", [2, 20_000])
def test_exact(spark, monkeypatch, held):
    monkeypatch.setattr(exact_dedup, "HELD_ROWS", held)
    rows = awkward_documents()
    got = exact_dedup.dedup_exact(frame(spark, rows, CLASHING), salts=3).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    exp = []
    for t, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        exp += [(d, keep, len(ids), d == keep, hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    assert sorted((tuple(r) for r in got), key=str) == sorted(exp, key=str)
    assert exact_dedup.dedup_exact(frame(spark, [])).count() == 0


@pytest.mark.parametrize("tasks", [1, 3])
def test_copies_are_dealt_over_salts(spark, monkeypatch, tasks):
    """Flushes of one task, too, bring copies of a text to different salts; salts grow with the tasks."""
    monkeypatch.setattr(exact_dedup, "HELD_ROWS", 10)
    docs = spark.range(400).selectExpr("id AS doc_id", "CAST('same' AS binary) AS text").repartition(tasks)
    rows = docs.mapInArrow(exact_dedup.local_winners(20), "digest binary, salt int, content binary, least long, ids array<long>")
    per_salt = [r["count"] for r in rows.groupBy("salt").count().collect()]
    assert len(per_salt) >= 16 and max(per_salt) <= 3  # 40 to 42 flushes
    out = exact_dedup.dedup_exact(docs.repartition(121)).collect()  # 11 salts
    assert len(out) == 400 and {(r.keep_id, r.group_size) for r in out} == {(0, 400)}


def test_exact_digest_collision(monkeypatch):
    """Different contents under one digest stay apart in every step."""
    rows = [(b"d", 0, b"one", 1, [1]), (b"d", 0, b"two", 2, [2]), (b"d", 0, b"one", 3, [3])]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["digest", "salt", "content", "least", "ids"])
    out = [r for b in exact_dedup.salted_winners([batch]) for r in b.to_pylist()]
    assert [(r["class"], r["least"], r["content"]) for r in out] == [(0, 1, b"one"), (1, 2, b"two"), (0, 1, None)]
    met = pa.RecordBatch.from_pylist([dict(digest=b"d", salt=s, **{"class": 0}, least=m, n=2, content=c) for s, m, c in ((0, 1, b"one"), (1, 4, b"two"), (2, 5, b"one"))])
    out = [(r["salt"], r["keep"], r["total"]) for b in exact_dedup.global_winners([met]) for r in b.to_pylist()]
    assert sorted(out) == [(0, 1, 4), (1, 4, 2), (2, 1, 4)]


def test_exact_sql(spark):
    rows = [r for r in awkward_documents() if r[0] is not None]
    con = duckdb.connect()
    documents = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows])})  # noqa: F841
    exp = sorted(con.sql(exact_dedup.EXACT_SQL).fetchall())
    assert sorted(tuple(r) for r in exact_dedup.dedup_exact(frame(spark, rows)).collect()) == exp


def test_drop_copies(spark):
    rows = awkward_documents()
    out = exact_dedup.drop_copies(frame(spark, rows, CLASHING)).collect()
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in out]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(spark):
    rows = awkward_documents()
    got = simhash.dedup_simhash(frame(spark, rows, CLASHING)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    links = [(a, b) for a in set(fps) for b in set(fps) if a < b and (a ^ b).bit_count() <= 3]
    part = components(set(fps), links)
    least = {}
    for (d, _), f in zip(rows, fps):
        if d is not None:
            least[part[f]] = min(d, least.get(part[f], d))
    exp = sorted(((d, f"{f:016x}", least.get(part[f])) for (d, _), f in zip(rows, fps)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == exp
    assert simhash.dedup_simhash(frame(spark, [])).count() == 0
    kept = simhash.drop_near_copies(frame(spark, rows)).collect()
    assert {r.doc_id for r in kept} == {d for d, _, c in exp if d == c}


@pytest.mark.parametrize("shard", [8, 4096])
@pytest.mark.parametrize("wish", [1, 64])
def test_near_links(spark, monkeypatch, shard, wish):
    """All links within the radius are joined, also when shards are cut into several trees and more blocks are chosen."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard)
    monkeypatch.setattr(simhash, "WISH_ROWS", wish / 4096)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for f in base.tolist():
        for _ in range(12):
            for bit in rng.integers(0, 64, rng.integers(1, 5)).tolist():
                f ^= 1 << bit
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long"), len(fps)).collect()
    links = [(signed[i], signed[j]) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    assert components(signed, [tuple(e) for e in edges]) == components(signed, links)


def test_bk_tree():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 12, 500, dtype=np.uint64)
    tree = rng.integers(0, 7, 500)
    order = np.argsort(tree, kind="stable")
    fp, tree = fp[order], tree[order]
    q, node = simhash.Forest(fp, tree).search(fp, tree, 2)
    exp = {(i, int(fp[j])) for i in range(500) for j in range(500) if tree[i] == tree[j] and (int(fp[i]) ^ int(fp[j])).bit_count() <= 2}
    assert {(i, int(fp[j])) for i, j in zip(q.tolist(), node.tolist())} == exp


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    out, k = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            base = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 5))):
                out.append((k, (base + rng.standard_normal(16) * 0.2 * rng.random()).astype(np.float32).tolist(), label))
                k += 1
    out += [(k + i, out[3][1], 0) for i in range(5)] + [(k + 9, [2 * x for x in out[3][1]], 0)]
    out += [(k + 10, None, 0), (k + 11, [0.0] * 16, 0), (k + 12, [float("nan")] * 16, 0), (k + 13, [None] + [1.0] * 15, 0), (k + 14, [1.0, 2.0], 0), (k + 15, [], 0), (k + 16, [float("inf")] * 16, 1), (None, out[3][1], 0)]
    return out


@pytest.mark.parametrize("bucket,block,width", [(1024, 1024, None), (8, 6, None), (1024, 16, 4.0)])
def test_embeddings(spark, bucket, block, width):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string")
    got = embedding_neardup.dedup_embeddings(df, width=width, bucket=bucket, block=block).select("vec_id", "n_links", "component_id", "kept").collect()

    def good(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    links = []
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if good(a) and good(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                    links.append((a[0], b[0]))
    part = components([r[0] for r in rows if r[0] is not None], links)
    n = {}
    for a, b in links:
        n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    exp = [(r[0], n.get(r[0], 0), part.get(r[0]), r[0] is not None and part[r[0]] == r[0]) for r in rows]
    assert links and sorted((tuple(r) for r in got), key=str) == sorted(exp, key=str)


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_neardup.dedup_embeddings(df).count() == 0


def test_estimates_lose_nothing():
    """With the default width no pair above the threshold is dropped, and pairs linked by bounds alone are above it."""
    rng = np.random.default_rng(4)
    x = embedding_neardup.unit(np.repeat(rng.standard_normal((60, 32)), 5, axis=0) + 0.35 * rng.standard_normal((300, 32)))
    i, j = embedding_neardup.linked(x, x, 0.93, None)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(v.tolist() for v in np.nonzero(x @ x.T >= 0.93))))


def test_table_plan():
    for n in (10, 1024, 1025, 10**6, 10**9):
        bits, tables = embedding_neardup.table_plan(n, 0.93)
        together = (1 - np.arccos(0.93) / np.pi) ** bits
        assert (1 - together) ** tables <= embedding_neardup.MISS and n / 2**bits <= embedding_neardup.BUCKET
