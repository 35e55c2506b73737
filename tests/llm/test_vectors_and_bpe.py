"""op11, op12 and op13 against brute force, SQL and the tokenizers library."""

import hashlib
import math
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from cases import CLASHING, awkward_documents, frame
from tokenizers import Tokenizer

from hvault.llm import bpe_codec, centroids, whitening

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TABLES = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def awkward_vectors(width=64, n=130, seed=3):
    """(vec_id, embedding): ties, repeated rows, nulls, other lengths, non-finite and huge components."""
    rng = random.Random(seed)
    rows = [(i * 7 - 20, [rng.uniform(-0.5, 0.5) * (1 + j % 5) for j in range(width)]) for i in range(n)]
    rows += [(500 + i, list(rows[3][1])) for i in range(12)] + [rows[5], rows[5], (rows[6][0], rows[7][1])]
    whole = rows[0][1]
    bad = [None, [], whole[:-1], whole + [0.0], [None, *whole[1:]], [math.nan, *whole[1:]], [math.inf, *whole[1:]], [-math.inf, *whole[1:]], [1e300, *whole[1:]]]
    return rows + [(900 + i, v) for i, v in enumerate(bad)] + [(None, rows[9][1]), (None, None)]


def vectors(spark, rows, more=("label", "cluster", "n", "v", "row", "distance")):
    schema = "vec_id long, embedding array<double>" + "".join(f", {c} string" for c in more)
    return spark.createDataFrame([(i, v, *["x" for _ in more]) for i, v in rows], schema).repartition(4)


# op11


@pytest.mark.parametrize("d, kind", [(1, "any"), (5, "any"), (64, "any"), (64, "equal"), (64, "falling"), (64, "cluster"), (40, "rank 2"), (150, "any")])
def test_contour_integration_equals_eigh(d, kind):
    rng = np.random.default_rng(d)
    values = {
        "any": np.sort(rng.random(d))[::-1],
        "equal": np.ones(d),
        "falling": 10.0 ** -np.arange(d),
        "cluster": np.array(([5.0] * 7 + [4.999999999] * 4 + list(rng.random(d)))[:d]),
        "rank 2": np.array([3.0, 2.0] + [0.0] * d)[:d],
    }[kind]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, v = whitening.leading(a, 8)
    norm = values[0]
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1][:8]).max() < 1e-14 * norm * d
    assert np.abs(a @ v - v * found).max() < 1e-14 * norm * d and np.abs(v.T @ v - np.eye(len(found))).max() < 1e-13


def test_inertia_counts():
    a = np.diag([5.0, 4, 3, 3, 1, 0, -2])
    diagonal, off = whitening.tridiagonal(a)
    assert whitening.inertia(diagonal, off, np.array([-3.0, -1, 0.5, 2, 3.5, 6])).tolist() == [0, 1, 2, 3, 5, 7]


def test_missed_eigenvalues_are_an_error():
    with pytest.raises(RuntimeError, match="of 3 eigenvalues"):
        whitening.feast(np.diag([5.0, 4, 1, 0.5]), 3.5, 6.0, 3, 5.0)


def plain_whitening(rows, width):
    good = [(i, v) for i, v in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) and abs(c) < 1e9 for c in v)]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in good])
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vec = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    return [i for i, _ in good], x, n, s, centred @ vec[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize("width", [64, 3])
def test_whiten_equals_plain(spark, width):
    rows = awkward_vectors(width)
    got = whitening.whiten(vectors(spark, rows)).collect()
    ids, x, n, s, w, explained = plain_whitening(rows, width)
    k = min(8, width)
    assert len(got) == len(ids) * k and {r.n for r in got} == {n}
    dev = sorted((str(i), sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))) for i, row in zip(ids, x) for _ in range(k))
    assert sorted((str(r.vec_id), r.deviation) for r in got) == dev
    assert all(int(r.deviation_exact) == r.deviation for r in got)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10
    for c in range(1, k + 1):
        mine = sorted((str(r.vec_id), r.deviation, r.whitened) for r in got if r.component == c)
        ref = sorted((str(i), d, v) for i, d, v in zip(ids, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x], w[:, c - 1]))
        sign = np.sign(sum(a[2] * b[2] for a, b in zip(mine, ref)))
        assert max(abs(a[2] - sign * b[2]) for a, b in zip(mine, ref)) < 1e-8
        assert [r.explained for r in got if r.component == c] == pytest.approx([explained[c - 1]] * len(ids))


def test_whiten_without_variance_and_empty(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0]), (3, [1.0])])).collect() == []
    line = whitening.whiten(vectors(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])])).collect()
    assert {r.component for r in line} == {1} and sorted(abs(round(r.whitened, 9)) for r in line) == [0.0, pytest.approx(1.5**0.5), pytest.approx(1.5**0.5)]


def test_deviation_beyond_a_long():
    x = np.array([[100_000 + (1 << 50), 100_000], [100_000, 99_000]])
    sums = [int(v) for v in x.sum(axis=0)]
    assert whitening.deviations(x, 2, sums) == [sum((2 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    small = np.array([[5, 7], [-3, 8]])
    assert whitening.deviations(small, 3, [2, 15]) == [205, 202]


def test_wide_deviation_column(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert all(r.deviation is None and int(r.deviation_exact) > 1 << 63 for r in got)


# op13


def plain_clusters(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) and abs(c) < 1e5 for c in v)]
    ordered = sorted(kept, key=lambda r: (r[0] is None, sha(f"2:{r[0]}"), r[1]))
    cents = [v for _, v in ordered[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cents = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else old for j, old in enumerate(cents)]
    out = [(i, *near(v)) for i, v in kept]
    inertia = {}
    for _, d, j in out:
        inertia[j] = inertia.get(j, 0) + d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, cents[j])))) for i, d, j in out), key=str)


@pytest.mark.parametrize("n, k", [(130, 40), (10, 40), (130, 1), (130, 500)])
def test_clusters_equal_plain(spark, n, k):
    rows = awkward_vectors(n=n)
    got = centroids.cluster_vectors(vectors(spark, rows), k).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_clusters(rows, k)


def test_progressive_search_is_exact():
    rng = np.random.default_rng(1)
    assert (centroids.walsh() @ centroids.walsh().T == 64 * np.eye(64)).all()
    for top in (3, 500, 1 << 16, 1 << 27):  # small numbers tie often, large ones need Python integers
        x, c = rng.integers(-top, top + 1, (300, 64)), rng.integers(-top, top + 1, (11, 64))
        c[7] = c[2]
        x[:20] = c[7]
        d = [[sum((int(p) - int(q)) ** 2 for p, q in zip(a, b)) for b in c] for a in x]
        cluster, distance = centroids.nearest(x, c)
        assert cluster.tolist() == [row.index(min(row)) for row in d] and distance.tolist() == [min(row) for row in d]


def test_clusters_of_nothing(spark):
    assert centroids.cluster_vectors(vectors(spark, [])).collect() == []
    assert centroids.cluster_vectors(vectors(spark, [(1, None), (2, [0.0] * 63)])).collect() == []


def test_clusters_equal_sql(spark):
    df = spark.read.parquet(f"{TABLES}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{TABLES}/embeddings.parquet')")
    exp = con.execute(centroids.CLUSTER_SQL).fetchall()
    assert sorted(tuple(r) for r in centroids.cluster_vectors(df).collect()) == sorted(exp)


# op12


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_trie_equals_library(library):
    c, rng = bpe_codec.Codec(VOCABULARY), random.Random(1)
    letters = "  \n\t\x1c\x85  aebtheion,.é①\x00日本語😀0123<>².\"　​՘꟎\U00010940\U0001c000's't|﻿"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(3000)]
    texts += [" " * k for k in range(40)] + ["a" * k for k in range(0, 3000, 97)] + ["the" * 5000, " " * 100_000, "ab" * 30_000, "\n" * 50_000, "日" * 20_000, ""]
    texts += ["<|endoftext|>", "x<|endoftext|> <|endoftext|><|endoftext|>\n <|endoftext", "<|endoftext|> y"]
    pieces = [b.decode("utf-8", "ignore") for b in c.bytes]
    texts += ["".join(rng.choice(pieces) for _ in range(3)) for _ in range(20_000)]
    ref = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for step in (len(texts), 700):  # as one batch, and from the cache
        got = [i for k in range(0, len(texts), step) for i in c.encode(texts[k : k + step])]
        assert got == ref
    assert all(c.decode(i) == library.decode(i, skip_special_tokens=False) for i in ref)


def test_cuts_equal_library(library):
    c = bpe_codec.Codec(VOCABULARY)
    for k in [*range(0, 0x3400), *range(0xA000, 0xD800), *range(0xE000, 0x11500, 3), *range(0x16000, 0x110000, 41)]:
        s = f"a{chr(k)}1{chr(k)}.{chr(k)}" if not 0xD800 <= k < 0xE000 else ""
        assert c.cut(s) == [s[i:j] for _, (i, j) in library.pre_tokenizer.pre_tokenize_str(s)], hex(k)


def test_decode_any_ids(library):
    c, rng = bpe_codec.Codec(VOCABULARY), random.Random(2)
    for _ in range(2000):
        ids = [rng.randrange(50_300) for _ in range(rng.randint(0, 30))]
        assert c.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cache_stays_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe_codec, "CACHE", 50)
    c = bpe_codec.Codec(VOCABULARY)
    texts = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(100)] * 2
    assert [c.encode([t])[0] for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert max(len(c.chunks.new), len(c.chunks.old), len(c.met.new), len(c.met.old)) < 50 + 21


def test_prefixes_are_computed_once(monkeypatch):
    c = bpe_codec.Codec(VOCABULARY)
    looked = []

    class Counted(dict):
        def get(self, key, default=None):
            looked.append(key)
            return dict.get(self, key, default)

    c.lengths = Counted(c.lengths)
    c.trie([b"internation", b"international", b"internationally", b"inter"])
    assert len(looked) == len(b"internationally") - 2  # one look-up per node below the second byte


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        bpe_codec.Codec(public_tokenizers.path("word_bpe_49k.json"))


def test_codec_rows(spark, library):
    rows = awkward_documents()
    got = bpe_codec.codec_digest(frame(spark, rows, CLASHING), VOCABULARY).collect()
    exp = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        exp.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted((tuple(r) for r in got), key=str) == sorted(exp, key=str)
    assert bpe_codec.codec_digest(frame(spark, []), VOCABULARY).count() == 0


def test_bad_utf8_is_replaced(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    assert bpe_codec.encode_documents(df, VOCABULARY).first().decoded == "a�b"
