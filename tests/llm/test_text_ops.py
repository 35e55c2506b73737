"""op6, op7, op9 and op10 against the libraries, brute force and held-out labels."""

import base64
import bz2
import gzip
import hashlib
import math
import random
import re
import time
import urllib.parse
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from cases import CLASHING, awkward_documents, frame
from tokenizers import Tokenizer

from hvault.llm import packing, quality_classifier, secret_scan
from hvault.llm.sentencepiece_codec import Agenda, codec_digest, encode_documents

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# op7


def test_agenda_equals_library():
    agenda, rng = Agenda(PIECES), random.Random(1)
    letters = '  \n\t▁aebtheion,.é①\x00日本語😀0123<>²."　​'
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(4000)]
    texts += [" " * k for k in range(40)] + ["a" * k for k in range(0, 3000, 97)] + ["<s>", "<0x0A>", "▁▁x", "the" * 5000]
    ids, agrees = agenda.encode(texts, check=True)
    assert ids == agenda.library.encode(texts, num_threads=1) and all(agrees) and not agenda.wrong


def test_check_finds_and_repairs_other_ids(monkeypatch):
    agenda = Agenda(PIECES)
    monkeypatch.setattr(agenda, "together", lambda chunks: [(5,)] * len(chunks))
    texts = ["the thing", "ab c", "  x", "the"]
    ids, agrees = agenda.encode(texts, check=True)
    assert ids == agenda.library.encode(texts, num_threads=1) and not any(agrees)


@pytest.mark.parametrize("check", ["chunks", "whole", "none"])
def test_codec(spark, check):
    rows = awkward_documents()
    got = codec_digest(frame(spark, rows, CLASHING), PIECES, check).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    exp = []
    for d, t in rows:
        ids = sp.encode(t or "")
        exp.append((d, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)), True))
    assert sorted((tuple(r) for r in got), key=str) == sorted(exp, key=str)
    assert codec_digest(frame(spark, []), PIECES).count() == 0


def test_round_trip_without_check(spark):
    out = encode_documents(frame(spark, [(1, "The thing, ① and 日本\n x"), (2, None)]), PIECES, check="none").orderBy("doc_id").collect()
    assert out[0].decoded == "The thing, ① and 日本\n x" and out[1].ids == []


# op9


def check_packing(rows, pieces, window=1024):
    """Every token of every row lies in one piece, sequences are gapless and need no padding."""
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for group in sequences.values():
        at = 0
        for p in sorted(group, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)
    exp, got = {}, {}
    for d, t in rows:
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        exp[d, len(ids)] = exp.get((d, len(ids)), 0) + len(ids)
        if len([r for r in rows if r[0] == d]) == 1:
            mine = sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start)
            assert [p.start for p in mine] == np.cumsum([0, *[p.length for p in mine[:-1]]]).tolist()
            assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in mine)
    for p in pieces:
        got[p.doc_id, p.doc_tokens] = got.get((p.doc_id, p.doc_tokens), 0) + p.length
    assert got == exp
    return len(sequences)


def test_packing(spark):
    rows = awkward_documents() + [(900, "a <|endoftext|> b"), (901, "it's 12,5% \r\n\n  x"), (902, "<|endoftext|>")]
    pieces = packing.pack_documents(frame(spark, rows, CLASHING), RANKS).collect()
    check_packing(rows, pieces)
    assert packing.pack_documents(frame(spark, []), RANKS).count() == 0


def test_packing_small_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 4)
    rows = [(d, t if t is None else t[:3000]) for d, t in awkward_documents(n=30)]
    check_packing(rows, packing.pack_documents(frame(spark, rows), RANKS, window=64).collect(), window=64)


def test_index_is_bm25():
    docs = [np.array(x) for x in ([1, 2, 2, 3], [2, 5], [3, 3, 3, 1], [7], [2, 3])]
    size = sum(map(len, docs)) / len(docs)
    for q in range(len(docs)):
        exp = []
        for d in docs:
            s = 0.0
            for t in set(docs[q].tolist()):
                tf, df = (d == t).sum(), sum(t in x for x in docs)
                s += np.log1p((len(docs) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / size))
            exp.append(s)
        assert np.allclose(packing.Index(docs).scores(q), exp, atol=1e-5)


def test_neighbours_share_windows():
    """Two topics: a seed is followed by documents of its own topic."""
    rng = np.random.default_rng(0)
    docs = [rng.integers(100 * (i % 2), 100 * (i % 2) + 40, 50) for i in range(20)]
    order = packing.chain(docs, 0, 1000)
    assert sorted(order) == list(range(20)) and sum(a % 2 != b % 2 for a, b in zip(order, order[1:])) == 1


def plain_chain(docs, fill, window, stats=None):
    """Greedy chain by plain BM25 sums over the ids of whole documents; each step gives the scores of all unused documents, too."""
    df = {}
    for d in docs:
        for t in set(d):
            df[t] = df.get(t, 0) + 1
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    if stats:
        df, n, mean = {t: stats[0][t] for d in docs for t in d}, stats[1], stats[2]

    def score(q, d):
        s = 0.0
        for t in set(docs[q]):
            f = docs[d].count(t)
            s += math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))
        return s

    order, seed, room, steps = [0], 0, -(fill + len(docs[0])) % window, [None]
    while len(order) < len(docs):
        best = order[-1]
        steps.append({d: score(seed, d) for d in range(len(docs)) if d not in order})
        best = yield steps[-1]
        order.append(best)
        if len(docs[best]) >= room:
            room, seed = -(len(docs[best]) - room) % window, best
        else:
            room -= len(docs[best])
            if len(order) == len(docs):
                return


@pytest.mark.parametrize("n, longest, common, whole", [(60, 30, 12, False), (300, 60, 2, False), (300, 60, 1000, True), (40, 400, 12, True)])
def test_chain_equals_plain_search(monkeypatch, n, longest, common, whole):
    monkeypatch.setattr(packing, "COMMON", common)
    rng = np.random.default_rng(n)
    docs = [np.append((rng.zipf(1.3, rng.integers(0, longest)) % 500 + 1), 0).astype(np.uint16) for _ in range(n)]
    docs[5] = docs[9]
    stats = None
    if whole:  # statistics of a larger table
        stats = (np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=1 << 16) * 3 + 1, 5 * n, 21.5)
    order = packing.chain(docs, 7, 100, stats)
    assert sorted(order) == list(range(n))
    plain = plain_chain([d.tolist() for d in docs], 7, 100, stats)
    scores = next(plain)
    for place, got in enumerate(order[1:], 1):
        best = max(scores.values())
        assert scores[got] >= best - 1e-4 * max(best, 1), place
        if place < n - 1:
            scores = plain.send(got)


def test_packing_statistics_are_the_whole_tables(spark):
    rows = [(bytearray(np.array(d, "<u2").tobytes()),) for d in ([1, 1, 2, 0], [2, 0], [0], [2, 3, 0])]
    df = packing.document_frequencies(spark.createDataFrame(rows, "ids binary").repartition(3))
    assert df[:4].tolist() == [4, 1, 3, 1] and df.sum() == 9


def test_long_runs_of_white_space(spark):
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.encoder(RANKS)
    for text in (" " * 300_000 + " a" + "\n" * 400_000 + " x", " " * 3000, "a" + " " * 600 + "b", "\n" * 700 + " x" + "\t " * 400, "a" + " " * 499 + "b", " \u3000" * 300 + "é", "x" + "\n" * 500):
        assert packing.ids_of(enc, text).tolist() == tk.encode(text, add_special_tokens=False).ids
    rows = [(1, " " * 1_000_000), (2, "a" + "\n" * 1_000_000 + "b")]
    pieces = packing.pack_documents(frame(spark, rows), RANKS).collect()
    assert {p.doc_id for p in pieces} == {1, 2} and all(p.length <= 1024 for p in pieces)


# op10

BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def plain_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, (p, g, n)) in enumerate(BASE.items()) for m in p.finditer(text) if len(m[g]) >= n]
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found))


SECRETS = [
    "token=token: abcdefgh", "TOKEN = 'abcdef'", "ſecret=abcdefgh", "api_key:abc12", "apiKey\": \"abc123", "password=secret=abcdef token:xyz", "AKIA" + "A" * 16, "AKIA" + "B" * 15,
    "AKIAAKIA" + "C" * 14, "deadbeef" * 3, "deadbeef" * 2, "passwd:   =abcdef", "a" * 24 + "g" + "0" * 30, "é token = 'abcdefg' 日本", "secret :abcdef",
]


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(SECRETS)] + [(100, " | ".join(SECRETS))] + [(200 + (d or 0), t) for d, t in awkward_documents(n=30)]
    for r in secret_scan.find_secrets(frame(spark, rows, CLASHING)).collect():
        text = next(t for d, t in rows if d == r.doc_id) or ""
        if sum(d == r.doc_id for d, _ in rows) == 1:
            base = plain_spans(text)
            assert r.base_sha256 == sha(base) and set(base.split(",")) <= set(r.spans.split(",")), text
            assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in base.split(",")) for k in BASE)
    assert secret_scan.find_secrets(frame(spark, [])).count() == 0


PLAIN = "password = hunter2222"


def percent(t):
    return "".join(f"%{b:02X}" for b in t.encode())


def escaped(t):
    return "".join(f"\\u{ord(c):04x}" for c in t)


def b64(t):
    return base64.b64encode(t if isinstance(t, bytes) else t.encode()).decode()


@pytest.mark.parametrize(
    "hidden",
    [percent(PLAIN), urllib.parse.quote(PLAIN), percent(percent(PLAIN)), escaped(PLAIN), escaped(percent(PLAIN)), b64(PLAIN), b64(b64(PLAIN)), b64(gzip.compress(PLAIN.encode(), mtime=0)),
     b64(zlib.compress(PLAIN.encode())), b64(zstandard.compress(PLAIN.encode())), percent(b64(gzip.compress(escaped(b64(PLAIN)).encode(), mtime=0))), b64("x" * 80 + percent("\n" + PLAIN)), base64.urlsafe_b64encode(("~~~???" + PLAIN).encode()).decode()],
)
def test_layers(hidden):
    text = f"é 日本 {hidden} end %zz \\u12 %41"
    base, spans = secret_scan.all_spans(text)
    found = [(s, e) for s, k, e in spans if k == 0 and (s, k, e) not in base]
    assert found and all(4 <= 5 <= s and e <= 5 + len(hidden) for s, e in found)
    assert "hunter" not in secret_scan.masked(text) and secret_scan.masked(text).startswith("é 日本 ")
    assert secret_scan.masked(secret_scan.masked(text)) == secret_scan.masked(text)


def wrapped(data, width):
    t = b64(data)
    return "\n".join(t[i : i + width] for i in range(0, len(t), width))


def noise(n):
    return random.Random(n).randbytes(n)


@pytest.mark.parametrize("width", [48, 64, 76, 100])
def test_short_last_line(width):
    for n in range(150, 150 + 3 * width):
        text = "x " * ((n - len(PLAIN)) // 2) + PLAIN
        hidden = wrapped(text, width)
        assert secret_scan.masked(f"<{hidden}>") == "<[REDACTED]>", (width, n)
    for pack in (gzip.compress, zlib.compress, bz2.compress, zstandard.compress):
        hidden = wrapped(pack(noise(300).hex().encode() + b" zz " + PLAIN.encode()), width)
        assert any(k == 0 for _, k, _ in secret_scan.all_spans(f"<{hidden}>")[1])


def test_lines_before_and_streams_under_each_other():
    def kinds(text):
        return {k for _, k, _ in secret_scan.all_spans(text)[1]}

    body = noise(200).hex().upper().encode() + b" " + PLAIN.encode()
    other = base64.b64encode(noise(48)).decode()  # a line of 64 columns
    for width in (64, 65, 76):
        for pack in (gzip.compress, zlib.compress, bz2.compress, zstandard.compress):
            for before in (other, other + "A", other + "A" * 12):
                assert 0 in kinds(before + "\n" + wrapped(pack(body), width)), (width, pack, before)
    for pack in (gzip.compress, zlib.compress, bz2.compress, zstandard.compress):
        two = pack(b"nothing") + pack(b"here") + pack(body)
        assert 0 in kinds(b64(two)) and 0 in kinds(wrapped(two, 76))
        full = next(x for x in (pack(noise(n).hex().upper().encode()) for n in range(57, 400)) if len(x) % 57 == 0)
        assert 0 in kinds(wrapped(full, 76) + "\n" + wrapped(pack(body), 76))


def literal(data):
    return repr(data)[2:-1]


@pytest.mark.parametrize(
    "inner",
    [c + PLAIN for c in "\u00a0\u3000\ufeff\u200b\f\x1b\x00"] + [PLAIN.encode(e) for e in ("utf-16", "utf-16-le", "utf-16-be", "utf-32")]
    + [("é " + PLAIN).encode("latin-1"), "日本 ".encode() + b"\xff " + PLAIN.encode(), "é日 ".encode("utf-16-le") + PLAIN.encode("utf-16-le")],
)
def test_any_text_inside(inner):
    hidden = b64(inner)
    assert (0, 0, len(hidden)) in secret_scan.all_spans(hidden)[1]
    packed = b64(gzip.compress(inner if isinstance(inner, bytes) else inner.encode(), mtime=0))
    assert (0, 0, len(packed)) in secret_scan.all_spans(packed)[1]


@pytest.mark.parametrize("pack", [lambda d: gzip.compress(d, mtime=0), zlib.compress, bz2.compress, zstandard.compress])
def test_compressed_bytes_elsewhere(pack):
    data = pack(b"xyz " * 5 + PLAIN.encode())
    deep = data
    for _ in range(40):
        deep = pack(deep)
    quoted = [urllib.parse.quote(data), urllib.parse.quote_plus(data), "".join(f"%{b:02x}" for b in data), literal(data), "".join(f"\\x{b:02x}" for b in data), "".join(f"\\u{b:04x}" for b in data), b64(deep)]
    for hidden in quoted:
        text = f"é 日本 {hidden}"
        got = [(s, e) for s, k, e in secret_scan.all_spans(text)[1] if k == 0]
        assert (5, len(text)) in got, hidden
        assert secret_scan.masked(text + " the rest of the line") == "é 日本 [REDACTED] the rest of the line"


def test_plain_line_of_the_same_width_before():
    line = base64.b64encode(noise(48)).decode()
    assert 0 in {k for _, k, _ in secret_scan.all_spans(line + "\n" + wrapped("xyz " * 11 + PLAIN, 64))[1]}


def test_exact_origin_of_characters():
    text = "x " + escaped("pass") + "word" + percent("=hunter22") + " y"
    assert secret_scan.all_spans(text)[1] == [(2, 0, len(text) - 2)]


def test_cycles():
    assert secret_scan.all_spans("%25" * 50 + "41")[1] == []
    assert secret_scan.all_spans("\\ud83d\\ude00 \\udc00 %ff%fe")[1] == []


@pytest.mark.parametrize("nest", [lambda t: t.replace("%", "%25"), lambda t: t.replace("\\", "\\x5c"), lambda t: t.replace("\\", "\\u005c"), lambda t: t.replace("%", "\\x25").replace("\\", "%5c")])
@pytest.mark.parametrize("levels", [1, 5, 8, 9, 10, 17, 300])
def test_levels_of_escapes(nest, levels):
    text = "password" + ("%3D" if "%" in nest("%") and "x25" not in nest("%") else "\\x3D" if "x" in nest("\\") else "\\u003D")
    for _ in range(levels if len(nest(nest(text))) < 40 else min(levels, 10)):
        text = nest(text)
    text = f"é {text}hunter2222 end"
    assert (2, 0, len(text) - 4) in secret_scan.all_spans(text)[1]


@pytest.mark.parametrize("hidden", ["%" + "25" * 50_000 + "3D", "%3" * 50_000 + "D", "\\x5c" + "x5c" * 33_000 + "x3D", "%5cx25" * 2 + "5cx25" * 20_000 + "3D", "%2" + "%3" * 50_000 + "53D"])
def test_nested_escapes_take_linear_time(hidden):
    began = time.process_time()
    spans = secret_scan.all_spans(f"password{hidden}hunter2222")[1]
    assert time.process_time() - began < 10
    if hidden.startswith(("%25", "\\x5cx5c")):
        assert (0, 0, len(hidden) + 18) in spans


def test_settled_equals_level_by_level():
    rnd = random.Random(5)
    for _ in range(300):
        text = "".join(rnd.choice(["%", "%25", "2", "5", "%3", "\\x5c", "\\", "x", "\\u00", "41", "u005c", "z", "%5c", "%34%31"]) for _ in range(rnd.randrange(1, 14)))
        settled = secret_scan.Layer(text).settled()
        assert settled.settled().text == settled.text and secret_scan.escape_at_end(list(settled.text)) == 0
        assert len(settled.first) == len(settled.end) == len(settled.text) and settled.first == sorted(settled.first)
        if settled.text:
            assert settled.first[0] == 0 and settled.end[-1] == len(text) and settled.first[1:] == settled.end[:-1]


@pytest.mark.parametrize("pack", [zlib.compress, gzip.compress, bz2.compress, zstandard.compress])
def test_streams_in_windows(monkeypatch, pack):
    monkeypatch.setattr(secret_scan, "WINDOW", 1000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 100)
    for at in (*range(880, 1030, 7), 5000, 20_000):
        for secret, kind in ((PLAIN, 0), ("password" + " " * 3000 + "=" + " " * 3000 + "hunter2222", 0), ("AKIA" + "Z" * 16, 1), ("deadbeef" * 3, 2), ("0123456789abcdef" * 400, 2)):
            hidden = b64(pack((noise(at).hex().upper()[:at] + " " + secret + " ").encode()))
            _, spans, cuts = secret_scan.every_span(hidden)
            assert (0, kind, len(hidden)) in spans, (at, secret[:9])
            assert cuts == ([(0, len(hidden))] if at > 1000 or len(secret) > 1000 else cuts)
            assert all(k < 3 for _, k, _ in spans)
    bomb = b64(pack(b"a " * 200_000))
    assert secret_scan.all_spans(bomb)[1] == [] and secret_scan.masked(bomb) == bomb


def test_redaction_keeps_columns(spark):
    df = frame(spark, [(1, "a token = abcdefgh b"), (2, None), (3, "clean")], CLASHING)
    out = {r.doc_id: r for r in secret_scan.redact_secrets(df).collect()}
    assert secret_scan.redact_secrets(df).columns == df.columns
    assert (out[1].text, out[1].n_chars, out[2].text, out[3].text) == ("a [REDACTED] b", 14, None, "clean")


# op6


def test_classifier_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{TEXTS}/documents.parquet"), spark.read.parquet(f"{TEXTS}/labels.parquet")
    rows = quality_classifier.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    good, bad = np.array([r.score for r in held if r.quality == 1]), np.array([r.score for r in held if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97 and np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows)


def test_classifier_does_not_see_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{TEXTS}/documents.parquet"), spark.read.parquet(f"{TEXTS}/labels.parquet")
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality_classifier.score_documents(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_classifier.score_documents(docs.withColumn("lang", F.lit("x")).drop("source"), turned).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_classifier_awkward(spark):
    rows = awkward_documents()
    docs = frame(spark, rows, CLASHING)
    labels = spark.createDataFrame([(i * 3, i % 2, 0) for i in range(40)] + [(0, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality_classifier.score_documents(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    for empty in (labels.limit(0), labels.where("quality = 1")):
        assert {(r.score, r.predicted) for r in quality_classifier.score_documents(docs, empty).collect()} == {(0.5, 1)}
        assert quality_classifier.keep_good(docs, empty).count() == len(rows)
    assert quality_classifier.score_documents(frame(spark, []), labels).count() == 0
    assert quality_classifier.keep_good(docs, labels).columns == docs.columns


def test_fit_equals_plain_one(spark):
    """Means, priors and shrunk covariances against NumPy on the same rows; the scores of both agree."""
    rng = np.random.default_rng(4)
    k = len(quality_classifier.NAMES)
    x = rng.standard_normal((90, k)) @ rng.standard_normal((k, k)) + 5
    x[:, 3] = 2.5  # a statistic that never varies
    y = np.arange(90) % 3 // 2
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "x array<double>, quality int").repartition(4)
    model = quality_classifier.fit(rows, 0.3, 0.2)
    spread = np.where(np.ptp(x, axis=0) > 0, x.std(axis=0), 1.0)
    z = (x - x.mean(axis=0)) / spread
    assert np.allclose(model.centre, x.mean(axis=0)) and np.allclose(model.scale, spread)
    within = sum(np.cov(z[y == c].T, bias=True) * (y == c).mean() for c in (0, 1))
    parts = []
    for c, (log_prior, mean, inverse, log_det) in zip((0, 1), model.classes):
        cov = 0.7 * np.cov(z[y == c].T, bias=True) + 0.3 * within
        cov = 0.8 * cov + 0.2 * np.diag(np.diag(cov) + 0.1)
        assert np.isclose(log_prior, np.log((y == c).mean())) and np.allclose(mean, z[y == c].mean(axis=0))
        assert np.allclose(inverse.T @ inverse, np.linalg.inv(cov)) and np.isclose(2 * log_det, np.linalg.slogdet(cov)[1])
        away = z - z[y == c].mean(axis=0)
        parts.append(np.log((y == c).mean()) - 0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)))
    assert np.allclose(model.log_odds(x), parts[1] - parts[0])


def test_log_odds_equal_gaussian_densities():
    rng = np.random.default_rng(0)
    k = len(quality_classifier.NAMES)
    classes, covs = [], []
    for c in (0, 1):
        a = rng.standard_normal((k, k))
        cov = a @ a.T + np.eye(k)
        f = np.linalg.cholesky(cov)
        classes.append((np.log(0.5), rng.standard_normal(k), np.linalg.inv(f), np.log(np.diag(f)).sum()))
        covs.append(cov)
    x = rng.standard_normal((9, k))
    got = quality_classifier.Model(np.zeros(k), np.ones(k), classes).log_odds(x)
    dens = [-0.5 * (np.linalg.slogdet(c)[1] + np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)) for (_, m, _, _), c in zip(classes, covs)]
    assert np.allclose(got, dens[1] - dens[0])
