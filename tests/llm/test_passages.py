"""op3 and op4 against brute force over all windows."""

import hashlib

import pytest
from cases import CLASHING, awkward_documents, frame

from hvault.llm import passages
from hvault.llm.substring_dedup import dedup_substrings, substring_digest
from hvault.llm.suffix_dedup import dedup_bytes, radix_groups, suffix_digest


def brute(rows, symbols, join, length):
    """Sorted (doc_id, size, removed, runs, sha256) of every row."""
    items = [(d, symbols((t or "").encode())) for d, t in rows]
    least = {}
    for d, x in items:
        for k in range(len(x) - length + 1) if d is not None else ():
            w = join(x[k : k + length])
            least[w] = min(d, least.get(w, d))
    out = []
    for d, x in items:
        gone = set()
        for k in range(len(x) - length + 1) if d is not None else ():
            if least[join(x[k : k + length])] < d:
                gone.update(range(k, k + length))
        kept = join([s for k, s in enumerate(x) if k not in gone])
        out.append((d, len(x), len(gone), sum(k - 1 not in gone for k in gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [1, 8192])
def test_words(spark, monkeypatch, group):
    monkeypatch.setattr(passages, "GROUP", group)
    monkeypatch.setattr(passages, "FLUSH", 300)
    rows = awkward_documents()
    got = substring_digest(frame(spark, rows, CLASHING)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    exp = [(d, n, r, h) for d, n, r, _, h in brute(rows, bytes.split, b" ".join, 50)]
    assert sorted((tuple(r) for r in got), key=str) == exp and any(r for _, _, r, _ in exp)


@pytest.mark.parametrize("group", [1, 8192])
def test_bytes(spark, monkeypatch, group):
    monkeypatch.setattr(passages, "GROUP", group)
    monkeypatch.setattr(passages, "CHUNK", 10_000)
    rows = [(d, t if t is None else t[:9000]) for d, t in awkward_documents(n=30)]
    got = suffix_digest(frame(spark, rows, CLASHING)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, bytes, bytes, 50)


def test_short_windows(spark):
    """A window as short as its anchor."""
    rows = [(d, t if t is None else t[:400]) for d, t in awkward_documents(n=20)]
    got = dedup_substrings(frame(spark, rows), length=4).select("doc_id", "n_removed").collect()
    assert sorted((tuple(r) for r in got), key=str) == [(d, r) for d, _, r, _, _ in brute(rows, bytes.split, b" ".join, 4)]


def test_spans_and_empty_table(spark):
    out = dedup_bytes(frame(spark, [(1, "a" * 60 + "b"), (2, "x" + "a" * 60)])).orderBy("doc_id").collect()
    assert [(r.n_removed, r.spans, bytes(r.kept)) for r in out] == [(0, [], b"a" * 60 + b"b"), (60, [[1, 61]], b"x")]
    assert suffix_digest(frame(spark, [])).count() == 0 and substring_digest(frame(spark, [])).count() == 0


def test_radix_groups():
    items = [b"abc", b"abcd", b"abc\0", b"abc", b"", b"", b"x" * 50, b"x" * 49 + b"y", b"x" * 50]
    g = radix_groups(items)
    assert all((g[i] == g[j]) == (items[i] == items[j]) for i in range(len(items)) for j in range(len(items)))


def test_radix_groups_hold_the_items_and_not_the_longest_for_each():
    import random
    import tracemalloc

    rng = random.Random(4)
    parts = [bytes(rng.choices(b"\0ab", k=k)) for k in (0, 1, 7, 8, 9, 16, 17, 40)]
    items = [rng.choice(parts) + rng.choice(parts) + b"\0" * rng.randrange(3) for _ in range(3000)] + [b"x" * 100_000, b"x" * 100_000, b"x" * 99_999 + b"y"]
    tracemalloc.start()
    group = radix_groups(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # as many bytes as 3,003 times the longest item would be 300 MB
    assert peak < 10_000_000
    of: dict = {}
    for x, g in zip(items, group.tolist()):
        assert of.setdefault(x, g) == g
    assert len(set(of.values())) == len(of)
    assert radix_groups([]).tolist() == []


@pytest.mark.parametrize("dedup, symbols, join", [(suffix_digest, bytes, bytes), (substring_digest, bytes.split, b" ".join)])
def test_a_sketch_in_parts_gives_the_same_rows(spark, monkeypatch, dedup, symbols, join):
    monkeypatch.setattr(passages, "MAX_CELLS", 1 << 10)
    rows = [(d, t if t is None else t[:4000]) for d, t in awkward_documents(n=30)]
    got = dedup(frame(spark, rows, CLASHING)).collect()
    exp = brute(rows, symbols, join, 50)
    assert sorted((r[0], r[1], r[2], r[-1]) for r in got if r[0] is not None) == sorted((d, n, r, h) for d, n, r, _, h in exp if d is not None)
    assert passages.sketch_parts(3000) == 6 and len(got) == len(exp)


def test_cells_grow_with_the_input_and_few_lone_blocks_are_written(spark, monkeypatch):
    """With many more blocks than a task holds cells for, those that occur once still end before anything is written."""
    import random

    rng = random.Random(7)
    copied = "".join(rng.choices("abcdefgh", k=2000))
    rows = [(i, "".join(rng.choices("abcdefgh", k=5000)) + (copied if i < 2 else "")) for i in range(40)]
    written = {}
    store = passages.store

    def counted(df, name, by=None):
        out, path = store(df, name, by)
        if name in ("met", "opened"):
            written[name] = written.get(name, 0) + out.where(f"kind = {passages.OPEN}").count()
        return out, path

    monkeypatch.setattr(passages, "store", counted)
    monkeypatch.setattr(passages, "MAX_CELLS", 1 << 12)
    got = {r.doc_id: r.n_removed for r in dedup_bytes(frame(spark, rows)).collect()}
    blocks = 2 * sum(len(t) for _, t in rows) / (50 - 20 + 2)
    assert got == {i: 2000 if i == 1 else 0 for i in range(40)}
    assert written["met"] + written["opened"] < 0.35 * blocks
