"""Repeated windows of symbols (words or bytes) across documents, without one row per window.

A window is ``length`` consecutive symbols. Each window is assigned to its
anchor, the ``gram`` symbols inside it with the smallest hash (leftmost among
equals): equal windows have equal anchors at equal offsets. Neighbouring
windows with the same anchor form a block, so a document has about
``2 / (length - gram + 2)`` blocks per symbol. Blocks
are chained to segments, cut where an anchor's hash says so, so equal passages
are cut alike. Steps:

1. ``sketch``: every task counts the cells of its anchors and segments
   (``rows`` hash functions over cells in proportion to the input); partial counts
   are merged by cell range. A merged count is never below the true one. Cells
   that are too many to be sent to a task at once are cut into parts by a hash
   of the anchor, and steps 2 and 3 take the blocks of one part after the other.
2. Segments counted twice or more are compared by full content, first inside
   the task, then by one shuffle on the content. All but those of the smallest
   document are removed; the one that stays is opened into blocks.
3. Blocks of the other segments whose anchor is counted once are done. The
   rest is compared with the opened ones in the same two steps.
4. An anchor whose blocks differ in content can still share some windows.
   Up to ``GROUP`` such blocks meet in one place and are opened there; the
   blocks of more common anchors are opened into single windows, which are
   dealt by content, so no anchor is too common for a task.

Comparisons are on content and hashes only prune, but for the single word
windows of the more common anchors in step 4, which op3 compares by a 128-bit
digest. A sketch that is too small for the corpus prunes less and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import discard, store, stored

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1
CHUNK = 1 << 18  # symbols handled at once by numpy
OPEN, GONE, WHOLE = 0, 1, 2  # kinds of rows: open block or window, removed run, open segment
FLUSH = 50_000  # contents held by a task for local comparison
SEGMENT = 16  # blocks in a segment, on average
GROUP = 8192  # blocks of one anchor whose windows are compared in one place; above, windows are shuffled one by one
MAX_CELLS = 1 << 28  # cells of a sketch row that a task holds at once: two rows are 64 MB as bits
MIXED_ROWS = 1_000_000  # anchors (16 bytes each) sent to all tasks at most
SHARDS = 64  # cell ranges of a sketch row


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def gram_hashes(sym: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each run of ``gram`` symbols, by doubling."""
    out, done = None, 0
    power, size = sym, 1
    while True:
        if gram & size:
            if out is None:
                out, done = power, size
            else:
                n = len(sym) - done - size + 1
                out, done = out[:n] * U(pow(BASE, size, 1 << 64)) + power[done : done + n], done + size
        if size * 2 > gram:
            return mix(out[: len(sym) - gram + 1])
        power = power[: len(power) - size] * U(pow(BASE, size, 1 << 64)) + power[size:]
        size *= 2


def anchors(sym: np.ndarray, valid: np.ndarray, gram: int, length: int):
    """Blocks of the windows whose start is ``valid``: first start, last start, hash of the anchor; and the
    segments they form: number of the first block, hash of the content."""
    n = len(sym) - length + 1
    h = gram_hashes(sym, gram)
    best = (h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U)
    width, cur = length - gram + 1, 1
    while cur * 2 <= width:
        best = np.minimum(best[:-cur], best[cur:])
        cur *= 2
    if cur < width:
        best = np.minimum(best[: len(best) - (width - cur)], best[width - cur :])
    place = (best[:n] & U(0xFFFFFFFF)).astype(np.int64)
    ok = valid[:n]
    cut = np.empty(n, dtype=bool)
    cut[0] = True
    np.not_equal(place[1:], place[:-1], out=cut[1:])
    cut[1:] |= ok[1:] != ok[:-1]
    first = np.flatnonzero(cut)
    last = np.append(first[1:], n) - 1
    keep = ok[first]
    first, last = first[keep], last[keep]
    own = h[place[first]]
    if not len(first):
        return first, last, own, first, own
    new = np.ones(len(first), bool)
    new[1:] = (own[1:] & U(SEGMENT - 1) == 0) | (first[1:] != last[:-1] + 1)
    seg = np.flatnonzero(new)
    total = np.concatenate([np.zeros(1, U), np.cumsum(h)])
    return first, last, own, seg, mix(total[last[np.append(seg[1:], len(first)) - 1] + width] - total[first[seg]])


def cells_of(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(hashes ^ U((0xD6E8FEB86659FD93 * (row + 1)) & MASK)) >> U(64 - bits)).astype(np.int64)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of the sketch that counts each hash."""
    return ((mix(hashes ^ U(0x2545F4914F6CDD1D)) >> U(32)) % U(parts)).astype(np.int64)


class Chunks:
    """Gathers documents into arrays of about CHUNK symbols; long documents are cut with an overlap of length - 1."""

    def __init__(self, gram: int, length: int):
        self.gram, self.length = gram, length
        self.parts: list = []
        self.size = 0

    def add(self, key, sym: np.ndarray):
        n, step = len(sym), CHUNK
        if n < self.length:
            return
        for at in range(0, n - self.length + 1, step):
            piece = sym[at : at + step + self.length - 1]
            self.parts.append((key, at, piece))
            self.size += len(piece)
            if self.size >= CHUNK:
                yield self.take()

    def take(self):
        parts, self.parts, self.size = self.parts, [], 0
        sym = np.concatenate([p for _, _, p in parts])
        valid = np.ones(len(sym), dtype=bool)
        ends = np.cumsum([len(p) for _, _, p in parts])
        for e in ends:
            valid[e - self.length + 1 : e] = False
        return parts, ends, *anchors(sym, valid, self.gram, self.length)

    def rest(self):
        if self.parts:
            yield self.take()


class Local:
    """Equal contents met by one task: of each content the rows of the smallest document stay open, others are removed."""

    def __init__(self, kind: int = OPEN):
        self.kind = kind
        self.open: dict = {}
        self.gone: list = []

    def add(self, content: bytes, extra, doc, th, starts: list, n: int) -> None:
        old = self.open.get(content)
        if old is None:
            self.open[content] = [doc, extra, n, {th: starts}]
        elif doc == old[0]:
            old[3][th] = old[3].get(th, []) + starts
        elif doc > old[0]:
            self.gone.append((doc, th, starts, n))
        else:
            self.gone += [(old[0], t, s, n) for t, s in old[3].items()]
            self.open[content] = [doc, extra, n, {th: starts}]

    def __len__(self):
        return len(self.open) + len(self.gone)

    def rows(self):
        for content, (doc, extra, n, by) in self.open.items():
            for th, starts in by.items():
                yield self.kind, extra, content, doc, th, starts, n
        for doc, th, starts, n in self.gone:
            yield GONE, 0, None, doc, th, starts, n
        self.open, self.gone = {}, []


FOUND = "kind int, gram long, content binary, doc long, th long, starts array<long>, n long"
FOUND_PA = pa.schema([("kind", pa.int32()), ("gram", pa.int64()), ("content", pa.binary()), ("doc", pa.int64()), ("th", pa.int64()), ("starts", pa.list_(pa.int64())), ("n", pa.int64())])


def batches(rows, size: int = 8192) -> Iterator[pa.RecordBatch]:
    buf = []
    for r in rows:
        buf.append(r)
        if len(buf) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*buf), FOUND_PA)], schema=FOUND_PA)
            buf = []
    if buf:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*buf), FOUND_PA)], schema=FOUND_PA)


def settled_rows(it):
    """Rows sorted by (content, document): rows of the first document of a content stay open, the others are removed."""
    content, doc = None, None
    for batch in it:
        for kind, gram, c, d, th, starts, n in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if c != content:
                content, doc = c, d
            yield (kind, gram, c, d, th, starts, n) if d == doc else (GONE, 0, None, d, th, starts, n)


def settle(it) -> Iterator[pa.RecordBatch]:
    return batches(settled_rows(it))


def sketch_bits(expected: float) -> int:
    """log2 of the cells of a sketch row: four cells for each expected value, within bounds."""
    return int(np.clip(np.ceil(np.log2(max(4 * expected, 1))), 16, np.log2(MAX_CELLS)))


def sketch_parts(expected: float) -> int:
    """Parts of a sketch that has two cells or more for each expected value, and ``MAX_CELLS`` at most in a part's row."""
    return max(1, int(np.ceil(2 * expected / MAX_CELLS)))


def sketch(df: DataFrame, hashes_of: Callable, bits: list[int], rows: int) -> DataFrame:
    """Merged count sketches of 64-bit values: ``hashes_of`` yields, from the batches of ``df``, the number of a sketch and
    an array of values for it; ``bits`` has each sketch's size. Rows of (sketch, shard, twice): for each cell range a bit
    string of the cells that count two or more. ``bit_maps`` reads one sketch of the table."""
    shard_bits = [b - int(np.log2(SHARDS)) for b in bits]

    def count(it):
        """Counts of a task by cell range: sorted cells (a cell as often as it counts) as steps, in 16 bits where all fit."""
        schema = pa.schema([("sketch", pa.int32()), ("shard", pa.int32()), ("wide", pa.bool_()), ("first", pa.int32()), ("steps", pa.binary())])
        held: list = [[] for _ in bits]

        def flush():
            for k, parts in enumerate(held):
                h = np.concatenate(parts) if parts else np.empty(0, U)
                parts.clear()
                out: list = [[], [], [], [], []]
                for r in range(rows):
                    cells = np.sort(cells_of(h, r, bits[k]))
                    where = np.searchsorted(cells, np.arange(SHARDS + 1) << shard_bits[k])
                    for s in range(SHARDS):
                        part = cells[where[s] : where[s + 1]] - (s << shard_bits[k])
                        if len(part):
                            steps = np.diff(part)
                            wide = bool(steps.max(initial=0) > 0xFFFF)
                            for c, v in zip(out, (k, r * SHARDS + s, wide, int(part[0]), steps.astype(np.uint32 if wide else np.uint16).tobytes())):
                                c.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)

        size = 0
        for k, h in hashes_of(it):
            held[k].append(h)
            size += len(h)
            if size >= 1 << 21:
                yield from flush()
                size = 0
        yield from flush()

    def merge(it):
        schema = pa.schema([("sketch", pa.int32()), ("shard", pa.int32()), ("twice", pa.binary())])
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in it:
            for k, shard, wide, first, steps in zip(*(batch.column(i).to_pylist() for i in range(5))):
                acc = total.get((k, shard))
                if acc is None:
                    acc = total[k, shard] = np.zeros(1 << shard_bits[k], np.uint8)
                cells = np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.uint32 if wide else np.uint16).astype(np.int64))]) + first
                cells, counts = np.unique(cells, return_counts=True)
                acc[cells] = np.minimum(acc[cells] + np.minimum(counts, 255), 255)
        for (k, shard), acc in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([shard], pa.int32()), pa.array([np.packbits(acc >= 2).tobytes()], pa.binary())], schema=schema)

    counts = df.mapInArrow(count, "sketch int, shard int, wide boolean, first int, steps binary")
    return counts.repartition("sketch", "shard").mapInArrow(merge, "sketch int, shard int, twice binary")


def bit_maps(sketches: DataFrame, k: int, bits: int, rows: int) -> list[np.ndarray]:
    """One sketch as arrays, per row a bit for each cell that counts two or more."""
    out = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(rows)]
    size = (1 << bits) // SHARDS // 8
    for r in sketches.where(F.col("sketch") == k).collect():  # rows * SHARDS bit strings, 64 MB at most
        row, s = divmod(r["shard"], SHARDS)
        out[row][s * size : (s + 1) * size] = np.frombuffer(r["twice"], np.uint8)
    return out


def counted_twice(h: np.ndarray, maps: list[np.ndarray], bits: int) -> np.ndarray:
    """Mask of the hashes that every row of the sketch counts twice or more."""
    ok = np.ones(len(h), bool)
    for r, m in enumerate(maps):
        c = cells_of(h, r, bits)
        ok &= ((m[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1).astype(bool)
    return ok


def repeated(
    docs: DataFrame, symbols_of: Callable, content_of: Callable, windows_of: Callable, gram: int, length: int, symbols: int, rows: int = 2, local_of: Callable = Local, key_of: Callable = bytes
) -> DataFrame:
    """(doc, th, starts, n): runs of ``n`` windows from each start that also start in a smaller document.

    ``docs`` has doc, th (hash of the text, telling rows with one id apart) and
    text as binary. ``symbols_of(buffer)`` gives the symbol array,
    ``content_of(buffer)`` a function of (first, last symbol) to the content in
    between, ``windows_of(content, n)`` the contents of its n windows;
    ``local_of()`` makes what finds equal contents inside a task, ``key_of(window)``
    what single windows are shuffled by.
    """
    spark = docs.sparkSession
    expected = 2 * symbols / (length - gram + 2)
    n_parts = sketch_parts(expected)
    # the parts of the blocks' sketch, then that of the segments
    bits = [sketch_bits(expected / n_parts)] * n_parts + [sketch_bits(min(expected / SEGMENT, MAX_CELLS / 8))]

    def all_hashes(it):
        def by_part(h, seg):
            where = part_of(h, n_parts)
            for k in range(n_parts):
                yield k, h[where == k]
            yield n_parts, seg

        chunks = Chunks(gram, length)
        for batch in it:
            for text in batch.column("text"):
                for _, _, _, _, h, _, seg in chunks.add(None, symbols_of(text.as_buffer())):
                    yield from by_part(h, seg)
        for _, _, _, _, h, _, seg in chunks.rest():
            yield from by_part(h, seg)

    sketches, sketch_path = store(sketch(docs.select("text"), all_hashes, bits, rows), "sketch")
    whole_twice = spark.sparkContext.broadcast(bit_maps(sketches, n_parts, bits[n_parts], rows))

    def cut(items, whole: bool, part: int, twice):
        """Open blocks of a ``part`` (and, with ``whole`` and the first part, open segments) of items (document, th, buffer,
        starts of the buffer in the document)."""
        blocks, segments = local_of(), Local(WHOLE)
        chunks, texts = Chunks(gram, length), {}

        def use(parts, ends, first, last, h, seg, seg_h):
            begin = np.array([a for _, a, _ in parts]) - (ends - np.array([len(p) for _, _, p in parts]))

            def send(to, f, t, h):
                part = np.searchsorted(ends, f, side="right")
                at = f + begin[part]
                for p, s, k, g in zip(part.tolist(), at.tolist(), (t - f + 1).tolist(), h.view(np.int64).tolist()):
                    doc, th, content, starts = texts[parts[p][0]]
                    to.add(content(s, s + k + length - 2), g, doc, th, [s + b for b in starts], k)

            ok = part_of(h, n_parts) == part
            ok[ok] = counted_twice(h[ok], twice.value, bits[part])
            if whole and len(seg):
                end = np.append(seg[1:], len(first))
                again = counted_twice(seg_h, whole_twice.value, bits[n_parts])
                ok &= ~np.repeat(again, end - seg)
                if part == 0:
                    send(segments, first[seg[again]], last[end[again] - 1], seg_h[again])
            send(blocks, first[ok], last[ok], h[ok])

        for n, (doc, th, buf, starts) in enumerate(items):
            texts[n] = (doc, th, content_of(buf), starts)
            for chunk in chunks.add(n, symbols_of(buf)):
                use(*chunk)
                texts = {n: texts[n]}
                if len(blocks) >= FLUSH:
                    yield from blocks.rows()
                if len(segments) >= FLUSH // SEGMENT:
                    yield from segments.rows()
        for chunk in chunks.rest():
            use(*chunk)
        yield from blocks.rows()
        yield from segments.rows()

    def find(part, twice):
        def found(it):
            def items():
                for batch in it:
                    for doc, th, text in zip(batch.column("doc").to_pylist(), batch.column("th").to_pylist(), batch.column("text")):
                        yield doc, th, text.as_buffer(), (0,)

            return batches(cut(items(), True, part, twice))

        return found

    def settle_segments(part, twice):
        """The first part's blocks of the segments that stay, removed segments, and the segments for the other parts."""

        def found(it):
            others: list = []

            def items():
                for kind, g, c, d, th, starts, n in settled_rows(it):
                    if kind == GONE:
                        others.append((GONE, 0, None, d, th, starts, n))
                    else:
                        if n_parts > 1:
                            others.append((WHOLE, g, c, d, th, starts, n))
                        yield d, th, pa.py_buffer(c), starts

            for row in cut(items(), False, part, twice):
                yield row
                if others:
                    yield from others
                    others.clear()
            yield from others

        return lambda it: batches(found(it))

    def open_segments(part, twice):
        def found(it):
            def items():
                for batch in it:
                    for _, _, c, d, th, starts, _ in zip(*(batch.column(i).to_pylist() for i in range(7))):
                        yield d, th, pa.py_buffer(c), starts

            return batches(cut(items(), False, part, twice))

        return found

    def group_windows(it):
        """Rows sorted by anchor, at most GROUP of each: windows are compared inside the group, and runs of removed ones sent."""

        def close(group):
            least: dict = {}
            opened = [windows_of(c, n) for c, _, _, _, n in group]
            for (_, d, _, _, _), windows in zip(group, opened):
                for w in windows:
                    if least.get(w, d) >= d:
                        least[w] = d
            for (_, d, th, starts, n), windows in zip(group, opened):
                run = 0
                for i in range(n + 1):
                    if i < n and least[windows[i]] < d:
                        run += 1
                    elif run:
                        yield GONE, 0, None, d, th, [s + i - run for s in starts], run
                        run = 0

        def found():
            anchor, group = None, []
            for batch in it:
                for _, g, c, d, th, starts, n in zip(*(batch.column(i).to_pylist() for i in range(7))):
                    if g != anchor:
                        yield from close(group)
                        anchor, group = g, []
                    group.append((c, d, th, starts, n))
            yield from close(group)

        return batches(found())

    def open_windows(it):
        def found():
            local = local_of()
            for batch in it:
                for _, gram_, c, d, th, starts, n in zip(*(batch.column(i).to_pylist() for i in range(7))):
                    for i, w in enumerate(windows_of(c, n)):
                        local.add(key_of(w), 0, d, th, [s + i for s in starts], 1)
                    if len(local) >= FLUSH:
                        yield from local.rows()
            yield from local.rows()

        return batches(found())

    def dealt(df):
        return df.repartition("content").sortWithinPartitions("content", "doc")

    tables: list = []  # blocks found in the texts and in the segments that stay, part by part, and what is removed
    done: list = []  # folders of these tables that nothing reads again once the blocks are settled
    whole = None
    for part in range(n_parts):
        twice = spark.sparkContext.broadcast(bit_maps(sketches, part, bits[part], rows))
        met, met_path = store(docs.mapInArrow(find(part, twice), FOUND), "met", by="kind")
        if part == 0:
            opened, opened_path = store(dealt(met.where(f"kind = {WHOLE}")).mapInArrow(settle_segments(part, twice), FOUND), "opened", by="kind")
            discard(spark, f"{met_path}/kind={WHOLE}")
            whole, done = opened.where(f"kind = {WHOLE}"), [f"{opened_path}/kind={WHOLE}"]
        else:
            opened, opened_path = store(whole.mapInArrow(open_segments(part, twice), FOUND), "opened", by="kind")
        tables += [met, opened]
        done += [f"{path}/kind={OPEN}" for path in (met_path, opened_path)]
        twice.destroy()
    whole_twice.destroy()
    discard(spark, sketch_path)
    blocks = reduce(DataFrame.unionByName, [t.where(f"kind = {OPEN}") for t in tables])
    # what is left is counted once more: most anchors now stand alone
    left_bits = sketch_bits(blocks.count())

    def grams(it):
        for batch in it:
            yield 0, batch.column("gram").to_numpy().view(U)

    left = spark.sparkContext.broadcast(bit_maps(sketch(blocks.select("gram"), grams, [left_bits], rows), 0, left_bits, rows))

    def not_alone(it):
        for batch in it:
            yield batch.filter(pa.array(counted_twice(batch.column("gram").to_numpy().view(U), left.value, left_bits)))

    settled = stored(dealt(blocks.mapInArrow(not_alone, FOUND)).mapInArrow(settle, FOUND), "settled")
    for path in done:
        discard(spark, path)  # settled; of these tables only the removed runs are read again
    classes = settled.where(f"kind = {OPEN}")
    mixed = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min(F.xxhash64("content")).alias("a"), F.max(F.xxhash64("content")).alias("b")).where("a <> b")
    mixed = stored(mixed.select("gram", "k"), "mixed")
    if mixed.count() <= MIXED_ROWS:
        mixed = F.broadcast(mixed)
    mixed = classes.join(mixed, "gram").select(*classes.columns, "k")
    few, many = (mixed.where(F.col("k") <= GROUP), mixed.where(F.col("k") > GROUP))
    near = few.drop("k").repartition("gram").sortWithinPartitions("gram").mapInArrow(group_windows, FOUND)
    many = many.drop("k")
    single = stored(many.mapInArrow(open_windows, FOUND), "windows")
    last = dealt(single.where(f"kind = {OPEN}")).mapInArrow(settle, FOUND)
    gone = [x.where(f"kind = {GONE}").select("doc", "th", "starts", "n") for x in (*tables, settled, near, single, last)]
    return reduce(DataFrame.unionByName, gone)


def keyed(documents: DataFrame) -> DataFrame:
    """doc, th and text (bytes) of ``documents``; th tells rows with one id apart and is 0 where ids are unique."""
    ids = documents.select(F.col("doc_id").cast("long").alias("doc"))
    unique = ids.where("doc is not null").groupBy("doc").count().where("count > 1").isEmpty()
    th = F.lit(0).cast("long") if unique else F.xxhash64("text")
    return documents.select(F.col("doc_id").cast("long").alias("doc"), th.alias("th"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def with_ranges(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (doc, th, text) with the removed runs of each row as parallel arrays ``starts`` and ``n``."""
    per_doc = gone.select("doc", "th", F.explode("starts").alias("start"), "n").groupBy("doc", "th").agg(
        F.collect_list(F.struct("start", "n")).alias("runs")
    )
    return docs.join(per_doc, ["doc", "th"], "left").select("doc", "text", F.col("runs.start").alias("starts"), F.col("runs.n").alias("n"))


def covered(size: int, starts, n, length: int) -> np.ndarray:
    """Mask of the symbols covered by the runs."""
    step = np.zeros(size + 1, np.int64)
    if starts:
        a = np.asarray(starts, np.int64)
        np.add.at(step, a, 1)
        np.add.at(step, a + np.asarray(n, np.int64) + length - 1, -1)
    return np.cumsum(step[:-1]) > 0
