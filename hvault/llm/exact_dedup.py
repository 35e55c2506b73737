"""Exact deduplication with skew-safe combining.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]``
becomes one space (null counts as empty). Copies are combined in three steps,
each comparing full content, never digests alone:

1. inside each task, so a group of any size sends one row per task and flush;
2. per (digest, salt), where each flush of a task takes the next salt modulo
   ``salts``, so the rows of one huge group are dealt over several tasks;
3. across the salts, only for digests that have winners under several salts.

The salts grow with the square root of the input's partitions, so that a text
with copies in every partition brings about as many contents to one task of
step 2 as to one of step 3, and neither grows as fast as the input.

Steps 2 and 3 stream rows sorted by digest and hold the distinct contents of
one digest (one, unless digests collide) and at most ``salts`` rows of each.

Defined results: of equal texts the row with the smallest doc_id stays; rows
that repeat the same doc_id and text all count in ``group_size`` and all carry
``kept`` when that id stays; a null doc_id is larger than any other, and stays
only in groups without another id (``keep_id`` null). Every input row gives
one output row; columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import stored

SALTS = 8  # at least
HELD_BYTES = 48 << 20  # content a task holds for local comparison
HELD_ROWS = 20_000
NO_ID = (1 << 63) - 1  # stands for a null doc_id while combining
D2_ROWS = 200_000  # digests (32 bytes each) sent to all tasks at most


def normalise(text: bytes) -> bytes:
    """Each run of space or \\x09-\\x0D as one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    out = b" ".join(words)
    if text[:1].isspace():
        out = b" " + out
    return out + b" " if text[-1:].isspace() else out


def local_winners(salts: int) -> Callable:
    """One row per content and flush: digest, salt, content, the group's smallest id, its rows' ids."""
    schema = pa.schema([("digest", pa.binary()), ("salt", pa.int32()), ("content", pa.binary()), ("least", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def rows_of(held: dict, salt: int):
        out = [[], [], [], [], []]
        for digest, groups in held.items():
            for content, ids in groups:
                for c, v in zip(out, (digest, salt, content, min(ids), ids)):
                    c.append(v)
                if len(out[0]) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)
                    out = [[], [], [], [], []]
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)

    def combine(it):
        salt = TaskContext.get().partitionId()  # neighbouring tasks and flushes take neighbouring salts
        held: dict = {}
        size = rows = 0
        for batch in it:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                content = normalise(text.as_buffer().to_pybytes()) if text.is_valid else b""
                groups = held.setdefault(hashlib.sha256(content).digest(), [])
                doc = NO_ID if doc is None else doc
                for known, ids in groups:
                    if known == content:
                        ids.append(doc)
                        break
                else:
                    groups.append((content, [doc]))
                    size += len(content)
                rows += 1
                if size >= HELD_BYTES or rows >= HELD_ROWS:
                    yield from rows_of(held, salt % salts)
                    held, size, rows, salt = {}, 0, 0, salt + 1
        yield from rows_of(held, salt % salts)

    return combine


def salted_winners(it):
    """Rows sorted by (digest, salt, least): each local winner's ids with its salted winner, and the first of each content with the content."""
    schema = pa.schema([("digest", pa.binary()), ("salt", pa.int32()), ("class", pa.int32()), ("least", pa.int64()), ("ids", pa.list_(pa.int64())), ("content", pa.binary())])
    group, known = None, []
    for batch in it:
        cls, first, least = [], [], []
        dig, salt, contents, ids = (batch.column(i) for i in (0, 1, 2, 4))
        for d, s, c, m in zip(dig.to_pylist(), salt.to_pylist(), contents.to_pylist(), batch.column(3).to_pylist()):
            if (d, s) != group:
                group, known = (d, s), []
            k = next((i for i, (x, _) in enumerate(known) if x == c), len(known))
            new = k == len(known)
            if new:
                known.append((c, m))
            cls.append(k)
            least.append(known[k][1])
            first.append(c if new else None)
        yield pa.RecordBatch.from_arrays([dig, salt, pa.array(cls, pa.int32()), pa.array(least, pa.int64()), ids, pa.array(first, pa.binary())], schema=schema)


def global_winners(it):
    """Rows sorted by (digest, least): salted winners of equal content get one class across the salts."""
    schema = pa.schema([("digest", pa.binary()), ("salt", pa.int32()), ("class", pa.int32()), ("keep", pa.int64()), ("total", pa.int64())])
    digest, groups = None, []

    def close():
        rows = [(digest, s, k, members[0][2], sum(m[3] for m in members)) for _, members in groups for s, k, *_ in members]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    for batch in it:
        for d, s, k, m, n, c in zip(*(batch.column(x).to_pylist() for x in ("digest", "salt", "class", "least", "n", "content"))):
            if d != digest:
                yield from close()
                digest, groups = d, []
            members = next((g for x, g in groups if x == c), None)
            if members is None:
                members = []
                groups.append((c, members))
            members.append((s, k, m, n))
    yield from close()


def dedup_exact(documents: DataFrame, salts: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text): see the module's description."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    salts = salts or max(SALTS, isqrt(rows.rdd.getNumPartitions()))
    local = rows.mapInArrow(local_winners(salts), "digest binary, salt int, content binary, least long, ids array<long>")
    dealt = local.repartition("digest", "salt").sortWithinPartitions("digest", "salt", "least")
    salted = stored(dealt.mapInArrow(salted_winners, "digest binary, salt int, class int, least long, ids array<long>, content binary"), "salted")

    # per salted winner: its rows and smallest id (no content is read here)
    sizes = salted.groupBy("digest", "salt", "class").agg(F.sum(F.size("ids")).alias("n"), F.min("least").alias("least"))
    sizes = stored(sizes, "sizes")
    several = sizes.groupBy("digest").agg(F.count(F.lit(1)).alias("winners")).where("winners > 1").select("digest")
    several = stored(several, "several")
    if several.count() <= D2_ROWS:
        several = F.broadcast(several)
    meeting = salted.where("content is not null").select("digest", "salt", "class", "content").join(several, "digest", "left_semi")
    meeting = meeting.join(sizes, ["digest", "salt", "class"]).select("digest", "salt", "class", "least", "n", "content")
    met = meeting.repartition("digest").sortWithinPartitions("digest", "least", "salt", "class").mapInArrow(
        global_winners, "digest binary, salt int, class int, keep long, total long"
    )
    winners = stored(
        sizes.join(met, ["digest", "salt", "class"], "left").select(
            "digest", "salt", "class", F.coalesce("keep", "least").alias("keep"), F.coalesce("total", "n").alias("group_size")
        ),
        "winners",
    )
    out = salted.select("digest", "salt", "class", "ids").join(winners, ["digest", "salt", "class"])
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(F.explode("ids").alias("id"), "keep", "group_size", "digest").select(
        real("id").alias("doc_id"), real("keep").alias("keep_id"), "group_size", (F.col("id") == F.col("keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_copies(documents: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns (of rows that repeat an id and text, any one).

    The marks are joined back on id and digest, so the text is shuffled once."""
    mark = F.sha2(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    keep = dedup_exact(documents).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("mark")).distinct()
    # the caller's columns travel as one struct, so no name can clash
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), mark.alias("mark"))
    rows = rows.alias("r").join(keep.alias("k"), F.col("r.id").eqNullSafe(F.col("k.id")) & (F.col("r.mark") == F.col("k.mark")), "left_semi")
    return rows.dropDuplicates(["id", "mark"]).select("row.*")


#: DuckDB: one row per document.
EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
