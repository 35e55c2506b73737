"""Substring deduplication by bytes: repeated ``length``-byte strings by anchored blocks.

A byte is removed when a ``length``-byte string that covers it also starts in
a document with a smaller id; matches never cross documents. The method is
that of op3 (``passages.repeated``), not a sort of all suffixes:

* a string's anchor is the ``gram`` bytes with the smallest hash among it (equal
  strings have equal anchors). Anchors are counted in sketches merged over all
  tasks, and strings whose anchor occurs once end here, before anything is
  shuffled;
* neighbouring strings with one anchor are held as one block, chains of blocks
  that occur again whole are settled first, as one (by dictionary);
* the blocks a task holds are grouped by most-significant-digit passes over
  8-byte digits, through their whole content; of equal ones only the smallest
  document's goes on;
* the rest is dealt by a hash of the content, so equal blocks of all tasks meet;
* anchors whose blocks are not all equal are opened into single strings of
  ``length`` bytes and compared in the same way.

Defined results: null text is empty; shorter documents lose nothing; rows
with a null id take no part and come back whole; rows that share an id count
as one document; every input row gives one output row, and columns besides
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm import passages as P

LENGTH = 50
GRAM = 20


def radix_groups(items: list[bytes]) -> np.ndarray:
    """A group number per item, equal exactly for equal items: most-significant-digit passes over 8-byte digits.

    The size is the first digit, so the items of a bucket end together. The digits take the room of the items, not that
    of the longest one for each."""
    sizes = np.fromiter(map(len, items), np.int64, len(items))
    words = -(-sizes // 8)
    begin = np.cumsum(words) - words
    digits = np.frombuffer(b"".join(x.ljust(-(-len(x) // 8) * 8, b"\0") for x in items), ">u8")
    out = np.full(len(items), -1, np.int64)
    live, bucket, done, at = np.arange(len(items)), np.zeros(len(items), np.int64), 0, -1
    while len(live):
        d = sizes[live] if at < 0 else digits[begin[live] + at]
        at += 1
        order = np.lexsort((d, bucket))
        live, d, bucket = live[order], d[order], bucket[order]
        new = np.ones(len(live), bool)
        new[1:] = (d[1:] != d[:-1]) | (bucket[1:] != bucket[:-1])
        bucket = np.cumsum(new) - 1
        settled = (np.bincount(bucket)[bucket] == 1) | (words[live] == at)
        numbers, number = np.unique(bucket[settled], return_inverse=True)
        out[live[settled]] = done + number
        done += len(numbers)
        live, bucket = live[~settled], bucket[~settled]
    return out


class RadixLocal:
    """Suffix blocks of one task: equal groups by ``radix_groups``; of each the smallest document's rows stay open."""

    def __init__(self):
        self.items: list = []

    def __len__(self):
        return len(self.items)

    def add(self, content: bytes, extra, doc, th, starts: list, n: int) -> None:
        self.items.append((content, extra, doc, th, starts, n))

    def rows(self):
        items, self.items = self.items, []
        if not items:
            return
        group = radix_groups([x[0] for x in items])
        doc = np.array([x[2] for x in items], np.int64)
        order = np.lexsort(([x[3] for x in items], doc, group))
        least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, doc)
        held, row = None, None
        for i in order.tolist():
            content, extra, d, th, starts, n = items[i]
            if (group[i], d, th) == held:
                row[5].extend(starts)
                continue
            if row:
                yield row
            held = (group[i], d, th)
            row = (P.OPEN, extra, content, d, th, list(starts), n) if d == least[group[i]] else (P.GONE, 0, None, d, th, list(starts), n)
        yield row


def byte_symbols(buf) -> np.ndarray:
    return np.frombuffer(buf, np.uint8).astype(np.uint64) if buf.size else np.empty(0, np.uint64)


def bytes_between(buf):
    def content(a: int, b: int) -> bytes:
        return buf[a : b + 1].to_pybytes()

    return content


def dedup_bytes(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), spans (array of begin and end, end exclusive).

    ``gram`` (at most ``length``) is the number of bytes of an anchor; it and the
    size of the sketches change the work, never the result.
    """
    gram = min(gram, length)
    docs = P.keyed(documents)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    gone = P.repeated(
        docs.where("doc is not null"), byte_symbols, bytes_between, lambda c, n: [c[i : i + length] for i in range(n)], gram, length, symbols=size, local_of=RadixLocal
    )

    def cut(it):
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int64())))])
        for batch in it:
            out = [[] for _ in schema]
            for doc, text, starts, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                spans, removed, kept = [], 0, text
                if starts:
                    mask = P.covered(len(text), starts, n, length)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                    spans = edge.reshape(-1, 2).tolist()
                    removed = int(mask.sum())
                    kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                for c, v in zip(out, (doc, len(text), removed, len(spans), kept, spans)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)

    return P.with_ranges(docs, gone).mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<array<long>>")


def suffix_digest(documents: DataFrame) -> DataFrame:
    """The registered query's columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return dedup_bytes(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
