"""Substring deduplication by words with a count-min prefilter.

A window is ``length`` consecutive words of one document. A word is removed
when a window that covers it also starts, with the same words, in a document
with a smaller id. Every partition counts its windows (through their anchors,
see ``passages``) in a count-min sketch; the merged sketches overestimate the
counts, and only windows estimated at two or more reach the exact pass, which
groups them by their full words. The first window of each content stays.

Defined results: null text is empty; documents shorter than a window lose
nothing; rows with a null id take no part and come back whole; rows that
share an id count as one document; every input row gives one output row, and
columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm import passages as P

LENGTH = 50
GRAM = 8
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
POWERS = np.full(1 << 16, P.BASE, np.uint64)
POWERS[0] = 1
POWERS = np.cumprod(POWERS)


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of each word ``[^\\x20\\x09-\\x0D]+``."""
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~SPACE[b]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(buf) -> np.ndarray:
    """One 64-bit hash per word of a UTF-8 text."""
    b = np.frombuffer(buf, np.uint8) if buf.size else np.empty(0, np.uint8)
    first, end = word_spans(b)
    if not len(first):
        return np.empty(0, np.uint64)
    begin = np.zeros(len(b), np.int64)  # where the word of each byte begins
    begin[first] = first
    within = np.arange(len(b)) - np.maximum.accumulate(begin)
    terms = (b.astype(np.uint64) + P.U(1)) * POWERS[within & 0xFFFF]
    terms[SPACE[b]] = 0
    return P.mix(np.add.reduceat(terms, first) + (end - first).astype(np.uint64) * P.U(0xA24BAED4963EE407))


def words_between(buf):
    words: list = []

    def content(a: int, b: int) -> bytes:
        if not words:
            words.extend(buf.to_pybytes().split())
        return b" ".join(words[a : b + 1])

    return content


def word_windows(content: bytes, n: int, length: int):
    words = content.split(b" ")
    return [b" ".join(words[i : i + length]) for i in range(n)]


def dedup_substrings(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text): see the module's description.

    ``gram`` (at most ``length``) is the anchor's width in words. It and the
    sketch size change the work, never the result.
    """
    gram = min(gram, length)
    docs = P.keyed(documents)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    gone = P.repeated(
        docs.where("doc is not null"), word_hashes, words_between, lambda c, n: word_windows(c, n, length), gram, length, symbols=size // 5,
        key_of=lambda w: hashlib.blake2b(w, digest_size=16).digest(),
    )

    def cut(it):
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        for batch in it:
            out = [[], [], [], []]
            for doc, text, starts, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words = text.split()
                removed = 0
                if starts:
                    mask = P.covered(len(words), starts, n, length)
                    removed = int(mask.sum())
                    words = [w for w, m in zip(words, mask.tolist()) if not m]
                for c, v in zip(out, (doc, len(words) + removed, removed, b" ".join(words).decode())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)

    return P.with_ranges(docs, gone).mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def substring_digest(documents: DataFrame) -> DataFrame:
    """The registered query's columns: doc_id, n_words, n_removed, kept_sha256."""
    return dedup_substrings(documents).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
