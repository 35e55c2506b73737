"""Packing by lexical retrieval.

Documents become token ids and a closing id; the pieces of documents fill
sequences of ``window`` tokens. The open window's document is the seed: its
best-scoring unused neighbours (BM25 over token ids) follow, each cut where the
window ends; the rest of a cut document opens the next window and is its seed.

The inverted index is sharded. Documents are range-partitioned by a min-hash of
adjacent id pairs, so documents that share text tend to share a shard, and a
task packs the shards of its range, each of at most ``SHARD_DOCS`` documents or
about ``SHARD_TOKENS`` tokens. A seed queries the shard that holds it: within
the shard the search is exact, and its document frequencies, number and mean
length of documents are the whole table's. Every size takes the same path; a
table that fits one shard is searched whole. What is left at the end of a task
goes into sequences of power-of-two length, so no sequence needs padding.

Defined results: null text is empty (one closing id); a null doc_id is kept
and packed; rows that repeat are packed each; every token lies in exactly one
piece; equal scores go to the document that comes first by key and doc_id.
Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hvault.llm.common import stored

WINDOW = 1024
CLOSE = 0
SHARD_DOCS = 2048
SHARD_TOKENS = 1 << 22
COMPACT = 0.7  # part of the index that is left when used documents are taken out of it
COMMON = 12  # ids in more than one of so many documents of a shard have a row of weights
K1, B = 1.2, 0.75

#: The vocabulary's split pattern and its one special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}

SPACES = re.compile(r"\s{500,}")


def encoder(ranks_path: str):
    """Byte-level BPE from a rank file; same ids as the tokenizers library gives for the same vocabulary."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def ids_of(enc, text: str) -> np.ndarray:
    """Ids of a text. The library's pattern search gives up on very long runs of white space. All but the last character
    of such a run (all of it at the text's end) is one word of the pattern, so then long runs are encoded as words."""
    try:
        return enc.encode_to_numpy(text, allowed_special="all").astype(np.uint16)
    except ValueError:
        pass
    parts, at = [], 0
    for run in SPACES.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        parts += [enc.encode_to_numpy(text[at : run.start()], allowed_special="all"), np.array(enc._encode_single_piece(text[run.start() : end]), np.uint16)]
        at = end
    parts.append(enc.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(parts).astype(np.uint16)


def tokenise(documents: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 16-bit, closing id included) and key (min-hash of adjacent id pairs)."""

    def run(it):
        enc = encoder(ranks_path)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("key", pa.int64())])
        for batch in it:
            ids, keys = [], []
            for t in batch.column("text"):
                text = t.as_py() or ""
                a = ids_of(enc, text)
                pair = a[:-1].astype(np.uint64) << np.uint64(16) | a[1:]
                pair = (pair + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                pair ^= pair >> np.uint64(29)
                pair *= np.uint64(0xBF58476D1CE4E5B9)
                keys.append(int(pair.min() >> np.uint64(1)) if len(pair) else 0)
                ids.append(np.append(a, np.uint16(CLOSE)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(keys, pa.int64())], schema=schema)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, key long")


class Index:
    """BM25 inverted index of one shard, for searches over the documents that are still unused.

    Ids that many of the shard's documents hold have a row of weights for all documents; one product of those rows and the
    documents' ids gives that part of every score (at most ``SHARD_DOCS`` squared numbers). The others have postings
    (document, weight), sorted by id. ``stats`` (document frequencies by id, documents, mean length) are the whole
    table's; without them the shard is the table."""

    def __init__(self, docs: list[np.ndarray], stats=None):
        n = len(docs)
        size = np.array([len(d) for d in docs], np.int64)
        # sorted (document, id) pairs of the shard at once: runs of equal ones are the term frequencies
        pairs = np.sort(np.repeat(np.arange(n), size) << 16 | np.concatenate(docs).astype(np.int64))
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        doc, term = pairs[first] >> 16, pairs[first] & 0xFFFF
        tf = np.diff(np.append(first, len(pairs))).astype(float)
        df = np.bincount(term, minlength=1 << 16)
        all_df, all_n, mean = stats or (df, n, size.mean())
        idf = np.log1p((all_n - all_df + 0.5) / (all_df + 0.5))
        weight = (idf[term] * tf * (K1 + 1) / (tf + (K1 * (1 - B + B * size / mean))[doc])).astype(np.float32)
        common = np.flatnonzero(df * COMMON > max(8 * COMMON, n))
        place = np.full(1 << 16, -1, np.int32)
        place[common] = np.arange(len(common))
        row = place[term]
        often = row >= 0
        # with whole tiles of 64 every column is summed alike, so equal documents have equal scores
        dense = np.zeros((len(common), -(-n // 64) * 64), np.float32)
        dense[row[often], doc[often]] = weight[often]
        holds = np.zeros((dense.shape[1], len(common)), np.float32)
        holds[doc[often], row[often]] = 1
        self.common = (holds @ dense)[:n, :n]
        rare = np.flatnonzero(~often)
        self.terms = np.split(term[rare], np.searchsorted(doc[rare], np.arange(1, n)))  # those that have postings, by document
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.term, self.doc, self.weight = term[rare].astype(np.uint16), doc[rare].astype(np.int32), weight[rare]
        self.unused = np.arange(n)  # documents of the index's places
        self.begin = self._begin()

    def _begin(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.bincount(self.term, minlength=1 << 16))])

    def drop(self, used: np.ndarray) -> None:
        """Take the documents that are used out of the index."""
        live = ~used[self.unused]
        place = np.cumsum(live, dtype=np.int32) - 1
        stay = live[self.doc]
        self.term, self.doc, self.weight = self.term[stay], place[self.doc[stay]], self.weight[stay]
        self.common, self.unused = self.common[:, live], self.unused[live]
        self.begin = self._begin()

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of each document in ``unused`` for the distinct ids of ``seed``."""
        out = self.common[seed].copy()
        t = self.terms[seed]
        first, size = self.begin[t], self.begin[t + 1] - self.begin[t]
        some = size > 0
        first, size = first[some], size[some]
        if len(size):
            at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            out += np.bincount(self.doc[at], self.weight[at], minlength=len(out)).astype(np.float32)
        return out


def chain(docs: list[np.ndarray], fill: int, window: int, stats=None) -> list[int]:
    """Order of a shard's documents when ``fill`` tokens are in the open window: each seed is followed by its best unused neighbours until its window is full."""
    index = Index(docs, stats)
    used = np.zeros(len(docs), bool)
    used[0] = True
    out, seed, room = [0], 0, -(fill + len(docs[0])) % window
    while len(out) < len(docs):
        if len(docs) - len(out) < COMPACT * len(index.unused):
            index.drop(used)
        score = index.scores(seed)
        score[used[index.unused]] = -1
        while len(out) < len(docs):
            at = int(score.argmax())
            score[at] = -1
            best = int(index.unused[at])
            used[best] = True
            out.append(best)
            if len(docs[best]) >= room:
                room = -(len(docs[best]) - room) % window
                break
            room -= len(docs[best])
        seed = best
    return out


def pack_task(it, window: int, stats=None):
    """Pieces of one task's documents, shard by shard, see the module's description."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    part = TaskContext.get().partitionId()
    sequence = part << 40
    fill = 0
    out: list = []
    tail: list = []  # pieces of the open window: (doc_id, start, ids, doc_tokens)

    def close(pieces):
        nonlocal sequence
        at = 0
        for doc, start, ids, total in pieces:
            out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, at))
            at += len(ids)
        sequence += 1

    def place(doc, ids, start=0, total=None):
        nonlocal fill, tail
        at = 0
        while at < len(ids):
            take = min(window - fill, len(ids) - at)
            tail.append((doc, start + at, ids[at : at + take], total or len(ids)))
            fill, at = fill + take, at + take
            if fill == window:
                close(tail)
                fill, tail = 0, []

    def finish():
        """The last window's tokens in sequences of power-of-two length."""
        nonlocal fill, tail
        while fill:
            size = 1 << (fill.bit_length() - 1)
            fill -= size
            now, rest = [], []
            for doc, start, ids, total in tail:
                if size:
                    now.append((doc, start, ids[:size], total))
                if len(ids) > size:
                    rest.append((doc, start + size, ids[size:], total))
                size = max(0, size - len(ids))
            close(now)
            tail = rest

    def emit():
        nonlocal out
        rows, out = out, []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    shard: list = []
    held = 0

    def pack():
        nonlocal held
        for i in chain([ids for _, ids in shard], fill, window, stats) if shard else []:
            place(*shard[i])
        shard.clear()
        held = 0

    for batch in it:
        for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
            shard.append((doc, np.frombuffer(raw.as_buffer(), "<u2").copy()))
            held += len(shard[-1][1])
            if len(shard) == SHARD_DOCS or held >= SHARD_TOKENS:
                pack()
                yield from emit()
    pack()
    finish()
    yield from emit()


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """Documents that hold each token id: partial counts per task, one row per id of the vocabulary to the driver."""

    def run(it):
        df = np.zeros(1 << 16, np.int64)
        for batch in it:
            ids = [np.frombuffer(raw.as_buffer(), "<u2") for raw in batch.column("ids")]
            for i in range(0, len(ids), 512):  # distinct (document, id) pairs of some documents at once
                some = ids[i : i + 512]
                pairs = np.sort(np.repeat(np.arange(len(some)), [len(d) for d in some]) << 16 | np.concatenate(some).astype(np.int64))
                df += np.bincount(pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] & 0xFFFF, minlength=1 << 16)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["term", "n"])

    out = np.zeros(1 << 16, np.int64)
    for r in rows.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def pack_documents(documents: DataFrame, ranks_path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ids = stored(tokenise(documents, ranks_path), "tokens")
    n, tokens = ids.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("ids")), F.lit(0)) / 2).first()
    stats = (document_frequencies(ids), n, tokens / max(n, 1))
    shards = max(1, -(-n // SHARD_DOCS), int(-(-tokens // SHARD_TOKENS)))
    dealt = ids.repartitionByRange(shards, "key", "doc_id").sortWithinPartitions("key", "doc_id").select("doc_id", "ids")
    return dealt.mapInArrow(lambda it: pack_task(it, window, stats), PIECES)
