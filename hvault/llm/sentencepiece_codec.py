"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps, for each text, an agenda of adjacent symbol pairs ordered by
the score of the piece they would form (leftmost first among equals); the best
pair is merged and the pairs at its sides are looked up anew, until no pair is
a piece. Symbols without a piece become byte pieces. Texts are first cut where
no piece of the vocabulary reaches across (before a run of word marks, around
line ends), so an agenda belongs to one short chunk; chunks met before come
from a bounded cache. The agendas of all new chunks of a batch advance together,
as one flat array of symbols and one of pair ranks; chunks over ``WIDE``
characters use a heap, so a text without cuts takes n log n steps.

Arrow batches are checked against the sentencepiece library: every chunk that is
encoded anew, and the first megabyte of each batch as whole texts
(``check="whole"``: all texts). ``agrees`` says whether the library gave the
same ids; if not, the library's ids are returned.

Defined results: null text is empty (no ids); a null doc_id is kept; every row
gives one row; columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # stands for a space in pieces
WIDE = 64
CACHE = 400_000  # chunks in each of the cache's two generations
NONE = 1 << 40  # rank of a pair that forms no piece
TEXT_STEP = 1 << 21  # characters encoded together


class Agenda:
    """Encoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.piece = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.score = [sp.get_score(i) for i in range(n)]
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.n = n
        pairs = {}
        for p, i in self.piece.items():
            for k in range(1, len(p)):
                a, b = self.piece.get(p[:k]), self.piece.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = i
        self.pairs = pairs
        # dense ranks, the highest score first; equal scores share a rank
        order = {v: r for r, v in enumerate(sorted({-self.score[i] for i in pairs.values()}))}
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.ranks = np.array([order[-self.score[i]] for i in self.merged.tolist()], np.int64)
        self.of_code = np.full(0x110000, -1, np.int32)
        for p, i in self.piece.items():
            if len(p) == 1:
                self.of_code[ord(p)] = i
        # chunks may be cut only where no piece reaches across, and need each character of a piece to be a piece
        whole = all(c in self.piece for p in self.piece for c in p)
        marks = not any(MARK in p.lstrip(MARK) for p in self.piece)
        line = not any("\n" in p for p in self.piece)
        if not whole:
            raise ValueError("the vocabulary lacks single characters of its pieces")
        self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if line else f"{MARK}*[^{MARK}]+|{MARK}+") if marks else re.compile("(?s).+")
        self.new: dict = {}
        self.old: dict = {}
        self.wrong: set = set()  # chunks in which the library gave other ids

    def first_symbols(self, chunk: str) -> list[int]:
        """Piece of each character; a character without one gets a number above all pairs' keys."""
        get, above = self.piece.get, self.n * self.n
        return [get(c) or above + ord(c) for c in chunk]

    def to_ids(self, symbols: list[int]) -> list[int]:
        above = self.n * self.n
        if max(symbols) < above:
            return symbols
        out: list[int] = []
        for s in symbols:
            if s < above:
                out.append(s)
            else:
                out.extend(self.byte[b] for b in chr(s - above).encode())
        return out

    def by_heap(self, chunk: str) -> list[int]:
        sym = self.first_symbols(chunk)
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list = []
        score, pairs, width = self.score, self.pairs, self.n

        def offer(i):
            j = nxt[i]
            if j < n:
                m = pairs.get(sym[i] * width + sym[j])
                if m is not None:
                    heapq.heappush(heap, (-score[m], i, sym[i], sym[j], m))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = nxt[i]
            if gone[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], gone[j] = m, True
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return self.to_ids([s for s, g in zip(sym, gone) if not g])

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that each pair of symbols forms (NONE without one), and the piece."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.merged[at]

    def together(self, chunks: list[str]) -> list[tuple]:
        """Ids of many short chunks: each round merges the best pair (leftmost among equals) of every chunk that has one."""
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        sym = self.of_code[codes].astype(np.int64)
        unknown = sym < 0
        sym[unknown] = self.n * self.n + codes[unknown]
        chunk = np.repeat(np.arange(len(chunks)), np.fromiter(map(len, chunks), np.int64, len(chunks)))
        rank = np.full(len(sym), NONE, np.int64)
        inner = np.flatnonzero(chunk[1:] == chunk[:-1])
        rank[inner] = self.look(sym[inner], sym[inner + 1])[0]
        done_sym, done_chunk = [], []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            over = best == NONE
            if over.any():
                done_sym.append(sym[over])
                done_chunk.append(chunk[over])
                live = ~over
                sym, chunk, rank, best = sym[live], chunk[live], rank[live], best[live]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == best)
            hit = hit[np.concatenate([[True], chunk[hit[1:]] != chunk[hit[:-1]]])]
            sym[hit] = self.look(sym[hit], sym[hit + 1])[1]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            sym, chunk, rank = sym[stay], chunk[stay], rank[stay]
            at = hit - np.arange(len(hit))  # one symbol has gone from each chunk before
            rank[at] = NONE
            for left in (at, at - 1):
                left = left[(left >= 0) & (left + 1 < len(sym))]
                left = left[chunk[left] == chunk[left + 1]]
                rank[left] = self.look(sym[left], sym[left + 1])[0]
        chunk = np.concatenate(done_chunk)
        order = np.argsort(chunk, kind="stable")
        sym, ends = np.concatenate(done_sym)[order], np.searchsorted(chunk[order], np.arange(len(chunks) + 1)).tolist()
        flat, above = sym.tolist(), bool((sym >= self.n * self.n).any())
        parts = [flat[a:b] for a, b in zip(ends, ends[1:])]
        return [tuple(self.to_ids(p)) for p in parts] if above else [tuple(p) for p in parts]

    def by_library(self, chunks: list[str]) -> list[list[int]]:
        """The library's ids of chunks. It puts a mark before a text, so a chunk is given without its own, or after a line end."""
        marked = self.library.encode([c[1:].replace(MARK, " ") if c[0] == MARK else "\n" + c for c in chunks], num_threads=1)
        skip = len(self.library.encode("\n"))
        return [ids if c[0] == MARK else ids[skip:] for c, ids in zip(chunks, marked)]

    def encode(self, texts: list[str], check: bool = False) -> tuple[list[list[int]], list[bool]]:
        """Ids of each text, and whether all its chunks agreed with the library (when ``check``)."""
        cuts = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.new) > CACHE:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        fresh = []
        for c in set().union(*cuts):
            if c not in new:
                if c in old:
                    new[c] = old[c]
                else:
                    fresh.append(c)
        short = [c for c in fresh if len(c) <= WIDE]
        if short:
            new.update(zip(short, self.together(short)))  # tuples of ints leave the garbage collector
        for c in fresh:
            if len(c) > WIDE:
                new[c] = tuple(self.by_heap(c))
        if check:
            fresh = [c for c in fresh if c != MARK and c != "\n"]  # single symbols; the library gives no mark to an empty text
            for c, theirs in zip(fresh, self.by_library(fresh)):
                if new[c] != tuple(theirs):
                    self.wrong.add(c)
                    new[c] = tuple(theirs)
        out = []
        for chunks in cuts:
            ids: list[int] = []
            for c in chunks:
                ids += new[c]
            out.append(ids)
        return out, [not self.wrong or self.wrong.isdisjoint(chunks) for chunks in cuts]


def encoded(it, model: str, check: str = "chunks"):
    """Arrow batches of (doc_id, text) to lists (doc_ids, ids, decoded texts, agrees) of about TEXT_STEP characters each."""
    agenda = Agenda(model)
    library = agenda.library
    for batch in it:
        docs, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        at = 0
        while at < len(docs):
            part, size = [], 0
            while at + len(part) < len(docs) and (size < TEXT_STEP or not part):
                part.append(texts[at + len(part)].as_py() or "")
                size += len(part[-1])
            ids, agrees = agenda.encode(part, check != "none")
            if check == "whole" or check == "chunks" and not at:
                theirs = library.encode(part, num_threads=1)
                agrees = [a and x == y for a, x, y in zip(agrees, ids, theirs)]
                ids = theirs
            yield docs[at : at + len(part)], ids, library.decode(ids, num_threads=1), agrees
            at += len(part)


class Numbers(dict):
    """Decimal text of each id met."""

    def __missing__(self, i: int) -> str:
        self[i] = text = str(i)
        return text


def arrow(columns, schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def encode_documents(documents: DataFrame, model: str, check: str = "chunks") -> DataFrame:
    """doc_id, ids, decoded, agrees for each document; ``model`` is a sentencepiece model file present on all
    executors, ``check`` is "chunks", "whole" or "none"."""

    def run(it):
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("agrees", pa.bool_())])
        for columns in encoded(it, model, check):
            yield arrow(columns, schema)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string, agrees boolean")


def codec_digest(documents: DataFrame, model: str, check: str = "chunks") -> DataFrame:
    """The registered query's columns: doc_id, n_tokens, ids_sha256, decoded_sha256, agrees."""

    def run(it):
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("agrees", pa.bool_())])
        number = Numbers()
        for docs, ids, decoded, agrees in encoded(it, model, check):
            ids_sha = [hashlib.sha256(",".join([number[i] for i in x]).encode()).hexdigest() for x in ids]
            text_sha = [hashlib.sha256(t.encode()).hexdigest() for t in decoded]
            yield arrow((docs, [len(x) for x in ids], ids_sha, text_sha, agrees), schema)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")
