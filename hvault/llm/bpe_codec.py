"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

A sequence of tokens is the encoding of its bytes exactly when each adjacent
pair of tokens is the encoding of the two tokens' bytes. So the encoding of a
prefix is known from its last token alone: the token before it is the last
token of the prefix that is left. For a trie of words this gives one state per
node, the last token of the node's prefix, found from the states of the nodes
above it: the one token that ends the prefix and may follow the last token of
what comes before.

The distinct words of a batch are put into the trie and walked depth first; the
trie is held as its words in preorder with the depth at which each leaves the
word before, and the states of the path to the current node are a stack. States
of a prefix that words share are computed once.

Two tokens may stand side by side when no merge joins them while both of its
parts exist: the parts at the seam are the right edge of one derivation and the
left edge of the other, each from the rank at which it is formed to the rank at
which its parent is formed (of equal ranks, the leftmost merge comes first).

Texts are cut into words by the vocabulary's split pattern. The place before a
space that a non-space follows is always a cut, so texts are first cut there,
and words of such a chunk come from a cache of bounded size when it was met
before. Characters that the installed Unicode tables do not know are cut by the
tokenizers library, whose tables may be newer. Special tokens in a text become
their ids, as the library does by default.

Defined results: null text is empty (no ids); a text that is no valid UTF-8 has
its bad bytes replaced by U+FFFD first; a null doc_id is kept; every row gives
one row; columns besides ``doc_id`` and ``text`` are ignored. Decoding skips ids
that the vocabulary does not have and replaces bytes that are no UTF-8.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import sys
import types
from itertools import chain
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 300_000  # chunks in each of the cache's two generations
SHORT = 64  # longer chunks are not kept
TEXT_STEP = 1 << 21  # characters encoded together
PAIR = (2,)
NEVER = 1 << 60  # rank at which a token that stands in the result is merged

#: Fixed value: the split pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = re.compile(r"(?= \S)")
PLAIN = re.compile("[\x00-ɏḀ-῿ -⁯぀-ヿ一-鿿가-힣]*")


def byte_symbols() -> dict[str, int]:
    """Byte that each character of a token of such a vocabulary stands for: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Cache:
    """Ids of chunks or words met lately: two generations of short entries; one with ``CACHE`` of them replaces the older.

    An entry found in the older generation is put into the newer one."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def add(self, entries) -> None:
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        self.new.update((k, v) for k, v in entries if len(k) <= SHORT)


class Codec:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.check(spec)
        symbols = byte_symbols()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        of = {text: bytes(symbols[c] for c in text) for text in vocab}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()], default=-1) + 1
        self.bytes: list[bytes] = [b""] * size
        for text, i in vocab.items():
            self.bytes[i] = of[text]
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.decimal = [str(i) for i in range(size)]
        self.rank = {}  # merge of a pair of tokens
        formed = [-1] * size  # rank at which a token is formed
        self.parts: list = [None] * size
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        for r, (a, b) in enumerate(pairs):
            a, b, c = vocab[a], vocab[b], vocab[a + b]
            if formed[a] >= r or formed[b] >= r or self.parts[c] is not None:
                raise ValueError(f"merge {r}: its parts are formed later or its token twice")
            self.rank[a, b] = r
            formed[c], self.parts[c] = r, (a, b)
        self.formed = formed
        self.right: dict = {}
        self.left: dict = {}
        self.follows: dict = {}
        # tokens that their own bytes are encoded to; others never occur in a result
        self.token: dict[bytes, int] = {}
        for text, i in sorted(vocab.items(), key=lambda v: formed[v[1]]):
            if self.parts[i] is None and len(of[text]) > 1:
                continue
            if self.parts[i] is None or (all(self.bytes[p] in self.token for p in self.parts[i]) and self.joins(*self.parts[i], formed[i])):
                self.token[of[text]] = i
        if any(bytes([b]) not in self.token for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        ends: dict = {}  # lengths of the tokens over two bytes that end in three given ones
        for t in self.token:
            if len(t) > 2:
                ends.setdefault(t[-3:], set()).add(len(t))
        self.lengths = {k: (*sorted(v, reverse=True), 2) for k, v in ends.items()}
        self.words = regex.compile(PATTERN)
        self.specials = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.chunks, self.met = Cache(), Cache()
        self._library = None

    @staticmethod
    def check(spec: dict) -> None:
        """Only byte-level vocabularies whose result depends on nothing but the merges."""
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or spec["normalizer"] or odd:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {odd}")
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in spec["added_tokens"]):
            raise ValueError("special tokens that match by more than their text")

    # --- which tokens may stand side by side

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts of a token at one of its ends (0 left, 1 right), each with the rank at which its parent is formed."""
        out, until = [], NEVER
        while True:
            out.append((token, until))
            if self.parts[token] is None:
                return out
            token, until = self.parts[token][side], self.formed[token]

    def joins(self, a: int, b: int, by: int = NEVER) -> bool:
        """True if no merge across the seam of ``a`` and ``b`` comes before rank ``by``."""
        right, left = self.right.get(a), self.left.get(b)
        if right is None:
            right = self.right[a] = self.edge(a, 1)
        if left is None:
            left = self.left[b] = self.edge(b, 0)
        get = self.rank.get
        for s, s_until in right:
            for t, t_until in left:
                r = get((s, t))
                if r is not None and r < by and r < s_until and r <= t_until:
                    return False
        return True

    # --- words

    def trie(self, words: list[bytes]) -> dict[bytes, tuple[int, ...]]:
        """Ids of distinct words: a depth-first walk over the trie of their bytes."""
        token, lengths, follows, joins = self.token, self.lengths, self.follows, self.joins
        size = [len(b) for b in self.bytes]
        out = {}
        state: list[int] = []  # last token of each prefix on the path
        before = b""
        for word in sorted(words):
            shared = len(commonprefix([before, word]))
            del state[shared:]
            for end in range(shared + 1, len(word) + 1):
                for length in lengths.get(word[end - 3 : end], PAIR) if end > 2 else PAIR:
                    if length > end:
                        continue
                    t = token.get(word[end - length : end])
                    if t is None:
                        continue
                    if length == end:
                        break
                    pair = state[end - length - 1] << 32 | t
                    may = follows.get(pair)
                    if may is None:
                        may = follows[pair] = joins(pair >> 32, t)
                    if may:
                        break
                else:  # no longer token ends here: the byte itself
                    t = token[word[end - 1 : end]]
                state.append(t)
            ids, end = [], len(word)
            while end:
                ids.append(state[end - 1])
                end -= size[ids[-1]]
            out[word] = tuple(ids[::-1])
            before = word
        if len(follows) > 4_000_000:
            follows.clear()
        return out

    def cut(self, chunk: str) -> list[str]:
        """Words of a chunk by the split pattern."""
        if chunk.isalpha() or (chunk[:1] == " " and chunk[1:].isalpha()):
            return [chunk]
        if PLAIN.fullmatch(chunk) or all(unicodedata_knows(c) for c in set(chunk)):
            return self.words.findall(chunk)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [chunk[i:j] for _, (i, j) in self._library.pre_tokenize_str(chunk)]

    def chunks_of(self, text: str) -> list:
        """Chunks of a text, special tokens as their ids."""
        if self.specials is None or not self.specials.search(text):
            return CHUNK.split(text) if text else []
        out: list = []
        for i, part in enumerate(self.specials.split(text)):
            out += [self.special[part]] if i % 2 else CHUNK.split(part) if part else []
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        chunks = [self.chunks_of(t) for t in texts]
        ids: dict = {}
        fresh = {}
        new, old = self.chunks.new, self.chunks.old
        for c in set(chain.from_iterable(chunks)):
            of = new.get(c)
            if of is None:
                of = old.get(c)
                if of is None:
                    if isinstance(c, int):
                        ids[c] = (c,)
                    else:
                        fresh[c] = self.cut(c)
                    continue
                new[c] = of
            ids[c] = of
        words, unmet = {}, []
        new, old = self.met.new, self.met.old
        for w in set(chain.from_iterable(fresh.values())):
            of = new.get(w)
            if of is None:
                of = old.get(w)
                if of is None:
                    unmet.append(w)
                    continue
                new[w] = of
            words[w] = of
        raw = [w.encode() for w in unmet]
        found = self.trie(raw)
        found = {w: found[r] for w, r in zip(unmet, raw)}
        self.met.add(found.items())
        words.update(found)
        fresh = {c: words[w[0]] if len(w) == 1 else tuple(chain.from_iterable(map(words.__getitem__, w))) for c, w in fresh.items()}
        self.chunks.add(fresh.items())
        ids.update(fresh)
        return [list(chain.from_iterable(map(ids.__getitem__, c))) for c in chunks]

    def decode(self, ids) -> str:
        try:
            raw = b"".join(map(self.bytes.__getitem__, ids)) if min(ids, default=0) >= 0 else None
        except IndexError:
            raw = None
        if raw is None:
            raw = b"".join(self.bytes[i] for i in ids if 0 <= i < len(self.bytes))
        return raw.decode("utf-8", "replace")


def unicodedata_knows(c: str) -> bool:
    import unicodedata

    return unicodedata.category(c) != "Cn"


def codec(path: str) -> Codec:
    """The vocabulary's codec; a Python worker loads it once for all tasks that it runs."""
    held = sys.modules.setdefault("_hvault_bpe_codecs", types.ModuleType("_hvault_bpe_codecs")).__dict__
    if path not in held:
        held[path] = Codec(path)
    return held[path]


def _coded(documents: DataFrame, path: str, schema: str, columns) -> DataFrame:
    """Rows of ``columns(codec, ids, decoded texts)`` behind doc_id, for each document."""

    def run(it):
        c = codec(path)
        gc.disable()  # the caches hold no cycles, and walking through them takes a tenth of the time
        try:
            yield from steps(c, it)
        finally:
            gc.enable()

    def steps(c, it):
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in it:
            docs, raw = batch.column("doc_id"), batch.column("text")
            at = 0
            while at < batch.num_rows:  # a few megabytes of whole texts at a time
                texts, size, start = [], 0, at
                while at < batch.num_rows and size < TEXT_STEP:
                    texts.append((raw[at].as_py() or b"").decode("utf-8", "replace"))
                    size, at = size + len(texts[-1]), at + 1
                ids = c.encode(texts)
                yield pa.RecordBatch.from_arrays([docs.slice(start, at - start), *columns(c, ids, [c.decode(i) for i in ids])], names=names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, ids (array of int) and decoded (the text that the ids give)."""

    def columns(c, ids, decoded):
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)), pa.array(decoded, pa.string())

    return _coded(documents, path, "doc_id long, ids array<int>, decoded string", columns)


def codec_digest(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256: digests of what ``encode_documents`` gives."""

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def columns(c, ids, decoded):
        decimal = c.decimal.__getitem__
        return pa.array([len(i) for i in ids], pa.int64()), pa.array([sha(",".join(map(decimal, i))) for i in ids]), pa.array([sha(t) for t in decoded])

    return _coded(documents, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", columns)
