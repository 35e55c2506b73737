"""Secret scan with a recursive decoding worklist.

A text is scanned for three kinds of secrets; then encoded parts are unwrapped
and what comes out is scanned again, until no new layer appears. Layers:

* ``%XX`` runs (URL), ``\\uXXXX``, ``\\UXXXXXXXX`` and ``\\xXX`` (Unicode): the
  whole layer is decoded, and every character keeps the span of the original
  text it came from;
* base64 (both alphabets; lines under each other are read joined, in runs of
  one width and each alone): the bytes are scanned as text whatever they are;
  what is found inside is mapped to the span of the encoded part;
* gzip, zlib, bzip2 and zstd streams among bytes of base64, of another stream,
  of ``%XX`` or of string escapes, to any depth: what comes out are bytes again.

A layer met before with the same span is not scanned again, so cycles end.
Escapes of escapes are unwrapped level by level; what is left after ``LEVELS``
levels (``%252525...``) goes to its last level in one pass, so the time grows
with the text and not with its square.

A stream is read in windows of ``WINDOW`` bytes while it is unpacked, so memory
does not grow with what comes out, and there is no limit on it. A window begins
with the last ``OVERLAP`` bytes before it (runs of spaces there as one), so no
secret is lost at a cut: 24 characters of a hex run, 20 of an access key and,
but for spaces, 20 of an assignment decide. Only an encoded part inside such a
stream that is itself cut may be read in pieces; ``cut_layers`` holds the spans of
streams that took more than one window.

Defined results: null text is empty; a null doc_id is kept; every row gives
one row; columns besides ``doc_id`` and ``text`` are ignored. Spans count code
points of the original text, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
WORDS = ("passw", "secret", "token", "apikey", "api_key")  # one of them is in each assignment
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs of [0-9a-f]+ of 24 or more
KINDS = ("assign", "access", "hex")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ONE_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{16,}\r?\n)+[A-Za-z0-9+/]*={0,2}|[A-Za-z0-9+/]{16,}={0,2}")
BASE64_URL = re.compile(r"(?:[A-Za-z0-9_-]{16,}\r?\n)+[A-Za-z0-9_-]*={0,2}|[A-Za-z0-9_-]{16,}={0,2}")
LINE = re.compile(r"[^\r\n]+")
MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01^\x9c\xda]|BZh[1-9]|\x28\xb5\x2f\xfd")  # gzip, zlib, bzip2, zstd
STEP = 256  # compressed bytes opened at once, so that what precedes a broken byte is kept
WINDOW = 8 << 20
OVERLAP = 1 << 20
SPACES = re.compile(rb" {2,}")
LEVELS = 8
DIGITS = frozenset("0123456789abcdefABCDEF")
MASK = "[REDACTED]"
ONE_LITERAL = re.compile(r"\\(?:x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|[0-7]{1,3}|[abefnrtv\\'\"/])")
LITERAL = re.compile(f"(?:{ONE_LITERAL.pattern})+")
LETTERS = {"a": "\a", "b": "\b", "e": "\x1b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
BYTES = re.compile("[\x00-\xff]+")


def scan(text: str) -> list[tuple[int, int, int]]:
    """Secrets of one layer as (start, kind, end), in order."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def readings(data: bytes) -> list[str]:
    """The bytes as texts to scan, whatever they are.

    Secrets and the marks of layers are ASCII, and a broken byte is replaced
    without touching the ASCII around it: so UTF-8 with replacement also serves
    Latin-1. Without its zero bytes, so does UTF-16 or UTF-32 of either order,
    with or without BOM and wherever it begins."""
    out = [data.decode("utf-8", "replace")]
    if b"\0" in data:
        out.append(data.replace(b"\0", b"").decode("utf-8", "replace"))
    return out


def unpacked(data: bytes, at: int):
    """The content of the compressed stream at ``at`` in windows, as (content, how far the stream was read, is it cut here).

    What comes before a broken byte counts; the window that ends the stream comes last, even if it is empty."""
    import zstandard

    head = data[at : at + 1]
    d = bz2.BZ2Decompressor() if head == b"B" else zstandard.ZstdDecompressor().decompressobj() if head == b"\x28" else zlib.decompressobj(47)
    out = bytearray()
    while at < len(data) and not d.eof:
        part = data[at : at + STEP]
        try:
            out += d.decompress(part)
        except (zlib.error, OSError, EOFError, zstandard.ZstdError):
            break
        at += len(part)
        if len(out) > WINDOW:
            yield bytes(out), at, True
            out = bytearray(SPACES.sub(b" ", out)[-OVERLAP:])
    yield bytes(out), at - len(d.unused_data), False


def streams(data: bytes):
    """The compressed streams in ``data`` as (content, begin, end, is it cut here), one after the other, wherever they begin."""
    m = MAGIC.search(data)
    while m:
        got = False
        for out, end, cut in unpacked(data, m.start()):
            if out:
                got = True
                yield out, m.start(), end, cut
        m = MAGIC.search(data, max(end, m.start() + 1) if got else m.start() + 1)


def from_base64(part: str) -> bytes:
    """The bytes of base64 text; a last character that completes no byte is left out."""
    part = part.replace("\r", "").replace("\n", "").rstrip("=")
    part = part[: len(part) - (len(part) % 4 == 1)]
    try:
        return base64.b64decode(part + "=" * (-len(part) % 4), "-_" if "-" in part or "_" in part else None, validate=True)
    except (binascii.Error, ValueError):
        return b""


def line_ranges(text: str) -> set[tuple[int, int]]:
    """The places in a block of base64 lines that may each be one encoded part.

    These are the block, each of its lines, and each run of lines of one width
    with and without the shorter line that follows. Where the width is no
    multiple of four, runs are also read from their second to fourth line, for
    the lines before may belong to something else."""
    lines = [m.span() for m in LINE.finditer(text)]
    out = {(0, len(text)), (0, lines[-1][1]), *lines}
    begin = 0
    while begin < len(lines):
        width = lines[begin][1] - lines[begin][0]
        stop = begin + 1
        while stop < len(lines) and lines[stop][1] - lines[stop][0] == width:
            stop += 1
        ends = [lines[stop - 1][1]]
        if stop < len(lines) and lines[stop][1] - lines[stop][0] < width:
            ends.append(lines[stop][1])
        for i in range(begin, min(stop, begin + (4 if width % 4 else 1))):
            out.update((lines[i][0], e) for e in ends)
        begin = stop
    return {(a, b) for a, b in out if b - a >= 16}


class Layer:
    """Text of a layer; ``first`` and ``end`` hold the original span of each character, or one span holds for all."""

    def __init__(self, text: str, first=None, end=None, whole=None, level=0):
        self.text, self.first, self.end, self.whole, self.level = text, first, end, whole, level

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        return (a, b) if self.first is None else (self.first[a], self.end[b - 1])

    def decoded(self, pattern, decode):
        """This layer with each match of ``pattern`` replaced; every new character keeps its origin."""
        out, first, end, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            got = decode(m[0])  # (text, begin, end) parts within the match
            if got is None:
                continue
            for a, b, t in [(at, m.start(), None), *[(m.start() + a, m.start() + b, t) for a, b, t in got]]:
                if t is None:
                    out.append(self.text[a:b])
                    if not self.whole:
                        first += range(a, b) if self.first is None else self.first[a:b]
                        end += range(a + 1, b + 1) if self.first is None else self.end[a:b]
                else:
                    out.append(t)
                    s, e = self.span(a, b)
                    first += [s] * len(t)
                    end += [e] * len(t)
            at = m.end()
        if not out:
            return None
        out.append(self.text[at:])
        if self.whole:
            return Layer("".join(out), whole=self.whole, level=self.level + 1)
        n = len(self.text)
        first += range(at, n) if self.first is None else self.first[at:]
        end += range(at + 1, n + 1) if self.first is None else self.end[at:]
        return Layer("".join(out), first, end, level=self.level + 1)

    def settled(self):
        """This layer with its escapes, those that decoding completes included, at their last level.

        A character is taken at a time; as soon as the last ones are an escape its character takes their place, and
        may end an escape in turn. Bytes of %XX become the characters of their number."""
        out, first, end = [], [], []
        for i, c in enumerate(self.text):
            s, e = self.span(i, i + 1)
            while True:
                out.append(c)
                first.append(s)
                end.append(e)
                n = escape_at_end(out) if c in DIGITS else 0
                code = int("".join(out[2 - n if n > 3 else -2 :]), 16) if n else 0
                if not n or code >= 0x110000 or 0xD800 <= code < 0xE000:
                    break
                c, s = chr(code), first[-n]
                del out[-n:], first[-n:], end[-n:]
        return Layer("".join(out), None if self.whole else first, None if self.whole else end, self.whole, LEVELS + 1)


def escape_at_end(out: list[str]) -> int:
    """How many of the last characters are one escape; 0 if they are none."""
    for mark, n in (("%", 3), ("\\x", 4), ("\\u", 6), ("\\U", 10)):
        if len(out) >= n and "".join(out[-n : len(mark) - n]) == mark and DIGITS.issuperset(out[len(mark) - n :]):
            return n
    return 0


def url_parts(run: str):
    """Characters of a run of %XX with their places; bytes that are no UTF-8 stay as they are."""
    data = bytes.fromhex(run.replace("%", ""))
    out, at = [], 0
    while at < len(data):
        size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
        try:
            out.append((3 * at, 3 * (at + size), data[at : at + size].decode()))
        except UnicodeDecodeError:
            size = 1
            out.append((3 * at, 3 * at + 3, run[3 * at : 3 * at + 3]))
        at += size
    return out if any(t[0] != "%" or len(t) == 1 for _, _, t in out) else None


def url_bytes(run: str):
    """Each %XX of a run as the character of its byte, when the run is no UTF-8."""
    data = bytes.fromhex(run.replace("%", ""))
    try:
        data.decode()
    except UnicodeDecodeError:
        return [(3 * i, 3 * i + 3, chr(c)) for i, c in enumerate(data)]
    return url_parts(run)


def escape_parts(run: str):
    """The escapes of a string literal, those of single letters included."""
    out = []
    for m in ONE_LITERAL.finditer(run):
        t = m[0][1:]
        code = int(t[1:], 16) if t[0] in "xuU" else int(t, 8) if t[0] in "01234567" else ord(LETTERS.get(t, t))
        out.append((m.start(), m.end(), chr(code) if code < 0x110000 else m[0]))
    return out


def unicode_parts(run: str):
    out = []
    for m in ONE_ESCAPE.finditer(run):
        code = int(m[1] or m[2] or m[3], 16)
        if 0xDC00 <= code < 0xE000 and out and isinstance(out[-1][2], int):
            a, _, high = out.pop()
            out.append((a, m.end(), chr(0x10000 + ((high - 0xD800) << 10) + (code - 0xDC00))))
        else:
            out.append((m.start(), m.end(), code if 0xD800 <= code < 0xDC00 else chr(code) if code < 0xD800 or 0xE000 <= code < 0x110000 else m[0]))
    return [(a, b, run[a:b] if isinstance(t, int) else t) for a, b, t in out]


def inside(item, cuts: set):
    """The layers in a layer (or in bytes with the span they come from), one after the other."""
    if isinstance(item, tuple):
        data, whole = item
        for t in readings(data):
            yield Layer(t, whole=whole)
        for got, _, _, cut in streams(data):
            if cut:
                cuts.add(whole)
            yield got, whole
        return
    t = item.text
    nexts, packed = [], []
    if item.level > LEVELS:
        packed.append(item)
    elif item.level == LEVELS:
        nexts.append(item.settled() if "%" in t or "\\" in t else None)
    if item.level <= LEVELS and "%" in t and URL.search(t):
        if item.level < LEVELS:
            nexts.append(item.decoded(URL, url_parts))
        packed.append(item.decoded(URL, url_bytes))
        if packed[0] and "+" in t:  # a space in forms
            packed.append(Layer(packed[0].text.replace("+", " "), packed[0].first, packed[0].end, packed[0].whole))
    if "\\" in t and item.level < LEVELS and UNICODE.search(t):
        nexts.append(item.decoded(UNICODE, unicode_parts))
    if "\\" in t and LITERAL.search(t):
        packed.append(item.decoded(LITERAL, escape_parts))
    for one in packed:
        for m in BYTES.finditer(one.text) if one else ():
            for got, a, b, cut in streams(m[0].encode("latin-1")):
                whole = one.span(m.start() + a, m.start() + b)
                if cut:
                    cuts.add(whole)
                yield got, whole
    for pattern in (BASE64, BASE64_URL) if "-" in t or "_" in t else (BASE64,):
        for m in pattern.finditer(t):
            if pattern is BASE64_URL and "-" not in m[0] and "_" not in m[0]:
                continue
            for a, b in line_ranges(m[0]):
                data = from_base64(m[0][a:b])
                if data:
                    yield data, item.span(m.start() + a, m.start() + b)
    for x in nexts:
        if x is not None and x.text != t:
            yield x


def marked(item) -> tuple:
    """What makes a layer the same as one met before: content, span, level."""
    if isinstance(item, tuple):
        return hashlib.blake2b(item[0], digest_size=16).digest(), item[1], "bytes"
    t = item.text.encode("utf-8", "surrogatepass")
    span = item.whole or (item.first[0], item.end[-1]) if t else None
    return hashlib.blake2b(t, digest_size=16).digest(), span, item.level


def every_span(text: str) -> tuple[list, list, list]:
    """Base spans of a text, base with decoded spans, each sorted (start, kind, end), and the spans of cut streams.

    The worklist is a stack of layers that are still being taken apart: of a long stream, only one window exists."""
    base = scan(text)
    found, seen, cuts = set(base), set(), set()
    work = [inside(Layer(text), cuts)]
    while work:
        item = next(work[-1], None)
        if item is None:
            work.pop()
            continue
        mark = marked(item)
        if mark in seen:
            continue
        seen.add(mark)
        if isinstance(item, Layer):
            for a, kind, b in scan(item.text):
                s, e = item.span(a, b)
                found.add((s, kind, e))
        work.append(inside(item, cuts))
    return base, sorted(found), sorted(cuts)


def all_spans(text: str) -> tuple[list, list]:
    """Base spans of a text, and base with decoded spans, each sorted (start, kind, end)."""
    return every_span(text)[:2]


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, cut_layers (start:end of streams read in windows) of every document."""

    def run(it):
        schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("cut_layers", pa.string())])
        for batch in it:
            out = [[] for _ in schema]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                base, spans, cuts = every_span(text.as_py() or "")
                kinds = [k for _, k, _ in base]
                for c, v in zip(out, (doc, kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), ",".join(f"{s}:{e}" for s, e in cuts))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, cut_layers string")


def masked(text: str) -> str:
    """The text with every span (overlapping ones together) replaced by MASK."""
    _, spans = all_spans(text)
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join(out) + text[at:] if spans else text


def redact_secrets(documents: DataFrame) -> DataFrame:
    """``documents`` with masked texts; other columns as they are (null text stays null, ``n_chars`` follows the text if present)."""
    names = documents.columns

    def run(it):
        for batch in it:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else masked(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)], names=names)

    out = documents.mapInArrow(run, documents.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(documents.schema["n_chars"].dataType))
    return out.select(*names)
