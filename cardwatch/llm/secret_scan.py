"""Secret scan with a worklist of decoded layers.

A text is scanned for secrets.  Then every encoded part of it (lines with URL or
Unicode escapes as a whole; runs of base64, in one line or folded over several;
compressed data inside those, however often it is packed) is decoded into a new layer,
which is scanned and searched for encoded parts in turn, until the worklist is empty.  A
layer seen before is not taken again, so the work ends even if decoding goes round in a
cycle.  Each character of a layer carries its span in the original text: escapes map
character by character, base64 and compressed data as a whole.  A secret of an inner layer
is reported at the span it maps to, as a kind of its own (``url-assign`` and so on) unless
the same span is a base find already.

A run of base64 may begin inside a longer run of its characters (a path, a key's name):
it is read at all four phases, and compressed data from wherever its first bytes stand.
What it holds need not be text: bytes that are no UTF-8 are passed over, UTF-16 is read
without its zero bytes, and of packed data all members are read, and what there is of
truncated ones.

Base kinds, leftmost and non-overlapping each: ``assign``, ``access``, ``hex``; own
kinds after them.  Spans are code points, end exclusive, ordered by start, kind, end.

Each text is scanned alone: nothing is shuffled, and memory follows the largest text of a
batch.  Packed data is unpacked and scanned ``PIECE`` bytes at a time, whatever its size;
pieces end at characters that no secret and no encoded part holds, so nothing is cut.
Only a single run of other characters is cut, where it is longer than ``LONGEST``.  Null
and empty texts have no spans; repeated rows give a row each; an empty table an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Iterator
from io import StringIO
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

# The patterns of the base kinds and of the kinds added here.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MORE = (("github", b"gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
        ("slack", b"xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
        ("google", b"AIza", re.compile(r"\bAIza[A-Za-z0-9_-]{35}")),
        ("jwt", b"eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
        ("private-key", b"-----BEGIN", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*-----END [A-Z ]*PRIVATE KEY-----)?")))
BASE_KINDS = ("assign", "access", "hex")
#: Bytes of packed data that are unpacked and scanned at a time, and the longest run of base64 or the like among them.
PIECE = 1 << 20
LONGEST = 64 << 20

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_RUN = bytes.maketrans(bytes(range(256)), bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256)))
_B64_RUN = bytes.maketrans(bytes(range(256)), bytes(1 if chr(i).isascii() and (chr(i).isalnum() or chr(i) in "+/_-") else 0 for i in range(256)))
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_B64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Bytes that no text has; what may stand before base64 though base64 has it too.
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_NO_TEXT = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\ufffd]")
_SEPARATOR = re.compile(r"[/_-]")
_STANDARD = str.maketrans("-_", "+/")
#: What secrets and encoded parts are made of; any other character ends them.
_OPEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.%:-\"'\\{}&#; \t\r\n"
#: How packed data begins in base64: gzip, zlib, bzip2, xz.
_PACKED = re.compile(r"(?=H4sI|eAE|eF4|eJw|eNo|Qlpo|/Td6WFoA)")
_ERRORS = (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError)
#: Between the lines of folded base64, and its first and last lines if shorter than a run.
_FOLD = re.compile(r"[ \t]*\r?\n[ \t]*")
_HEAD = re.compile(r"(?<![A-Za-z0-9+/=_-])([A-Za-z0-9+/_-]{1,15})[ \t]*\r?\n\Z")
_TAIL = re.compile(r"[ \t]*\r?\n[ \t]*([A-Za-z0-9+/_-]{1,15}={0,2})(?![A-Za-z0-9+/=_-])")


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets that stand in ``text`` as it is."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    out = []
    if any(k in low for k in _KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"\x01" * 24 in raw.translate(_HEX_RUN):
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
    for kind, sign, pattern in MORE:
        if sign in raw:
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


class Spans:
    """The span of each character of a layer in the text that it was decoded from, 16 bytes a character."""

    def __init__(self, start: np.ndarray, end: np.ndarray):
        self.start, self.end = start, end

    def __getitem__(self, part: tuple[int, int]) -> tuple[int, int]:
        return int(self.start[part[0]]), int(self.end[part[1] - 1])

    def after(self, inner: Spans) -> Spans:
        """Spans of a layer whose characters have the spans ``inner`` in this one."""
        return Spans(self.start[inner.start], self.end[inner.end - 1])


def _mapped(line: str, at: int, pattern: re.Pattern, decode) -> tuple[str, Spans] | None:
    """``line`` with what ``pattern`` finds decoded, and each character's span."""
    text, starts, ends, last = StringIO(), array("q"), array("q"), 0
    undecoded = np.ones(len(line), bool)
    for m in pattern.finditer(line):
        piece = decode(m)
        if piece is None:
            continue
        chars, bounds = piece
        text.write(line[last:m.start()])
        text.write(chars)
        for a, b in pairwise(bounds):
            starts.append(m.start() + a)
            ends.append(m.start() + b)
        last = m.end()
        undecoded[m.start():last] = False
    if not starts:
        return None
    text.write(line[last:])
    own = np.flatnonzero(undecoded)  # stand for themselves; both begin and end in their order
    return text.getvalue(), Spans(np.sort(np.r_[own, starts]) + at, np.sort(np.r_[own + 1, ends]) + at)


def _url_piece(m: re.Match) -> tuple[str, list[int]] | None:
    """What an escape stands for, and where its characters begin in it (with the end).  Bytes that are
    not UTF-8 stay as they are."""
    run = m[0]
    out, bounds, at = [], [0], 0
    for c in bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape"):
        if "\udc80" <= c <= "\udcff":
            out.append(run[at:at + 3])
            bounds += (at + 1, at + 2, at + 3)
            at += 3
        else:
            out.append(c)
            at += 3 * len(c.encode())
            bounds.append(at)
    chars = "".join(out)
    return (chars, bounds) if chars != run else None


def _unicode_piece(m: re.Match) -> tuple[str, list[int]] | None:
    code = int(next(g for g in m.groups()[:4] if g), 16) if m[5] is None else int(m[5])
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), [0, len(m[0])]


def _opener(head: bytes):
    """The kind of packed data that begins like this, and what makes its decompressor."""
    if head[:2] == b"\x1f\x8b" or (head[:1] == b"\x78" and len(head) > 1 and (head[0] << 8 | head[1]) % 31 == 0):
        return "zlib", lambda: zlib.decompressobj(47)
    if head[:3] == b"BZh":
        return "bz2", bz2.BZ2Decompressor
    if head[:6] == b"\xfd7zXZ\x00":
        return "xz", lzma.LZMADecompressor
    return None


def _steps(d, data: bytes) -> Iterator[bytes]:
    """What a decompressor makes of ``data``, at most ``PIECE`` bytes at a time."""
    while True:
        out = d.decompress(data, PIECE)
        yield out
        data = getattr(d, "unconsumed_tail", b"")
        if d.eof or not (data or len(out) == PIECE or not getattr(d, "needs_input", True)):
            return


def _unpacked(chunks: Iterator[bytes], make) -> Iterator[bytes]:
    """Packed data unpacked: its members one after the other, then what follows them as it is.  It ends
    where the data is damaged."""
    d = make()
    for chunk in chunks:
        while chunk:
            if d is None:
                found = _opener(chunk)
                if not found:
                    yield chunk
                    yield from chunks
                    return
                d = found[1]()
            try:
                yield from _steps(d, chunk)
            except _ERRORS:
                return
            if not d.eof:
                break
            chunk, d = d.unused_data, None


def _text(data: bytes) -> tuple[str, bool]:
    """``data`` as text, and whether it is one: no control characters, nothing that is no UTF-8."""
    if data.count(0) * 4 > len(data):  # UTF-16: of its ASCII characters the other half
        data = data.replace(b"\0", b"")
    text = data.decode("utf-8", "replace")
    return text, "\ufffd" not in text and not _CONTROL.search(text)


def _pieces(chunks: Iterator[bytes]) -> Iterator[str]:
    """The text of a byte stream in parts that no secret and no encoded part reaches over."""
    decoder, wide, held = codecs.getincrementaldecoder("utf-8")("replace"), None, ""
    for chunk in chunks:
        wide = chunk.count(0) * 4 > len(chunk) if wide is None else wide
        held += decoder.decode(chunk.replace(b"\0", b"") if wide else chunk)
        if len(held) >= PIECE:
            cut = len(held.rstrip(_OPEN)) or (len(held) if len(held) >= LONGEST else 0)
            if cut:
                yield held[:cut]
                held = held[cut:]
    if held := held + decoder.decode(b"", True):
        yield held


def _contents(source, hows: tuple[str, ...], seen: set[bytes]) -> Iterator[tuple[str, str]]:
    """The kind and the text, in pieces, of a stream that ``source()`` begins anew, unpacked until it is no longer
    packed; nothing if it isn't packed at all."""
    head = next((c for c in source() if c), b"")
    key = hashlib.sha1(head).digest()
    if not head or key in seen:  # some data unpacks to itself
        return
    seen.add(key)
    found = _opener(head)
    if not found and not _text(head)[1]:  # deflate without a header tells itself only by what comes out
        found = "deflate", lambda: zlib.decompressobj(-15)
    if found:
        def inner() -> Iterator[bytes]:
            return _unpacked(source(), found[1])

        first = next((c for c in inner() if c), b"")
        if first and (found[0] != "deflate" or _text(first)[1] or _opener(first)):
            yield from _contents(inner, (*hows, found[0]), seen)
            return
    if hows:
        for piece in _pieces(source()):
            yield "-".join(hows), piece


def _source(body: str):
    """What begins the stream of the bytes of ``body``, base64 without padding, anew."""
    whole = len(body) - (len(body) % 4 == 1)

    def chunks() -> Iterator[bytes]:
        for at in range(0, whole, PIECE):
            part = body[at:min(at + PIECE, whole)]
            yield base64.b64decode(part + "=" * (-len(part) % 4))

    return chunks


def _strict(run: str) -> list[tuple[str, str]]:
    """Kind and text of a run of base64 that is one from its first character to its last: packed data, or a text."""
    body = run.rstrip("=").translate(_STANDARD)
    if len(body) % 4 == 1:
        return []
    if _PACKED.match(body) and (packed := list(_contents(_source(body), (), set()))):
        return packed
    data = base64.b64decode(body + "=" * (-len(body) % 4))
    packed = [] if _text(data)[1] else list(_contents(lambda: iter([data]), (), set()))
    text, clean = _text(data)
    return packed or ([("base64", text)] if clean else [])


def _within(run: str) -> Iterator[tuple[str, str, int]]:
    """(kind, text, where it begins) of what a run of base64 characters may hold: packed data from where its first
    bytes stand, and bytes at the four phases, from the first separator on after which they are text; else all of them."""
    body = run.rstrip("=").translate(_STANDARD)
    for m in _PACKED.finditer(body):
        for how, text in _contents(_source(body[m.start():]), (), set()):
            yield how, text, m.start()
    for phase in range(4):
        part = body[phase:]
        if len(part) < 8:
            return
        data = base64.b64decode(part[:len(part) - (len(part) % 4 == 1)] + "=" * (-len(part) % 4 % 3))
        text, clean = _text(data)
        if clean and not phase:
            yield "base64", text, 0
            return
        packed = False
        if not clean and not phase:
            for how, text_inside in _contents(lambda data=data: iter([data]), (), set()):
                packed = True
                yield how, text_inside, 0
        if packed:
            return
        # from the back: the longest tail that is text, and the first separator in it
        odd = len(data) - len(text[max((m.end() for m in _NO_TEXT.finditer(text)), default=0):].encode())
        starts = (m.end() for m in _SEPARATOR.finditer(run, max(0, phase - 1 + odd // 3 * 4))
                  if (m.end() - phase) % 4 == 0 and (m.end() - phase) // 4 * 3 >= odd)
        at = next(starts, None)
        if at is not None and (tail := _text(data[(at - phase) // 4 * 3:]))[1] and len(tail[0]) >= 8:
            yield "base64", tail[0], at
        else:
            yield "base64", text, 0


def _folded(text: str, runs: list[tuple[int, int]]) -> Iterator[tuple[str, str, tuple[int, int]]]:
    """Layers of base64 that is folded over lines: runs of one width, with the line before (which may begin with
    something else) and the last line where they decode with them; else all runs in a row."""
    chains: list[list[tuple[int, int]]] = []
    for a, b in runs:
        if chains and text[chains[-1][-1][1] - 1] != "=" and _FOLD.fullmatch(text, chains[-1][-1][1], a):
            chains[-1].append((a, b))
        else:
            chains.append([(a, b)])
    for parts in chains:
        a, b = parts[0][0], parts[-1][1]
        inner = range(len(parts))
        before = a
        while before and text[before - 1] in " \t":
            before -= 1
        if before and text[before - 1] == "\n" and (m := _HEAD.search(text, max(0, before - 256), before)):
            parts = [m.span(1), *parts]
            inner = range(1, len(parts))
        if text[b - 1] != "=" and (m := _TAIL.match(text, b)):
            parts = [*parts, m.span(1)]
        if len(parts) < 2:
            continue
        width = [e - s for s, e in parts]
        starts = [i for i in inner if i == inner[0] or width[i] != width[i - 1]]
        blocks = list(zip(starts, [i - 1 for i in starts[1:]] + [inner[-1]]))
        covered: set[int] = set()
        for i, j in [*sorted(blocks, key=lambda x: x[0] - x[1]), (inner[0], inner[-1])]:
            if covered.issuperset(range(i, j + 1)):
                continue
            firsts, lasts = [i - 1, i] if i else [i], [j + 1, j] if j + 1 < len(parts) else [j]
            for first, last in ((f, t) for f in firsts for t in lasts if t > f):
                if found := _strict("".join(text[s:e] for s, e in parts[first:last + 1])):
                    for layer in found:
                        yield *layer, (parts[first][0], parts[last][1])
                    covered.update(range(first, last + 1))
                    break
        if not covered:  # no text as a whole: whatever the run of all lines holds
            whole = parts[inner[0]:inner[-1] + 1]
            for first in {0, inner[0]}:
                for how, layer, _ in _within("".join(text[s:e] for s, e in parts[first:])):
                    yield how, layer, (whole[0][0], parts[-1][1])


def _layers(text: str) -> Iterator[tuple[str, str, Spans | tuple[int, int]]]:
    """(how, decoded text, spans in ``text``): a span for each character, or one for all."""
    for how, pattern, decode, sign in (("unicode", _UNICODE, _unicode_piece, ("\\u", "\\x", "&#")), ("url", _URL, _url_piece, "%")):
        if not any(s in text for s in ([sign] if isinstance(sign, str) else sign)):
            continue
        at = 0
        for line in text.split("\n"):
            if found := _mapped(line, at, pattern, decode):
                yield how, *found
            at += len(line) + 1
    raw = text.encode("utf-8", "surrogatepass")
    if b"\x01" * 16 not in raw.translate(_B64_RUN):
        return
    runs = [m.span() for m in _B64.finditer(text)]
    for a, b in runs:
        for how, layer, at in _within(text[a:b]):
            yield how, layer, (a + at, b)
    yield from _folded(text, runs)


def spans_of(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, is base find) of all secrets, ordered by start, kind, end."""
    text = text or ""
    order = {k: i for i, k in enumerate((*BASE_KINDS, *(k for k, _, _ in MORE)))}
    own = find(text)
    found = {(k, a, b): k in BASE_KINDS for k, a, b in own}
    plain = set(found)
    seen = {hashlib.sha1(text.encode("utf-8", "surrogatepass")).digest()}
    # the worklist: layers that are still to come, of each layer that is being worked on (one piece of each is held)
    work = [("", _layers(text), None)]
    while work:
        outer, layers, outer_spans = work[-1]
        how, layer, spans = next(layers, (None, None, None))
        if how is None:
            work.pop()
            continue
        how = f"{outer}-{how}" if outer else how
        if isinstance(outer_spans, tuple):
            spans = outer_spans
        elif outer_spans is not None:
            spans = outer_spans[spans] if isinstance(spans, tuple) else outer_spans.after(spans)
        if not layer:
            continue
        key = hashlib.sha1(f"{spans if isinstance(spans, tuple) else spans[0, 1]}\0{layer}".encode("utf-8", "surrogatepass")).digest()
        if key in seen:
            continue
        seen.add(key)
        for kind, a, b in find(layer):
            place = spans if isinstance(spans, tuple) else spans[a, b]
            if (kind, *place) not in plain:
                found.setdefault((f"{how}-{kind}", *place), False)
        work.append((how, _layers(layer), spans))
    return sorted(((k, a, b, base) for (k, a, b), base in found.items()),
                  key=lambda x: (x[1], order.get(x[0], len(order)), x[0], x[2]))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` array<struct<kind, start, end, base>> for each row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans_of(t)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
