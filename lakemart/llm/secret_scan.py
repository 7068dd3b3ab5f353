"""Secrets in a text and in what is encoded in it.

A worklist of layers starts with the text itself. Each layer is scanned; what in it is encoded by
URL escapes, Unicode escapes, base64 (in one line or broken into lines of one length) or base64 of
compressed bytes is decoded to a new layer that knows, for each of its characters, the place in the text that it came from. Bytes that are no UTF-8
become placeholders, one for each, and other characters of any kind stay. A layer seen before at
the same place is not taken again, so the list ends even if something decodes to itself. Compressed
bytes are inflated to their end, all members, in pieces that end where no match can go on; a piece
without such an end, that is one very long run, is held as a whole.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.llm.common import udf

KINDS = ("assign", "access", "hex")
# The three kinds. A run of one class is matched as a whole, so its least length can
# stand in the pattern; an assignment's value is checked afterwards, for a short one takes its place.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
VALUE = 12  # least characters of an assigned value

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
BASE64 = (  # both alphabets; a run that mixes them is split by each
    re.compile(r"[A-Za-z0-9+/]{16,}={0,2}"),
    re.compile(r"[A-Za-z0-9_-]{16,}={0,2}"),
)
#: Lines that may be one run broken at equal lengths, with blanks in front of them or not.
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
CHUNK = 1 << 20  # bytes inflated at once
# What any secret has, also one encoded once more: as many of these as a value has characters.
LONG = re.compile(rb"[A-Za-z0-9+/_.=%\\-]{12}")
PLACEHOLDER = "\ufffd"
# The last place where no match of any pattern, in this layer or a nested one, can go on.
END = re.compile(rb"""(?s:.*)[^A-Za-z0-9+/_.=%\\:"'\x20\x80-\xff-]""")

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all three kinds in one layer, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A text whose character i comes from lo[i]:hi[i] of the root, or all of it from ``place``.

    The root has neither.
    """

    def __init__(
        self,
        text: str,
        lo: list[int] | None = None,
        hi: list[int] | None = None,
        place: tuple[int, int] | None = None,
    ):
        self.text, self.lo, self.hi, self.place = text, lo, hi, place

    def at(self, start: int, end: int) -> tuple[int, int]:
        if self.place is not None:
            return self.place
        if self.lo is None:
            return start, end
        return min(self.lo[start:end]), max(self.hi[start:end])

    def key(self) -> tuple[int, int, bytes]:
        data = self.text.encode("utf-8", "surrogatepass")
        return (*self.at(0, len(self.text)), hashlib.blake2b(data).digest())


def _utf8(data: bytes) -> list[tuple[str, int, int]]:
    """Characters with their byte ranges; a byte that is no part of one is a placeholder."""
    if data.isascii():
        return [(c, i, i + 1) for i, c in enumerate(data.decode("ascii"))]
    out, at = [], 0
    for c in data.decode("utf-8", "surrogateescape"):
        if "\ud800" <= c < "\ue000":
            c, n = PLACEHOLDER, 1
        else:
            n = len(c.encode("utf-8"))
        out.append((c, at, at + n))
        at += n
    return out


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match decoded where it stands; None if nothing changes."""
    text, lo, hi, last, changed = [], [], [], 0, False
    for m in pattern.finditer(layer.text):
        changed = True
        for i in range(last, m.start()):
            a, b = layer.at(i, i + 1)
            text.append(layer.text[i])
            lo.append(a)
            hi.append(b)
        for c, i, j in decode(m.group()):
            a, b = layer.at(m.start() + i, m.start() + j)
            text.append(c)
            lo.append(a)
            hi.append(b)
        last = m.end()
    if not changed:
        return None
    for i in range(last, len(layer.text)):
        a, b = layer.at(i, i + 1)
        text.append(layer.text[i])
        lo.append(a)
        hi.append(b)
    if layer.place is not None:
        return Layer("".join(text), place=layer.place)
    return Layer("".join(text), lo, hi)


def _url(match: str) -> list[tuple[str, int, int]]:
    return [(c, 3 * i, 3 * j) for c, i, j in _utf8(bytes.fromhex(match.replace("%", "")))]


def _unicode(match: str) -> list[tuple[str, int, int]]:
    out, at = [], 0
    for part in re.findall(r"\\u....|\\x..", match):
        code = int(part[2:], 16)
        if out and 0xDC00 <= code < 0xE000 and "\ud800" <= out[-1][0] < "\udc00":
            c, begin, _ = out.pop()
            out.append((chr(0x10000 + ((ord(c) - 0xD800) << 10) + code - 0xDC00), begin, at + len(part)))
        else:
            out.append((chr(code), at, at + len(part)))
        at += len(part)
    return [(PLACEHOLDER if "\ud800" <= c < "\ue000" else c, i, j) for c, i, j in out]


def _inflater(data: bytes):
    """What inflates these bytes, if they begin like compressed ones, else None."""
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if data[:3] == b"BZh" else None


def _opens(data: bytes) -> bool:
    """Whether compressed bytes begin here."""
    inflater = _inflater(data)
    if inflater is None:
        return False
    try:
        return bool(inflater.decompress(data, CHUNK)) or inflater.eof
    except (zlib.error, OSError, EOFError):
        return False


def _members(data: bytes) -> Iterator[bytes]:
    """Inflated bytes of all members; what follows them and is not compressed comes as it is.

    Of a broken member there is what comes before the fault.
    """
    while data:
        if not _opens(data):
            rest = data.lstrip(b"\0")
            if len(rest) < len(data) and _opens(rest):  # members may be padded
                data = rest
                continue
            yield b"\n" + data
            return
        inflater, rest = _inflater(data), data
        try:
            while not inflater.eof:
                chunk = inflater.decompress(rest, CHUNK)
                rest = getattr(inflater, "unconsumed_tail", b"")
                if chunk:
                    yield chunk
                elif not rest and getattr(inflater, "needs_input", True):
                    break
        except (zlib.error, OSError, EOFError):
            return
        data = inflater.unused_data


def _inflated(data: bytes) -> Iterator[bytes]:
    """Compressed bytes inflated until they are not compressed any more, or repeat."""
    seen = set()
    while (key := hashlib.blake2b(data).digest()) not in seen:
        seen.add(key)
        chunks = _members(data)
        first = next(chunks, b"")
        if not _opens(first):
            yield from chain([first], chunks)
            return
        data = b"".join(chain([first], chunks))


def _pieces(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The same bytes, cut only where no match can go on."""
    held = []
    for chunk in chunks:
        end = END.match(chunk)
        if end is None:
            held.append(chunk)
            continue
        yield b"".join([*held, end.group()])
        held = [chunk[end.end() :]]
    yield b"".join(held)


def _wrapped(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs over several lines: all of the first one's length, but for a last one that may be shorter."""
    if "\n" not in text:
        return
    for m in WRAPPED.finditer(text):
        lines = [x.span() for x in LINE.finditer(text, m.start(), m.end())]
        first = 0
        while first < len(lines):
            length = lines[first][1] - lines[first][0]
            last = first + 1
            while last < len(lines) and lines[last][1] - lines[last][0] == length:
                last += 1
            if last < len(lines) and lines[last][1] - lines[last][0] < length:
                last += 1
            if last - first > 1 and length >= 16:
                yield lines[first:last]
            first = max(last - 1, first + 1)


def _base64(layer: Layer) -> Iterator[Layer]:
    runs = [[span] for span in {m.span() for p in BASE64 for m in p.finditer(layer.text)}]
    for run in sorted(runs + list(_wrapped(layer.text))):
        body = "".join(layer.text[a:b] for a, b in run).rstrip("=")
        if len(body) % 4 == 1:
            body = body[:-1]
        data = base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))
        if _opens(data):
            whole = layer.at(run[0][0], run[-1][1])
            for piece in _pieces(_inflated(data)):
                if LONG.search(piece):
                    yield Layer(piece.decode("utf-8", "replace"), place=whole)
        elif LONG.search(data):  # byte i comes from the characters that hold its bits
            chars = _utf8(data)
            at = range(*run[0]) if len(run) == 1 else [i for a, b in run for i in range(a, b)]
            places = [layer.at(at[i * 8 // 6], at[(j * 8 - 1) // 6] + 1) for _, i, j in chars]
            yield Layer("".join(c for c, _, _ in chars), [p[0] for p in places], [p[1] for p in places])


def _inside(layer: Layer) -> Iterator[Layer]:
    """The layers encoded in one, as they are asked for."""
    for sign, pattern, decode in (("%", URL, _url), ("\\", UNICODE, _unicode)):
        inner = _replaced(layer, pattern, decode) if sign in layer.text else None
        if inner is not None and inner.text:
            yield inner
    yield from _base64(layer)


def scan(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by start, then kind: base spans and those of decoded layers."""
    base = base_spans(text)
    found = {s: True for s in base}
    work, seen = [iter([Layer(text)])], set()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if layer.lo is not None or layer.place is not None:
            key = layer.key()
            if key in seen:
                continue
            seen.add(key)
            for start, kind, end in base_spans(layer.text):
                a, b = layer.at(start, end)
                found.setdefault((a, kind, b), False)
        work.append(_inside(layer))
    return [(KINDS[k], a, b, found[a, k, b]) for a, k, b in sorted(found)]


def _scan(texts: pd.Series) -> pd.Series:
    return pd.Series(
        [
            [{"kind": k, "start": a, "end": b, "base": base} for k, a, b, base in scan(t or "")]
            for t in texts
        ],
        dtype=object,
    )


def spans(text: Column | str) -> Column:
    """Array of (kind, start, end, base) of a text; null as empty. Code points, end exclusive."""
    return udf(_scan, SPANS)(text)


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined in their order."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
