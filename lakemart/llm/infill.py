"""Fill-in-the-middle texts: a wavelet matrix over character classes locates both cuts.

Each code point has one of eight classes. A unit of text (line, word, sentence) ends after a
character of certain classes, and the end of the text ends the last. The matrix holds the classes
in three bit vectors, one per binary digit, each stably partitioned by the digits before it. It
answers how many of the first i characters have a class (rank) and where the k-th one stands
(select). Ranks of the classes that end a unit add up to the number of units; a cut after k units
is one select if one class ends units, else a bisection on the sum of ranks.

A text is never changed but for the order of its parts: form ``psm`` is prefix, suffix, middle,
each behind its marker; ``spm`` is suffix, prefix, middle. Cuts and form are drawn from the SHA-256
of the seed and the id, so reruns agree and rows are independent of each other.

Null text counts as empty. Empty texts, and texts that hold a marker, stay plain, and so do those
that the rate leaves out: output equals the text, ``prefix_chars`` and ``middle_chars`` are null.
A null id draws as the empty string. Repeated ids draw alike. Rows are independent: no shuffle,
memory a small multiple of the longest text. Columns of the input are kept; those in ``MADE``
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import udf

MARKERS = ("<P>", "<S>", "<M>")  # fixed values: before prefix, suffix and middle
MADE = "n long, form string, prefix_chars long, middle_chars long, output string"
OTHER, DIGIT, BLANK, NEWLINE, STOP, MARK, CONTROL, BEYOND = range(8)  # BEYOND: no ASCII
BITS = 3
#: The classes after which a unit ends.
UNITS = {"lines": (NEWLINE,), "words": (BLANK, NEWLINE), "sentences": (STOP, NEWLINE)}
BLOCK = 64  # bytes of a bit vector in one count


def _classes() -> np.ndarray:
    """The class of each UTF-8 lead byte."""
    of = np.full(256, OTHER, np.uint8)
    of[:32] = CONTROL
    of[127] = CONTROL
    of[128:] = BEYOND
    for c in range(33, 127):
        if chr(c).isdigit():
            of[c] = DIGIT
        elif not chr(c).isalpha():
            of[c] = MARK
    of[[ord(c) for c in " \t"]] = BLANK
    of[[ord(c) for c in ".!?"]] = STOP
    of[ord("\n")] = NEWLINE
    return of


CLASS = _classes()


def classes(text: str) -> np.ndarray:
    """The class of each code point."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) > len(text):
        data = data[(data & 0xC0) != 0x80]
    return CLASS[data]


class Bits:
    """A bit vector with counts by block."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        self.bytes = np.packbits(bits)
        ones = np.bitwise_count(self.bytes)
        starts = np.arange(0, len(ones), BLOCK)
        counts = np.add.reduceat(ones, starts, dtype=np.int64) if len(ones) else starts
        self.before = np.concatenate([[0], np.cumsum(counts)])  # ones before each block
        self.ones = int(self.before[-1])

    def rank(self, bit: int, i: int) -> int:
        """How many of the first i bits are ``bit``."""
        block, byte = i // (8 * BLOCK), i // 8
        ones = int(self.before[block])
        ones += int(np.bitwise_count(self.bytes[block * BLOCK : byte]).sum(dtype=np.int64))
        if i % 8:
            ones += (int(self.bytes[byte]) >> (8 - i % 8)).bit_count()
        return ones if bit else i - ones

    def select(self, bit: int, k: int) -> int:
        """Where the k-th ``bit`` stands, k from 0."""
        before = self.before
        if not bit:
            before = np.minimum(np.arange(len(before)) * 8 * BLOCK, self.size) - before
        block = int(np.searchsorted(before, k, "right")) - 1
        inside = np.unpackbits(self.bytes[block * BLOCK : (block + 1) * BLOCK])
        return block * 8 * BLOCK + int(np.flatnonzero(inside == bit)[k - int(before[block])])


class WaveletMatrix:
    """Rank and select of each of 2 ** BITS classes over a sequence."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        self.levels: list[Bits] = []
        for level in reversed(range(BITS)):
            ones = (codes >> level & 1).astype(bool)
            self.levels.append(Bits(ones))
            codes = np.concatenate([codes[~ones], codes[ones]])

    def _down(self, code: int, i: int) -> int:
        for level, bits in zip(reversed(range(BITS)), self.levels, strict=True):
            bit = code >> level & 1
            i = (bits.size - bits.ones if bit else 0) + bits.rank(bit, i)
        return i

    def rank(self, code: int, i: int) -> int:
        """How many of the first i elements are ``code``."""
        return self._down(code, i) - self._down(code, 0)

    def select(self, code: int, k: int) -> int:
        """Where the k-th ``code`` stands, k from 0."""
        at = self._down(code, 0) + k
        for level, bits in zip(range(BITS), reversed(self.levels), strict=True):
            bit = code >> level & 1
            at = bits.select(bit, at - (bits.size - bits.ones if bit else 0))
        return at


class Units:
    """The units of a text: their number, and where the first k of them end."""

    def __init__(self, text: str, ends: tuple[int, ...]):
        codes = classes(text)
        self.matrix, self.ends = WaveletMatrix(codes), ends
        self.ended = self.count(len(codes))
        self.number = self.ended + int(len(codes) > 0 and int(codes[-1]) not in ends)

    def count(self, i: int) -> int:
        """Units that end within the first i code points."""
        return sum(self.matrix.rank(c, i) for c in self.ends)

    def cut(self, k: int) -> int:
        """Code points in the first k units."""
        if k == 0:
            return 0
        if k > self.ended:
            return self.matrix.size
        if len(self.ends) == 1:
            return self.matrix.select(self.ends[0], k - 1) + 1
        low, high = k, self.matrix.size
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.count(middle) >= k else (middle + 1, high)
        return low


def transform(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    units: str = "lines",
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """``docs`` with the columns of ``MADE``: ``rate`` percent of the texts rearranged.

    Of h1 to h4, the first four 32-bit numbers of the id's digest, h1 and h2 modulo the number of
    units plus one place the cuts, h3 decides whether, h4 in which form (``spm_rate`` percent spm).
    """
    if len(set(markers)) < 3 or not all(re.fullmatch(r"<[^<>]+>", m) for m in markers):
        raise ValueError("markers must be three different names in angle brackets")
    ends, (p, s, m) = UNITS[units], markers

    def rearrange(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MADE.split(", ")]
        for texts, draws in batches:
            rows = []
            for whole, draw in zip(texts, draws, strict=True):
                whole = whole or ""
                found = Units(whole, ends)
                n = found.number
                h = [int(draw[i : i + 8], 16) for i in range(0, 32, 8)]
                if not whole or any(x in whole for x in markers) or h[2] % 100 >= rate:
                    rows.append((n, "plain", None, None, whole))
                    continue
                a, b = map(found.cut, sorted((h[0] % (n + 1), h[1] % (n + 1))))
                prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
                if h[3] % 100 < spm_rate:
                    rows.append((n, "spm", a, b - a, "".join((s, suffix, p, prefix, m, middle))))
                else:
                    rows.append((n, "psm", a, b - a, "".join((p, prefix, s, suffix, m, middle))))
            made = pd.DataFrame(rows, columns=names)
            yield made.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    made = udf(rearrange, MADE)(F.col(text), drawn)
    own = {c.split()[0] for c in MADE.split(", ")}
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*kept, made.alias("made")).select(*kept, "made.*")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text behind an output: its parts between the markers, put back in order.

    No part holds a marker, and none can arise across a joint, since a marker has its only ``<``
    first and its only ``>`` last.
    """
    p, s, m = markers
    parts = F.split(output, "|".join(re.escape(x) for x in markers))
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
