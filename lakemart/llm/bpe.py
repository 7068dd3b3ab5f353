"""Byte-level BPE as a monoid: encode halves, join neighbours at their boundary.

A token sequence is the encoding of its bytes exactly if each pair of neighbours is, that is if
encoding the two tokens' bytes gives the two tokens back. So two encodings a and b can be joined
by looking at their boundary only: a window of tokens around it is encoded anew and grows until
its first and last token form such pairs with the tokens outside. Those then stand provably. The
empty encoding is the neutral element, the join is associative, and any tree gives one result.
Decoding is the plainer monoid: bytes are concatenated up the tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession

from lakemart.llm.common import kept, udf

LEAF = 24  # bytes encoded directly, without halving
REMEMBERED = 400_000  # encodings or pair checks in one generation of a memory
BESIDE_IDS = 150_000  # the same where whole lists of ids are handed on, too
REMEMBERED_CHARS = 32  # the longest string that is remembered
# Between blank runs and what follows them no match can span, if these are the only blanks.
SEGMENT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> bytes:
    """A rank file's content (base64 token, space, rank per line); its size is the vocabulary's."""
    with open(path, "rb") as file:
        return file.read()


class Memory:
    """A bounded dictionary of two generations: what is used stays, the rest goes at once."""

    def __init__(self, most: int):
        self.most = most  # of one generation
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Coder:
    """Encodes and decodes by a rank file's content and a splitting pattern."""

    def __init__(self, content: bytes, pattern: str, remembered: int = REMEMBERED):
        self.ranks = {
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())
        }
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.words = {rank: str(rank) for rank in self.tokens}
        # What a token can start with: its rank if it is a token itself, else -1.
        self.starts = {t[:i]: -1 for t in self.ranks for i in range(1, len(t))} | self.ranks
        self.pattern = regex.compile(pattern)
        self._strings = Memory(remembered)
        self._pairs = Memory(remembered)

    def leaf(self, piece: bytes) -> list[int]:
        """Merges the lowest rank first, leftmost of equals; for a few bytes."""
        ranks, none = self.ranks, len(self.ranks) + 1
        parts = [piece[i : i + 1] for i in range(len(piece))]
        merges = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while merges and (least := min(merges)) < none:
            i = merges.index(least)
            parts[i] += parts.pop(i + 1)
            merges.pop(i)
            if i < len(merges):
                merges[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                merges[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def direct(self, piece: bytes) -> list[int]:
        """The same for windows of any length: a heap over a linked list."""
        if len(piece) <= LEAF:
            return self.leaf(piece)
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        back = list(range(-1, n))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the parts has changed since
            end[i], end[middle] = stop, 0
            if stop < n:
                back[stop] = i
                rank = ranks.get(piece[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if i:
                before = back[i]
                rank = ranks.get(piece[before:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, before, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def stands(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, encode to themselves."""
        known = self._pairs.get((left, right))
        if known is None:
            known = self.direct(self.tokens[left] + self.tokens[right]) == [left, right]
            self._pairs.put((left, right), known)
        return known

    def spell(self, piece: bytes) -> list[int]:
        """The only sequence of tokens for a few bytes in which all neighbours stand.

        Longest tokens are tried first; an end that leads nowhere is not tried again.
        """
        starts, pairs, n = self.starts.get, self._pairs.new, len(piece)
        ids: list[int] = []
        ends = [0]  # of the tokens chosen
        open_: list[list[int]] = []  # tokens still to be tried (-1: none), by length, the longest last
        dead: set[tuple[int, int]] = set()  # (end, last token)
        at, last = 0, -1
        while at < n:
            if len(open_) < len(ends):
                choices = []
                for stop in range(at + 1, n + 1):
                    token = starts(piece[at:stop])
                    if token is None:
                        break
                    choices.append(token)
                open_.append(choices)
            choices = open_[-1]
            while choices:
                token = choices.pop()
                if token < 0:
                    continue
                if last >= 0:
                    fits = pairs.get((last, token))
                    if fits is None:
                        fits = self.stands(last, token)
                        pairs = self._pairs.new
                    if not fits:
                        continue
                stop = at + len(choices) + 1
                if not dead or (stop, token) not in dead:
                    ids.append(token)
                    ends.append(stop)
                    at, last = stop, token
                    break
            else:
                dead.add((at, last))
                open_.pop()
                ids.pop()
                ends.pop()
                at, last = ends[-1], ids[-1] if ids else -1
        return ids

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of the bytes of ``a`` and ``b``, each an encoding itself."""
        if not a or not b or self.stands(a[-1], b[0]):
            return a + b
        left = right = 2
        while True:
            left, right = min(left, len(a)), min(right, len(b))
            window = self.direct(self.decode(a[len(a) - left :]) + self.decode(b[:right]))
            left_ok = left == len(a) or self.stands(a[-left - 1], window[0])
            right_ok = right == len(b) or self.stands(window[-1], b[right])
            if left_ok and right_ok:
                return a[: len(a) - left] + window + b[right:]
            left, right = left * (1 if left_ok else 2), right * (1 if right_ok else 2)

    def piece(self, data: bytes) -> list[int]:
        """One match of the pattern: a token of its own, a leaf, or two halves joined."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= LEAF:
            return self.spell(data)
        half = len(data) // 2
        return self.join(self.piece(data[:half]), self.piece(data[half:]))

    def _segment(self, segment: str) -> list[int]:
        ids: list[int] = []
        for match in self.pattern.findall(segment):
            short = len(match) <= REMEMBERED_CHARS
            found = self._strings.get(match) if short else None
            if found is None:
                found = self.piece(match.encode("utf-8"))
                if short:
                    self._strings.put(match, found)
            ids += found
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; matches of the pattern are encoded separately, then concatenated."""
        if OTHER_BLANKS.search(text):
            return self._segment(text)
        ids: list[int] = []
        recent, strings = self._strings.new, self._strings
        for segment in SEGMENT.findall(text):
            found = recent.get(segment)
            if found is None:
                short = len(segment) <= REMEMBERED_CHARS
                found = strings.get(segment) if short else None
                if found is None:
                    found = self._segment(segment)
                    if short:
                        strings.put(segment, found)
                recent = strings.new
            ids += found
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


def _coder(content: bytes, pattern: str, remembered: int) -> Coder:
    """This Python worker's coder, for all its tasks."""
    coders = kept("bpe")
    key = hashlib.sha256(content).digest(), pattern, remembered
    if key not in coders:
        coders.clear()
        coders[key] = Coder(content, pattern, remembered)
    return coders[key]


def _shared(spark: SparkSession, path: str, pattern: str, remembered: int = REMEMBERED):
    """A function that gives each Python worker its coder; the file's content is broadcast."""
    content = spark.sparkContext.broadcast(read_ranks(path))
    return lambda: _coder(content.value, pattern, remembered)


def encoder(spark: SparkSession, path: str, pattern: str):
    """A column function: text to its ids (array of int); null text as empty."""
    coder = _shared(spark, path, pattern, BESIDE_IDS)

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = coder()
        for texts in batches:
            yield pd.Series([own.encode(t or "") for t in texts], dtype=object)

    return udf(encode, "array<int>")


def decoder(spark: SparkSession, path: str, pattern: str):
    """A column function: ids to their bytes; null as none."""
    coder = _shared(spark, path, pattern)

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = coder()
        for rows in batches:
            yield pd.Series([own.decode([] if r is None else list(r)) for r in rows], dtype=object)

    return udf(decode, "binary")


def round_trip(spark: SparkSession, path: str, pattern: str, text: Column | str) -> Column:
    """Number of ids, SHA-256 of the ids and of what they decode to, as a struct.

    Equals encoding, decoding and digesting one after another, without sending ids to the JVM.
    """
    coder = _shared(spark, path, pattern)

    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = coder()
        for texts in batches:
            rows = []
            for text in texts:
                ids = own.encode(text or "")
                words = " ".join(map(own.words.__getitem__, ids))
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(words.encode()).hexdigest(),
                        hashlib.sha256(own.decode(ids)).hexdigest(),
                    )
                )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return udf(digest, DIGEST)(text)
