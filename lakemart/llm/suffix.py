"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

Suffixes are compared through their first ``window`` bytes only, in passes of one digit each, and
a suffix whose group has one member leaves the sort. Equal groups at full depth are exactly the
repeated windows.

Not every suffix is sorted one by one. A position belongs to the synchronising set if the hash of
the DIGIT bytes there is the least within some window; equal windows have their least position at
the same offset. The windows with the same least position are a stretch, kept as one row. A pass
groups stretches by a digit (bytes that all their windows share) and by their whole bytes:

* the digit occurs once: none of the windows is repeated, the stretch leaves;
* the whole stretch occurs twice or more: all its windows are repeated, it leaves, too;
* else it is cut into shorter stretches (at the same offsets from the digit), whose digits are
  longer. One row with a count stands for equal stretches from then on.

The passes: the synchronised DIGIT bytes; blocks of BLOCK windows, whose digit are the window - BLOCK
+ 1 bytes they share; single windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import discard, ship, small_join, udf, written

DIGIT = 32  # bytes of the first digit
BLOCK = 16  # windows of a stretch in the second pass
CHUNK = 1 << 18  # window starts handled at once, whatever a text's length
COLUMNS = ("digit", "stretch", "th", "place", "first", "last", "n")
SCHEMA = "digit long, stretch long, th long, place int, first int, last int, n long"
RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_B = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(20)  # low bits of a hash that are given to the position; CHUNK fits in them


def _digits(data: np.ndarray) -> np.ndarray:
    """A hash of the DIGIT bytes from each position."""
    h, b, width = data.astype(np.uint64) + np.uint64(1), _B, 1
    while width < DIGIT:
        h = h[: len(h) - width] * b + h[width:]
        b, width = b * b, width * 2
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """Index of the leftmost least value in each stretch of ``span`` values (by its upper bits)."""
    low = (np.uint64(1) << _PLACE) - np.uint64(1)
    v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    pad = -len(v) % span
    v = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, span)
    left = np.minimum.accumulate(v, axis=1).ravel()
    right = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - span + 1
    return (np.minimum(right[:n], left[span - 1 : span - 1 + n]) & low).astype(np.int64)


def synchronised(data: bytes, window: int) -> tuple[np.ndarray, ...]:
    """(digit, place, first, last): suffixes of the set and the windows each speaks for."""
    n = len(data) - window + 1
    out: list[tuple[np.ndarray, ...]] = []
    span = window - DIGIT + 1
    for begin in range(0, max(n, 0), CHUNK):
        stop = min(n, begin + CHUNK)
        with np.errstate(over="ignore"):
            h = _digits(np.frombuffer(data, np.uint8, stop - begin + window - 1, begin))
        at = _least(h, span)
        edges = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], edges])
        last = np.concatenate([edges - 1, [len(at) - 1]])
        place = at[first]
        out.append((h[place].view(np.int64), place + begin, first + begin, last + begin))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _stretches(window: int):
    """Rows (th, text) to those of the first pass; equal texts of a batch once."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            copies = batch.th.value_counts()
            parts = []
            for th, text in batch.drop_duplicates("th").itertuples(index=False):
                data = text.encode("utf-8")
                digit, place, first, last = synchronised(data, window)
                if not len(digit):
                    continue
                view = memoryview(data)
                # The offset of the digit is part of what must be equal.
                names = [
                    xxhash.xxh3_64_intdigest(view[a : b + window], p - a)
                    for p, a, b in zip(place.tolist(), first.tolist(), last.tolist(), strict=True)
                ]
                names = np.array(names, np.uint64).view(np.int64)
                n = len(digit)
                parts.append((digit, names, np.full(n, th), place, first, last, np.full(n, copies[th])))
            if parts:
                joined = map(np.concatenate, zip(*parts, strict=True))
                yield pd.DataFrame(dict(zip(COLUMNS, joined, strict=True)))

    return emit


def _shorter(window: int, block: int):
    """Rows (th, text, parts) to those of the next pass: stretches of up to ``block`` windows."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for th, text, own in batch[["th", "text", "parts"]].itertuples(index=False):
                data = memoryview(text.encode("utf-8"))
                for p in own:
                    place, end = p["place"], p["last"]
                    a = p["first"]
                    while a <= end:
                        # Blocks lie at multiples of ``block`` from the digit, in every copy alike.
                        start = a - (a - place) % block
                        b = min(end, start + block - 1)
                        shared = data[start + block - 1 : start + window]
                        rows.append(
                            (
                                xxhash.xxh3_64_intdigest(shared, (start - place) % (1 << 32)),
                                xxhash.xxh3_64_intdigest(data[a : b + window], a - start),
                                th,
                                place,
                                a,
                                b,
                                p["n"],
                            )
                        )
                        a = b + 1
            if rows:
                out = pd.DataFrame(rows, columns=COLUMNS)
                for name in ("digit", "stretch"):
                    out[name] = out[name].to_numpy(np.uint64).view(np.int64)
                yield out

    return emit


def repeated(docs: DataFrame, window: int = 400) -> DataFrame:
    """(th, runs): for each text, by its 64-bit hash, the (first, last) runs of repeated windows.

    ``docs``: th and text (not null), one row per document; texts may repeat.
    """
    ship(docs.sparkSession)
    rows = written(docs.mapInPandas(_stretches(window), SCHEMA), "stretches")
    found, texts = [], None
    for block in (min(BLOCK, window // 2), 1, 0):
        kinds = rows.groupBy("digit", "stretch").agg(
            F.sum("n").alias("n"), F.min(F.struct("th", "place", "first", "last")).alias("at")
        )
        kinds = written(kinds, "kinds")
        twice = kinds.where("n > 1").select("digit", "stretch")
        # Rows that stand for several were found repeated in an earlier pass.
        alone = rows if texts is None else rows.where("n = 1")
        whole = alone.join(twice, ["digit", "stretch"], "left_semi").select("th", "first", "last")
        found.append(written(whole, "found"))
        discard(rows)
        if not block:
            discard(kinds)
            break
        mixed = kinds.groupBy("digit").agg(F.count("*").alias("kinds")).where("kinds > 1")
        mixed = written(mixed.select("digit"), "mixed")
        parts = small_join(kinds, mixed, ["digit"], "left_semi").select("n", "at.*")
        parts = parts.groupBy("th").agg(
            F.collect_list(F.struct("place", "first", "last", "n")).alias("parts")
        )
        parts = written(parts, "parts")
        discard(kinds)
        discard(mixed)
        if texts is None:  # of all documents only those that have something to be cut
            some = written(parts.select("th"), "some")
            texts = small_join(docs.select("th", "text"), some, ["th"], "left_semi")
            texts = written(texts.groupBy("th").agg(F.first("text").alias("text")), "texts")
        rows = texts.join(parts, "th").mapInPandas(_shorter(window, block), SCHEMA)
        rows = written(rows, "shorter")
        discard(parts)
    discard(texts)
    runs = found[0].union(found[1]).union(found[2])
    return runs.groupBy("th").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def _cut(window: int):
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for text, own in zip(texts, runs, strict=True):
            data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
            edges = np.zeros(len(data) + 1, np.int32)
            for run in [] if own is None else own:
                if run["last"] + window <= len(data):  # else of another text with the same hash
                    edges[run["first"]] += 1
                    edges[run["last"] + window] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = hashlib.sha256(data[~gone].tobytes()).hexdigest()
            out.append((len(data), int(gone.sum()), spans, kept))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return cut


def remove(docs: DataFrame, text: str = "text", window: int = 400) -> DataFrame:
    """``docs`` without ``text``, with n_bytes, n_removed, n_spans and kept_sha256.

    Every byte covered by a ``window``-byte string that starts anywhere else, too, is removed. A
    null text is empty; texts shorter than the window stay whole. Ids are not looked at, so null or
    repeated ids do no harm.
    """
    names = [F.col(f"`{c}`") for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = docs.select(*names, F.xxhash64(body).alias("_q_th"), body.alias("_q_text"))
    plain = hashed.select(F.col("_q_th").alias("th"), F.col("_q_text").alias("text"))
    found = repeated(plain, window).select(F.col("th").alias("_q_th"), F.col("runs").alias("_q_runs"))
    found = written(found, "repeated")
    whole = small_join(hashed, found, ["_q_th"], "left", 1 + 2 * F.size("_q_runs"))
    cut = udf(_cut(window), RESULT)("_q_text", "_q_runs").alias("_q_cut")
    return whole.select(*names, cut).select(*names, "_q_cut.*")
