"""Quality rules: fixed rules reject, and an isolation forest on the rules' statistics judges the rest.

The forest is grown on documents labelled good. Random splits isolate a document that is unlike
them after few steps, so short paths mean anomalous. A feature that is constant among them is split
over the range of all labelled documents, since its other values are what junk looks like. The
threshold is set on both labels: of those at which no more than LOSS of the good documents would go,
the one with the largest share of bad documents rejected less that of good ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import kept, udf, written

CAPITALS = bytes(range(65, 91))
BLANKS = " \t\n\r\x0b\x0c"  # fixed values: what separates words
SYMBOLS = "#*$%&|<>"  # fixed values: what counts as a symbol
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words in repeated windows

TREES, LEAF_ROWS = 100, 256  # rows that each tree is grown on
SAMPLE = 20_000  # labelled rows that the forest is grown on, at most
LOSS = 0.005  # share of rows labelled good that the threshold may reject
BINS = 10_000  # of the score, for the threshold

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("mean_word", "symbols", "dup_lines", "repeats", "capitals", "marks", "variety", "digits")
SCHEMA = ", ".join([*(f"{c} long" for c in STATS), *(f"{c} double" for c in FEATURES)])
_B = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur at least twice; first ones included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    b, width = _B, 1
    while width < WINDOW:
        h = h[: len(h) - width] * b + h[width:]
        b, width = b * b, width * 2
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int32)
    edges[:n] += twice
    edges[WINDOW:] -= twice
    return int((np.cumsum(edges[:-1]) > 0).sum())


def count_capitals(text: str, data: bytes) -> int:
    """Upper-case letters of a text, whose UTF-8 bytes are given, too."""
    if len(data) == len(text):
        return len(data) - len(data.translate(None, CAPITALS))
    return sum(map(str.isupper, text))


def measure(text: str) -> tuple:
    """STATS and FEATURES of one text."""
    data = text.encode("utf-8")
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    dup = len(lines) - len(set(lines))
    with np.errstate(over="ignore"):
        repeats = repeated_words(words)
    if not n:
        return (0, 0, symbols, dup, 0, *[0.0] * len(FEATURES))
    sample_marks = text.count("!") + text.count("?") + text.count(".") + text.count(",")
    digits = sum(map(text.count, "0123456789"))
    return (
        n,
        chars,
        symbols,
        dup,
        repeats,
        chars / n,
        symbols / n,
        dup / len(lines),
        repeats / n,
        count_capitals(text, data) / chars,
        sample_marks / n,
        len(set(words)) / n**0.8,
        digits / chars,
    )


def _measure(texts: pd.Series) -> pd.DataFrame:
    kept("quality")  # remembers nothing, so what other operators did goes
    return pd.DataFrame([measure(t or "") for t in texts], columns=[*STATS, *FEATURES])


def statistics(text: Column | str) -> Column:
    """STATS and FEATURES of a text as a struct; a null text has no words."""
    return udf(_measure, SCHEMA)(text)


def base_failed(stats: Column) -> Column:
    """The fixed rules: too few words, or too many in repeated windows."""
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > MAX_REPEATED * stats["n_words"]
    )


def _expected(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1: leaf), cut, left child, path length at a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    norm: float
    threshold: float = 2.0  # no score is above 1, so nothing is rejected

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): towards 1 for anomalous rows."""
        total = np.zeros(len(rows))
        which = np.arange(len(rows))
        for t in range(len(self.feature)):
            node = np.zeros(len(rows), np.int32)
            while True:
                f = self.feature[t][node]
                if (f < 0).all():
                    break
                right = rows[which, f] >= self.cut[t][node]
                node = np.where(f < 0, node, self.child[t][node] + right)
            total += self.depth[t][node]
        return 2.0 ** -(total / len(self.feature) / self.norm)


def grow(rows: np.ndarray, seed: int = 5, bounds: tuple[np.ndarray, np.ndarray] | None = None) -> Forest:
    """An isolation forest on the rows of FEATURES.

    ``bounds`` are the least and greatest values known of each feature, which one that is constant
    in ``rows`` is split between. Such a split leaves one side empty: nothing alike was seen there.
    """
    random = np.random.default_rng(seed)
    n = max(2, min(LEAF_ROWS, len(rows)))
    limit = math.ceil(math.log2(n))
    most = 2 ** (limit + 1)
    shape = (TREES, most)
    forest = Forest(
        np.full(shape, -1, np.int32), np.zeros(shape), np.zeros(shape, np.int32), np.zeros(shape), _expected(n)
    )
    if not len(rows):
        return forest
    least, greatest = bounds or (rows.min(axis=0), rows.max(axis=0))
    constant = rows.min(axis=0) == rows.max(axis=0)
    for t in range(TREES):
        own = rows[random.choice(len(rows), min(n, len(rows)), replace=False)]
        work, used = [(0, own, 0, least, greatest)], 1
        while work:
            node, part, depth, floor, ceiling = work.pop()
            forest.depth[t][node] = depth + _expected(len(part))
            if depth >= limit or len(part) < 2:
                continue
            low = np.where(constant, floor, part.min(axis=0))
            high = np.where(constant, ceiling, part.max(axis=0))
            varied = np.flatnonzero(high > low)
            if not len(varied):
                continue
            f = random.choice(varied)
            cut = random.uniform(low[f], high[f])
            right = part[:, f] >= cut
            if right.all() and not constant[f]:  # the cut fell on the least value
                continue
            forest.feature[t][node], forest.cut[t][node], forest.child[t][node] = f, cut, used
            below, above = ceiling.copy(), floor.copy()
            below[f] = above[f] = cut
            work += [
                (used, part[~right], depth + 1, floor, below),
                (used + 1, part[right], depth + 1, above, ceiling),
            ]
            used += 2
    return forest


def scorer(forest: Forest):
    """A column function: a struct with FEATURES to its anomaly score."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for rows in batches:
            values = rows[list(FEATURES)].to_numpy(float)
            yield pd.Series(forest.score(values) if len(values) else [], dtype=float)

    return udf(score, "double")


def calibrate(stats: DataFrame, labels: DataFrame, seed: int = 5) -> Forest:
    """The forest for ``stats`` (doc_id, s: struct of statistics) and ``labels`` (doc_id, quality).

    It is grown on at most SAMPLE of the rows labelled good (quality 1; the first by a hash of
    their values), within the ranges of all labelled rows; the threshold is set on all labelled rows
    (quality 1 or 0). Rows that the fixed rules reject, null ids and null labels take no part.
    Without bad labels the threshold is the lowest allowed; without good ones nothing is rejected
    beyond the fixed rules.
    """
    known = (
        stats.join(labels.select("doc_id", "quality").dropna().distinct(), "doc_id")
        .where(~base_failed(F.col("s")))
        .select("quality", "s")
    )
    good = known.where("quality = 1").select("s.*").select(*FEATURES)
    fit = good.orderBy(F.xxhash64(F.lit(seed), *FEATURES), *FEATURES).limit(SAMPLE).toPandas()
    if not len(fit):
        return grow(fit.to_numpy(float), seed)
    ends = known.agg(*[f(f"s.{c}") for f in (F.min, F.max) for c in FEATURES]).first()
    bounds = np.array(ends[: len(FEATURES)]), np.array(ends[len(FEATURES) :])
    forest = grow(fit.to_numpy(float), seed, bounds)
    bins = (
        known.withColumn("bin", F.floor(scorer(forest)("s") * BINS))
        .groupBy("bin")
        .agg(
            F.count_if(F.col("quality") == 1).alias("good"),
            F.count_if(F.col("quality") == 0).alias("bad"),
        )
        .toPandas()
        .sort_values("bin", ascending=False)
    )
    forest.threshold = threshold(bins.bin.to_numpy(), bins.good.to_numpy(), bins.bad.to_numpy())
    return forest


def threshold(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The score from which rows are rejected, by the labelled rows in each bin, highest bin first."""
    lost, caught = good.cumsum() / max(1, good.sum()), bad.cumsum() / max(1, bad.sum())
    allowed = np.flatnonzero(lost <= LOSS)
    if not len(allowed):
        return (BINS + 1) / BINS
    gain = (caught - lost)[allowed] if bad.any() else allowed
    at = len(gain) - 1 - int(np.argmax(gain[::-1]))  # the lowest of equal ones
    if bad.any() and gain[at] < 0:
        return (BINS + 1) / BINS
    return bins[allowed[at]] / BINS


def judge(stats: Column, forest: Forest) -> tuple[Column, Column]:
    """(anomaly score, whether a document is kept) of a struct of statistics."""
    score = scorer(forest)(stats)
    return score, ~base_failed(stats) & (score < forest.threshold)


def keep(docs: DataFrame, labels: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """``docs`` without those that the fixed rules or the forest reject; same columns.

    Texts are measured twice, once for the threshold and once for the verdict, so none is moved.
    """
    stats = docs.select(F.col(id_).alias("doc_id"), statistics(text).alias("s"))
    forest = calibrate(written(stats, "statistics"), labels)

    def verdict(texts: pd.Series) -> pd.Series:
        rows = _measure(texts)
        failed = (rows.n_words < MIN_WORDS) | (100 * rows.n_repeat_words > MAX_REPEATED * rows.n_words)
        return ~failed & (forest.score(rows[list(FEATURES)].to_numpy(float)) < forest.threshold)

    return docs.where(udf(verdict, "boolean")(F.col(text)))
