"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels exist for documents only, so tokens are labelled first: a word or beginning of a word marks
toxic tokens if it occurs in so many toxic documents, and in so few others, that chance does not
explain it. In toxic documents tokens with such a mark are labelled toxic, all other tokens not.
The field is then fitted to these token sequences by their likelihood; features of words and their
beginnings and ends carry over to inflections never labelled. Forward-backward gives each token's
marginal; a document's score is a logistic function of what the marginals add up to.

A chain of two states is a product of 2x2 matrices. It is taken in two levels: step by step within
blocks of tokens, all blocks at once, and then from block to block, so the work is linear and
vectorised however long a text is.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import udf

TOXIC_ROWS = 500  # labelled toxic documents the field is fitted on, at most
CLEAN_ROWS = 2000  # the same for others
FIT_CHARS = 20_000  # longest text used for fitting (scoring takes every whole text)
BATCH = 100_000  # tokens in one pass of forward-backward
BLOCK = 128  # tokens of a block
REMEMBERED = 200_000  # words whose weight a Python worker remembers
PURITY = 0.9  # of the documents with a mark that must be toxic
ROUNDS = 25  # gradient steps
SPAN = 0.5  # least marginal of an offending token

WORD = re.compile(r"\w+")
SCHEMA = "score double, spans array<struct<start:int,end:int,marginal:double>>"


def features(word: str, marked: Collection[str] = ()) -> list[str]:
    """The word, its beginnings and its ends, and whether one of these is a mark."""
    word = word.lower()
    out = ["=" + word]
    out += [f"<{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n]
    out += [f"{word[-n:]}>" for n in (3, 4) if len(word) > n]
    if any(f in marked for f in out):
        out.append("#")
    return out


def _copies(texts: list[str]) -> list[bool]:
    """Whether a text shares its least hash of five words with an earlier one."""
    seen: set[int] = set()
    out = []
    for text in texts:
        words = WORD.findall(text)
        runs = (" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
        key = min(zlib.crc32(r.encode()) for r in runs)
        out.append(key in seen)
        seen.add(key)
    return out


def marks(texts: list[str], toxic: list[bool]) -> set[str]:
    """Features that mark toxic tokens: words and beginnings of at least four letters.

    Copies of a text are no further evidence, so they are not counted.
    """
    once = [not c for c in _copies(texts)]
    texts = [t for t, o in zip(texts, once, strict=True) if o]
    toxic = [t for t, o in zip(toxic, once, strict=True) if o]
    total: Counter = Counter()
    bad: Counter = Counter()
    for text, is_toxic in zip(texts, toxic, strict=True):
        own = {f for w in set(WORD.findall(text)) for f in features(w) if f[0] == "=" or f[0] == "<"}
        own = {f for f in own if len(f) > 4 or f[0] == "="}
        total.update(own)
        if is_toxic:
            bad.update(own)
    share = sum(toxic) / max(1, len(toxic))
    if not 0 < share < 1:
        return set()
    at_least = Counter()
    running = 0
    for n, count in sorted(Counter(total.values()).items(), reverse=True):
        running += count
        at_least[n] = running
    # Chance would give at_least * share ** n pure features of n documents; well under one is asked.
    return {
        f
        for f, n in bad.items()
        if n >= PURITY * total[f] and -n * math.log(share) > math.log(at_least[total[f]]) + 2
    }


def forward_backward(
    emission: np.ndarray, first: np.ndarray, transition: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 and expected transitions (2x2).

    ``emission``: score of state 1 over state 0 per token; ``first``: where a chain begins;
    ``transition``: scores from state to state.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    move = np.exp(transition)
    weight = np.exp(np.clip(emission, -30, 30))
    blocks = -(-n // BLOCK)

    def cut(a: np.ndarray, fill: float) -> np.ndarray:
        out = np.full(blocks * BLOCK, fill)
        out[:n] = a
        return out.reshape(blocks, BLOCK).T.copy()

    w, new = cut(weight, 1.0), cut(first.astype(float), 1.0)
    # M[s, r]: from state r before a token to state s at it; a first token forgets what was before.
    m00, m01 = np.where(new > 0, 1.0, move[0, 0]), np.where(new > 0, 1.0, move[1, 0])
    m10, m11 = np.where(new > 0, 1.0, move[0, 1]) * w, np.where(new > 0, 1.0, move[1, 1]) * w

    def across(order: Iterable[int], forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """The message that enters each block."""
        p00, p01 = np.ones(blocks), np.zeros(blocks)
        p10, p11 = np.zeros(blocks), np.ones(blocks)
        for t in order:
            a, b, c, d = m00[t], m01[t], m10[t], m11[t]
            if not forward:
                b, c = c, b
            p00, p01, p10, p11 = a * p00 + b * p10, a * p01 + b * p11, c * p00 + d * p10, c * p01 + d * p11
            s = p00 + p01 + p10 + p11
            p00, p01, p10, p11 = p00 / s, p01 / s, p10 / s, p11 / s
        x0, x1 = np.ones(blocks), np.ones(blocks)
        v0, v1 = (1.0, 0.0) if forward else (0.5, 0.5)
        for k in range(blocks) if forward else range(blocks - 1, -1, -1):
            x0[k], x1[k] = v0, v1
            v0, v1 = p00[k] * v0 + p01[k] * v1, p10[k] * v0 + p11[k] * v1
            s = v0 + v1
            v0, v1 = v0 / s, v1 / s
        return x0, x1

    a0, a1 = across(range(BLOCK), True)
    alpha0, alpha1 = np.empty_like(w), np.empty_like(w)
    before0, before1 = np.empty_like(w), np.empty_like(w)
    for t in range(BLOCK):
        before0[t], before1[t] = a0, a1
        a0, a1 = m00[t] * a0 + m01[t] * a1, m10[t] * a0 + m11[t] * a1
        s = a0 + a1
        a0, a1 = a0 / s, a1 / s
        alpha0[t], alpha1[t] = a0, a1
    b0, b1 = across(range(BLOCK - 1, -1, -1), False)
    beta0, beta1 = np.empty_like(w), np.empty_like(w)
    for t in range(BLOCK - 1, -1, -1):
        beta0[t], beta1[t] = b0, b1
        b0, b1 = m00[t] * b0 + m10[t] * b1, m01[t] * b0 + m11[t] * b1
        s = b0 + b1
        b0, b1 = b0 / s, b1 / s
    p0, p1 = alpha0 * beta0, alpha1 * beta1
    marginal = (p1 / (p0 + p1)).T.ravel()[:n]
    inside = (1 - new).T.ravel()[:n]
    pairs = [m00 * before0 * beta0, m10 * before0 * beta1, m01 * before1 * beta0, m11 * before1 * beta1]
    whole = sum(pairs)
    expected = np.array([((p / whole).T.ravel()[:n] * inside).sum() for p in pairs]).reshape(2, 2)
    return marginal, expected


@dataclass
class Field:
    """Weights of features and transitions, and the document score's coefficients."""

    marks: set[str]
    weights: dict[str, float]
    bias: float
    transition: np.ndarray
    score: np.ndarray
    memory: dict[str, float] = field(default_factory=dict)

    def emission(self, word: str) -> float:
        found = self.memory.get(word)
        if found is None:
            weights = self.weights
            found = self.bias + sum(weights.get(f, 0.0) for f in features(word, self.marks))
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[word] = found
        return found

    def marginals(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """For each text the marginals of its words being toxic."""
        waiting: list[int] = []
        values: list[float] = []
        known, emission = self.memory, self.emission
        for text in texts:
            words = WORD.findall(text)
            values += [known[w] if w in known else emission(w) for w in words]
            waiting.append(len(words))
            if len(values) >= BATCH:
                yield from self._solve(values, waiting)
                waiting, values = [], []
        yield from self._solve(values, waiting)

    def _solve(self, values: list[float], lengths: list[int]) -> list[np.ndarray]:
        ends = np.cumsum(lengths, dtype=np.int64)
        first = np.zeros(len(values), bool)
        starts = ends - np.array(lengths, np.int64)
        first[starts[starts < len(values)]] = True
        marginal, _ = forward_backward(np.array(values), first, self.transition)
        return np.split(marginal, ends[:-1]) if lengths else []


def evidence(marginals: np.ndarray) -> tuple[float, float, float]:
    """What a document's score is made of: the log-odds of its worst token, their sum, a constant."""
    if not len(marginals):
        return -10.0, 0.0, 1.0
    worst = min(max(float(marginals.max()), 1e-9), 1 - 1e-9)
    return max(-10.0, min(10.0, math.log(worst / (1 - worst)))), math.log1p(float(marginals.sum())), 1.0


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps."""
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty * np.eye(len(c))
        c = c - np.linalg.solve(hessian, x.T @ (p - y) + penalty * c)
    return c


def fit(texts: list[str], toxic: list[bool]) -> Field:
    """The field for labelled documents; without examples of both kinds it scores all alike."""
    chosen = marks(texts, toxic)
    vocabulary: dict[str, int] = {}
    names: dict[str, int] = {}
    word_of: list[int] = []
    feature_of: list[int] = []
    marked: list[bool] = []
    sequences, labels = [], []
    for text, is_toxic in zip(texts, toxic, strict=True):
        codes = []
        for word in WORD.findall(text):
            code = vocabulary.get(word)
            if code is None:
                code = vocabulary[word] = len(vocabulary)
                own = features(word, chosen)
                for f in own:
                    word_of.append(code)
                    feature_of.append(names.setdefault(f, len(names)))
                marked.append(own[-1] == "#")
            codes.append(code)
        codes = np.array(codes, np.int64)
        sequences.append(codes)
        labels.append(np.array(marked, bool)[codes] & is_toxic if len(codes) else np.zeros(0, bool))
    lengths = np.array([len(s) for s in sequences], np.int64)
    share = sum(map(bool, toxic)) / max(1, len(toxic))
    model = Field(chosen, {}, -6.0, np.zeros((2, 2)), np.array([0.0, 0.0, math.log(max(share, 1e-3) / max(1 - share, 1e-3))]))
    if not len(lengths) or not lengths.sum() or not 0 < share < 1:
        return model
    codes = np.concatenate(sequences)
    y = np.concatenate(labels).astype(float)
    first = np.zeros(len(codes), bool)
    starts = np.cumsum(lengths) - lengths
    first[starts[lengths > 0]] = True
    word_of, feature_of = np.array(word_of), np.array(feature_of)
    cuts = [0]
    for s in starts[lengths > 0]:
        if s - cuts[-1] >= 4 * BATCH:
            cuts.append(int(s))
    cuts.append(len(codes))
    inside = ~first
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inside[1:]].astype(int), y[1:][inside[1:]].astype(int)), 1)
    w, bias, transition = np.zeros(len(names)), -3.0, np.zeros((2, 2))
    size = np.zeros(len(names) + 5)
    scale = max(1.0, y.sum())
    for _ in range(ROUNDS):
        per_word = np.bincount(word_of, w[feature_of], len(vocabulary)) + bias
        slope = np.zeros(len(vocabulary))
        slope_t = -seen
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            p, expected = forward_backward(per_word[codes[a:b]], first[a:b], transition)
            slope += np.bincount(codes[a:b], p - y[a:b], len(vocabulary))
            slope_t = slope_t + expected
        g = np.bincount(feature_of, slope[word_of], len(names)) / scale + 1e-4 * w
        g = np.concatenate([g, [slope.sum() / scale], slope_t.ravel() / scale])
        size += g * g
        step = 0.5 * g / np.sqrt(size + 1e-8)
        w -= step[: len(names)]
        bias -= step[len(names)]
        transition -= step[len(names) + 1 :].reshape(2, 2)
    model.weights = {f: float(w[i]) for f, i in names.items() if abs(w[i]) > 1e-2}
    model.bias, model.transition = float(bias), transition
    x = np.array([evidence(m) for m in model.marginals(texts)])
    model.score = _logistic(x, np.array(toxic, float))
    return model


def tagger(model: Field):
    """A column function: text to its score and offending spans (code points, end exclusive)."""

    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = [t or "" for t in texts]
            rows = []
            for text, marginal in zip(texts, model.marginals(texts), strict=True):
                odds = float(np.dot(model.score, evidence(marginal)))
                spans = []
                if len(marginal) and marginal.max() >= SPAN:
                    spans = [
                        {"start": m.start(), "end": m.end(), "marginal": float(p)}
                        for m, p in zip(WORD.finditer(text), marginal, strict=True)
                        if p >= SPAN
                    ]
                rows.append((1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))), spans))
            yield pd.DataFrame(rows, columns=["score", "spans"])

    return udf(tag, SCHEMA)


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Field:
    """The field fitted on labelled rows of ``docs`` (doc_id, text) for which ``usable`` holds.

    At most TOXIC_ROWS and CLEAN_ROWS rows of texts up to FIT_CHARS are taken, the first by a hash
    of the text, so the fit is bounded and does not depend on partitioning. They are chosen on ids
    and hashes; no other text is shuffled or sent to the driver. Null labels, ids and texts take no
    part.
    """
    text = docs.where(usable & F.col("text").isNotNull() & (F.length("text") <= FIT_CHARS))
    named = text.select("doc_id", F.xxhash64(F.lit(3), "text").alias("h"), "text")
    known = named.select("doc_id", "h").join(labels.select("doc_id", "toxic").dropna().distinct(), "doc_id")
    # The rows are chosen by their names; only the texts of those chosen are read then.
    chosen = pd.concat(
        [
            known.where(F.col("toxic") == kind).orderBy("h", "doc_id").limit(rows).toPandas()
            for kind, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
        ]
    )
    if chosen.empty:
        return fit([], [])
    names = docs.sparkSession.createDataFrame(chosen[["doc_id", "h"]].drop_duplicates())
    texts = named.join(F.broadcast(names), ["doc_id", "h"]).toPandas().drop_duplicates(["doc_id", "h"])
    rows = chosen.merge(texts, on=["doc_id", "h"]).sort_values(["toxic", "h", "text"], ascending=[False, True, True])
    return fit(list(rows.text), [t == 1 for t in rows.toxic])


def score(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``: a struct of score (0 to 1) and offending spans.

    A null text counts as empty; a text without words gets the score of no evidence.
    """
    return docs.withColumn("toxicity", tagger(model)(F.col(text)))
