"""Language of texts by unigram pieces, summed over all segmentations.

Each language is a distribution over the pieces of a fixed public byte-level vocabulary. A word has
many segmentations into pieces; its probability in a language is the sum over all of them of the
product of their pieces' probabilities, by a forward pass. A text's score is the sum of its words'
logarithms and of the logarithm of the language's share of the texts learned from; the largest
wins, and ``score`` is its posterior.

A word is a run of letters, in lower case, behind one blank; runs longer than ``LONGEST`` letters
go on as further words, so no letter is dropped. Pieces that such words can't hold are left out.

Learning is expectation maximisation, ``ROUNDS`` passes over all texts to learn from: forward and
backward passes give the expected number of times that each piece is used, in the first round with
all pieces alike. A task adds up its own texts first and sends one row per language and used piece,
so what is shuffled and what the model holds is bounded by languages x pieces, while the counts
cover the whole corpus. ``FLOOR`` of each distribution is spread evenly over all pieces: unseen
pieces stay possible, and no product of ``LONGEST`` letters leaves the range of doubles (each step
is scaled by ``SCALE`` per byte).

Rows with null text or null language teach nothing; a text without letters teaches its language's
share only. To predict: null text, empty text or text without any letter gives ``und`` and score 0,
as does every text if nothing was learned from. Equal scores go to the language that comes first.
Rows are independent: no shuffle. Memory is a batch of texts and its distinct words. The language
is a key of the model, so more than ``LANGUAGES`` of them are refused, not cut.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import ship, udf

LONGEST = 16  # letters in a word
ROUNDS = 2
FLOOR = 1e-3
SCALE = np.exp(8.0)
LANGUAGES = 200  # the model of so many is about 8 million numbers
UNKNOWN = "und"  # fixed value
LETTERS = re.compile(r"[^\W\d_]+")
PREDICTED = "lang_pred string, score double"
PART = 200_000  # distinct words in one forward pass


def read_pieces(path: str) -> bytes:
    """A rank file's content (base64 piece, blank, rank per line); its size is the vocabulary's."""
    with open(path, "rb") as file:
        return file.read()


class Trie:
    """The pieces that words can hold, as a table of states: state 0 is none, state 1 the root."""

    def __init__(self, content: bytes):
        pieces = sorted(base64.b64decode(line.split()[0]) for line in content.splitlines() if line.strip())
        pieces = [p for p in pieces if self._usable(p)]
        every = {bytes([b]) for b in [32, *range(97, 123), *range(128, 256)]}
        pieces = sorted({*pieces, *every})  # each byte is a piece, so each word has a segmentation
        states, steps = {b"": 1}, []
        for piece in pieces:
            for end in range(1, len(piece) + 1):
                if piece[:end] not in states:
                    states[piece[:end]] = len(states) + 1
                    steps.append((states[piece[: end - 1]], piece[end - 1], states[piece[:end]]))
        self.states = len(states) + 1
        self.step = np.zeros((self.states, 256), np.int32)
        at, byte, to = np.array(steps).T
        self.step[at, byte] = to
        self.step = self.step.ravel()
        self.of_piece = np.array([states[p] for p in pieces], np.int32)
        self.scale = SCALE ** np.array([len(p) for p in pieces])
        self.longest = max(map(len, pieces))

    @staticmethod
    def _usable(piece: bytes) -> bool:
        """Whether a blank can only be its first byte and the rest are no ASCII but lower-case letters."""
        rest = piece.removeprefix(b" ")
        return len(piece) > 0 and all(b >= 128 or 97 <= b <= 122 for b in rest)


_TRIES: dict[bytes, Trie] = {}  # of this Python worker, for all its tasks


def trie(content: bytes) -> Trie:
    key = hashlib.sha256(content).digest()
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = Trie(content)
    return _TRIES[key]


def words(text: str) -> list[str]:
    """The words of a text, whole."""
    found = LETTERS.findall(text.lower())
    if not text.isascii() and not all(map(str.isalpha, found)):  # numerals other than digits are no letters
        found = ["".join(c if c.isalpha() else " " for c in w) for w in found]
        found = [w for run in found for w in run.split()]
    if len(found) == 0 or len(max(found, key=len)) <= LONGEST:
        return found
    return [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]


class Columns:
    """Distinct words as columns of bytes, longest words first.

    The words that have a byte at a place are then a prefix of all, so every step is over slices.
    """

    def __init__(self, words: list[str], pieces: Trie):
        data = [b" " + w.encode() for w in words]
        sizes = np.array([len(d) for d in data])
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.pieces = pieces
        self.length = int(self.sizes[0]) if len(data) else 0
        self.held = [int(np.searchsorted(-self.sizes, -i, "right")) for i in range(self.length + 1)]
        table = np.zeros((len(data), self.length), np.uint8)
        joined = np.frombuffer(b"".join(data), np.uint8)
        table[np.arange(self.length) < sizes[:, None]] = joined
        self.at = [np.ascontiguousarray(table[self.order[: self.held[i + 1]], i]).astype(np.int32) for i in range(self.length)]

    def matches(self, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """End, words and states of all that can be a piece, or go on as one, from a place."""
        step, state = self.pieces.step, None
        for end in range(start, min(self.length, start + self.pieces.longest)):
            if state is None:
                index = np.arange(self.held[end + 1])
                state = step[256 + self.at[end]]
            else:
                still = index < self.held[end + 1]
                index, state = index[still], state[still]
                state = step[state * 256 + self.at[end][index]]
            alive = state > 0
            index, state = index[alive], state[alive]
            if not len(index):
                return
            yield end + 1, index, state

    def forward(self, weights: np.ndarray) -> list[np.ndarray]:
        """Per place, the sum over all segmentations up to it; ``weights``: states x languages."""
        sums = [np.zeros((self.held[i], weights.shape[1])) for i in range(self.length + 1)]
        sums[0][:] = 1
        for start in range(self.length):
            for end, index, state in self.matches(start):
                sums[end][index] += sums[start][index] * weights[state]
        return sums

    def last(self, sums: list[np.ndarray]) -> np.ndarray:
        """Of each word (in order of length) the value at its end."""
        found = np.empty((len(self.sizes), sums[0].shape[1] if sums else 1))
        for size in set(self.sizes.tolist()):
            own = self.sizes == size
            found[own] = sums[size][own[: self.held[size]]]
        return found

    def log_sums(self, weights: np.ndarray) -> np.ndarray:
        """Each word's log probability in each language, in the order given."""
        found = np.empty((len(self.sizes), weights.shape[1]))
        found[self.order] = np.log(self.last(self.forward(weights))) - self.sizes[:, None] * np.log(SCALE)
        return found

    def used(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each state in one language, words counted so often."""
        counts = counts[self.order]
        sums = self.forward(weights)
        share = counts / self.last(sums)[:, 0]
        back = [np.zeros(self.held[i]) for i in range(self.length + 1)]
        found = np.zeros(len(weights))
        for start in reversed(range(self.length + 1)):
            ended = slice(self.held[start + 1] if start < self.length else 0, self.held[start])
            back[start][ended] = share[ended]
            if start == self.length:
                continue
            for end, index, state in self.matches(start):
                value = back[end][index] * weights[state, 0]
                back[start][index] += value
                found += np.bincount(state, value * sums[start][index, 0], len(found))
        return found


class Model:
    """Languages, their numbers of texts, and how often each uses each piece (pieces x languages)."""

    def __init__(self, languages: list[str], texts: np.ndarray, uses: np.ndarray, content: bytes):
        self.languages, self.texts, self.uses, self.content = languages, texts, uses, content

    def weights(self) -> np.ndarray:
        """By state of the trie; states that are no piece weigh nothing."""
        pieces = trie(self.content)
        total = self.uses.sum(axis=0)
        known = np.where(total > 0, self.uses / np.where(total > 0, total, 1), 1 / len(self.uses))
        known = (1 - FLOOR) * known + FLOOR / len(self.uses)
        found = np.zeros((pieces.states, self.uses.shape[1]))
        found[pieces.of_piece] = known * pieces.scale[:, None]
        return found


def _learned(docs: DataFrame, text: str, lang: str, model: Model | None, content) -> pd.DataFrame:
    """Uses of each piece by language, and texts per language (piece -1), as sums over all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = trie(content.value)
        if model is None:
            alike = Model([""], np.ones(1), np.zeros((len(pieces.of_piece), 1)), content.value).weights()
        else:
            own = model.weights()
            weights_of = {name: own[:, [i]] for i, name in enumerate(model.languages)}
        totals: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for name, group in batch.groupby("lang"):
                texts[name] = texts.get(name, 0) + len(group)
                found: dict[str, int] = {}
                for whole in group["text"]:
                    for word in words(whole):
                        found[word] = found.get(word, 0) + 1
                if not found:
                    continue
                weights = alike if model is None else weights_of[name]
                distinct, counts = list(found), np.fromiter(found.values(), float, len(found))
                sums = totals.setdefault(name, np.zeros(pieces.states))
                for i in range(0, len(distinct), PART):
                    sums += Columns(distinct[i : i + PART], pieces).used(weights, counts[i : i + PART])
        for name, n in texts.items():
            uses = totals.get(name, np.zeros(pieces.states))[pieces.of_piece]
            used = np.flatnonzero(uses)
            yield pd.DataFrame({"lang": name, "piece": [-1, *used], "uses": [float(n), *uses[used]]})

    ship(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sums = rows.mapInPandas(count, "lang string, piece int, uses double")
    return sums.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()


def train(docs: DataFrame, path: str, text: str = "text", lang: str = "lang", rounds: int = ROUNDS) -> Model:
    """The model of all rows of ``docs``."""
    spark = docs.sparkSession
    pieces = read_pieces(path)
    content = spark.sparkContext.broadcast(pieces)
    number = len(trie(pieces).of_piece)
    known = docs.where(F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang")).dropna()
    if known.distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    model = None
    for _ in range(rounds):
        found = _learned(docs, text, lang, model, content).sort_values(["lang", "piece"])
        texts = found[found["piece"] < 0].set_index("lang")["uses"]
        languages = sorted(texts.index, key=str.encode)
        place = {name: i for i, name in enumerate(languages)}
        uses = np.zeros((number, len(languages)))
        rest = found[found["piece"] >= 0]
        uses[rest["piece"].to_numpy(int), rest["lang"].map(place).to_numpy(int)] = rest["uses"]
        model = Model(languages, texts.reindex(languages).to_numpy(float), uses, pieces)
        if not languages:
            break
    return model


def predict(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """Language and posterior of a text, as a struct."""
    shared = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        languages = model.languages
        if languages:
            pieces, weights = trie(model.content), model.weights()
            shares = np.log(model.texts / model.texts.sum())
        for texts in batches:
            place: dict[str, int] = {}
            at, ends = [], []
            for whole in texts:
                if whole and languages:
                    at += [place.setdefault(w, len(place)) for w in words(whole)]
                ends.append(len(at))
            made = pd.DataFrame({"lang_pred": UNKNOWN, "score": np.zeros(len(ends))})
            if at:
                distinct = list(place)
                logs = np.concatenate(
                    [Columns(distinct[i : i + PART], pieces).log_sums(weights) for i in range(0, len(distinct), PART)]
                )
                starts = np.array([0, *ends[:-1]])
                own = np.flatnonzero(np.array(ends) > starts)
                sums = np.add.reduceat(logs[at], starts[own]) + shares
                best = sums.argmax(axis=1)
                made.loc[own, "lang_pred"] = np.array(languages, object)[best]
                made.loc[own, "score"] = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            yield made

    return udf(judge, PREDICTED)(text)
