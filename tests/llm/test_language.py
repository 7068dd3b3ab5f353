"""Marginalised unigrams against sums over listed segmentations."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from lakemart.llm import language
from lakemart.llm.queries import op13_marginal_language

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CONTENT = language.read_pieces(PATH)
TRIE = language.trie(CONTENT)


def piece_ids():
    """Piece to its number, read back from the table of states."""
    steps = TRIE.step.reshape(-1, 256)
    texts, todo = {}, [(1, b"")]
    while todo:
        state, text = todo.pop()
        texts[state] = text
        todo += [(int(steps[state, b]), text + bytes([b])) for b in np.flatnonzero(steps[state])]
    return {texts[s]: i for i, s in enumerate(TRIE.of_piece.tolist())}


PIECES = piece_ids()


def segmentations(data):
    if not data:
        yield []
    for end in range(1, len(data) + 1):
        if data[:end] in PIECES:
            for rest in segmentations(data[end:]):
                yield [PIECES[data[:end]], *rest]


def probabilities(uses):
    total = uses.sum(axis=0)
    known = np.where(total > 0, uses / np.where(total > 0, total, 1), 1 / len(uses))
    return (1 - language.FLOOR) * known + language.FLOOR / len(uses)


def chance(word, p):
    return sum(math.prod(p[i] for i in s) for s in segmentations(b" " + word.encode()))


def expected_uses(counts, p):
    found = np.zeros(len(p))
    for word, n in counts.items():
        whole = chance(word, p)
        for s in segmentations(b" " + word.encode()):
            for i in s:
                found[i] += n * math.prod(p[j] for j in s) / whole
    return found


def test_words():
    assert language.words("Über 2 x² ½ don't_stop\nÅ") == ["über", "x", "don", "t", "stop", "å"]
    assert language.words("") == [] and language.words("12 ²³ -- _") == []
    assert language.words("a" * 35) == ["a" * 16, "a" * 16, "aaa"]
    assert "".join(language.words("中文" * 30)) == "中文" * 30


def test_passes_equal_listed_segmentations():
    random = np.random.default_rng(2)
    uses = random.random((len(PIECES), 2)) * (random.random((len(PIECES), 2)) < 0.5)
    weights = language.Model(["a", "b"], np.ones(2), uses, CONTENT).weights()
    counts = Counter({"the": 3, "a": 1, "üb": 2, "there": 4, "中": 1, "zq": 2, "q": 5})
    columns = language.Columns(list(counts), TRIE)
    p = probabilities(uses)
    got = columns.log_sums(weights)
    want = [[math.log(chance(w, p[:, i])) for i in range(2)] for w in counts]
    assert np.allclose(got, want, rtol=1e-12)
    got = columns.used(weights[:, [1]], np.array(list(counts.values()), float))[TRIE.of_piece]
    assert np.allclose(got, expected_uses(counts, p[:, 1]), rtol=1e-9)
    assert abs(sum(n * len(w) for w, n in zip(PIECES, got)) - sum(n * (1 + len(w.encode())) for w, n in counts.items())) < 1e-9


def test_least_and_most_likely_words_stay_in_range():
    uses = np.zeros((len(PIECES), 2))
    uses[PIECES[b"a"], 0] = uses[PIECES[b" "], 0] = 1
    uses[PIECES[b"z"], 1] = 1e15
    weights = language.Model(["a", "b"], np.ones(2), uses, CONTENT).weights()
    columns = language.Columns(["𐐨" * 16, "a" * 16, "b"], TRIE)
    assert np.isfinite(columns.log_sums(weights)).all()
    assert np.isfinite(columns.used(weights[:, [1]], np.full(3, 1e12))).all()


ROWS = [
    ("the of and", "en"),
    ("the the an", "en"),
    ("und der die", "de"),
    ("der und", "de"),
    ("öl über", "de"),
    ("", "en"),
    ("123 !", "fr"),
    ("the", None),
    (None, "en"),
    ("Of The 中", "en"),
    ("mm " * 2000, "x"),
]


def brute(rows):
    """Two rounds of learning and the verdicts, over listed segmentations."""
    learn = [(t, g) for i, t, g in rows if t is not None and g is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    names = sorted({g for _, g in learn})
    texts = np.array([sum(g == n for _, g in learn) for n in names], float)
    counts = [Counter(w for t, g in learn if g == n for w in language.words(t)) for n in names]
    p = probabilities(np.zeros((len(PIECES), len(names))))
    for _ in range(language.ROUNDS):
        p = probabilities(np.stack([expected_uses(c, p[:, i]) for i, c in enumerate(counts)], axis=1))
    out = []
    for i, t, _ in rows:
        own = Counter(language.words(t or ""))
        held = zlib.crc32(str(i).encode()) % 4 == 2
        if not own:
            out.append((i, held, "und", 0.0))
            continue
        sums = np.log(texts / texts.sum()) + [
            sum(n * math.log(chance(w, p[:, k])) for w, n in own.items()) for k in range(len(names))
        ]
        out.append((i, held, names[int(sums.argmax())], 1 / np.exp(sums - sums.max()).sum()))
    return out


def test_query_equals_listed_segmentations(spark, tmp_path):
    rows = [(i, t, g) for i, (t, g) in enumerate(ROWS * 2)]
    docs = spark.createDataFrame([(*r, "held", 1) for r in rows], "doc_id long, text string, lang string, source string, lang_pred int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r) for r in op13_marginal_language(spark, str(tmp_path)).collect()}
    for want in brute(rows):
        assert got[want[0]][:3] == want[:3] and math.isclose(got[want[0]][3], want[3], rel_tol=1e-5)


def test_nothing_to_learn_from(spark, tmp_path):
    kind = "doc_id long, text string, lang string"
    spark.createDataFrame([(None, "abc", None), (2, None, "en")], kind).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = op13_marginal_language(spark, f"{tmp_path}/a").collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)} and len(got) == 2
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert op13_marginal_language(spark, f"{tmp_path}/b").collect() == []


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    docs = spark.range(4).selectExpr("'a' text", "string(id) lang")
    with pytest.raises(ValueError):
        language.train(docs, PATH)


def test_held_out_accuracy(spark):
    got = op13_marginal_language(spark, "/root/testdata/sf0.01").where("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    row = got.join(truth, "doc_id").selectExpr("avg(int(lang = lang_pred)) a", "count(*) n").first()
    assert row.n > 200 and row.a >= 0.97
