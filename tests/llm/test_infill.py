"""Fill-in-the-middle texts against plain slicing of the lines."""

import hashlib
import re

import numpy as np
import pytest

from lakemart.llm import infill

SCHEMA = "doc_id long, text string, n string, form string, extra int"
TEXTS = [
    None,
    "",
    "\n",
    "\n\n\n",
    "one line",
    "a\nb\nc",
    "a\nb\nc\n",
    "é\r\nü\n\x85x y\n😀",
    "with <S> inside\nand more",
    "almost <S\n> and <\nP>\n<M",
    "x" * 700_000 + "\n" + "y z\n" * 3000,
]


def expected(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_wavelet_matrix_equals_counting():
    random = np.random.default_rng(3)
    for size in [0, 1, 7, 8, 9, 511, 512, 513, 5000]:
        for top in (1, 3, 8):
            codes = random.integers(0, top, size).astype(np.uint8)
            matrix = infill.WaveletMatrix(codes)
            for code in range(8):
                places = np.flatnonzero(codes == code)
                for i in {0, size, *random.integers(0, size + 1, 20).tolist()}:
                    assert matrix.rank(code, i) == int((codes[:i] == code).sum())
                for k in range(0, len(places), max(1, len(places) // 20)):
                    assert matrix.select(code, k) == places[k]


@pytest.mark.parametrize(
    "units, pattern",
    [("lines", r"[^\n]*\n|[^\n]+"), ("words", r"[^ \t\n]*[ \t\n]|[^ \t\n]+"), ("sentences", r"[^.!?\n]*[.!?\n]|[^.!?\n]+")],
)
def test_cuts_equal_matches(units, pattern):
    random = np.random.default_rng(4)
    for n in [0, 1, 2, 10, 300]:
        for _ in range(20):
            text = "".join(random.choice(list("ab1 .!?\n\t-é😀"), n))
            found, matches = infill.Units(text, infill.UNITS[units]), re.findall(pattern, text)
            assert found.number == len(matches)
            for k in range(len(matches) + 1):
                assert found.cut(k) == len("".join(matches[:k]))


def test_texts_equal_slicing_and_come_back(spark):
    given = [(i if i % 4 else None, t, "old", "old", 1) for i, t in enumerate(TEXTS * 4)] + [(7, "a\nb", "o", "o", 2)] * 2
    docs = spark.createDataFrame(given, SCHEMA)
    made = infill.transform(docs)
    assert made.columns == ["doc_id", "text", "extra", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", infill.restored(made.output, made.form)).collect()
    assert len(got) == len(given)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_rates_and_empty_table(spark):
    docs = spark.range(400).selectExpr("id doc_id", "concat('a', char(10), id) text")
    half = infill.transform(docs, rate=50, spm_rate=0).groupBy("form").count().collect()
    assert {r.form for r in half} == {"plain", "psm"} and all(130 < r["count"] < 270 for r in half)
    assert infill.transform(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        infill.transform(docs, markers=("<P>", "<P>", "<M>"))


def test_query_equals_slicing(spark, tmp_path):
    from lakemart.llm.queries import op11_wavelet_fim

    given = [(i if i % 5 else None, t, "en", "s", 1) for i, t in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_wavelet_fim(spark, str(tmp_path)).collect()

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = []
    for i, t, *_ in given:
        n, form, prefix, middle, output = expected(i, t)
        want.append((i, n, form, prefix, middle, sha(output), sha(t or "")))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
