"""Training-data operators against brute force, and their edge cases."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lakemart.llm import ann, bpe, jaccard, mixing, pii, quality, secret_scan, sharding, suffix, toxicity
from lakemart.llm.components import components

TEXTS = [None, "", " \n", "one", "A b c d e", "a B c d e", "x " * 3000, "é" * 50, "Tel +1 (017) 555-7713"]
SCHEMA = "doc_id long, text string, source string, score double, root string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i % 4 else None, t, None if i % 3 else "s", 0.5, "r") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + rows[3:6], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_equals_tiktoken():
    coder = bpe.Coder(
        bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    )
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={}
    )
    random = np.random.default_rng(0)
    parts = ["a", "the", "ing", "é", "=", "-", "  ", "\n", "中", "😀", "1", "'s", "\xa0", "\x1c", "\x85", "ab"]
    for n in [3, 30, 300] * 100:
        text = "".join(random.choice(parts[: random.integers(1, len(parts))], n))
        assert coder.encode(text) == known.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()
    for text in ["a" * 4000, "ab" * 2001, "=" * 777]:
        assert coder.encode(text) == known.encode_ordinary(text)


def test_secrets_in_layers():
    import base64
    import gzip

    inner = 'api_key = "0123456789abcdef0123"'
    assert [s[:3] for s in secret_scan.scan("x " + inner)] == [("assign", 2, 33), ("hex", 13, 33)]
    for wrapped in (
        base64.b64encode(inner.encode()).decode(),
        base64.b64encode(gzip.compress(inner.encode())).decode(),
        "".join(f"%{b:02x}" for b in inner.encode()),
        "".join(f"\\u{ord(c):04x}" for c in inner),
    ):
        found = secret_scan.scan(f"see {wrapped} end")
        added = [s for s in found if not s[3]]
        assert any(k == "assign" for k, *_ in added)
        assert all(4 <= a < b <= 4 + len(wrapped) for _, a, b, _ in added)
    assert secret_scan.scan("token: secret: abcdefghijklmnop") == []


def test_secrets_in_base64_broken_into_lines():
    import base64
    import gzip

    random = np.random.default_rng(5)
    inner = b'password = "Zq8Kp2Lm9Rt4Wx"'
    noise = bytes(random.integers(97, 123, 400, dtype=np.uint8))
    for at in range(0, 90, 7):  # the secret falls on every place of a line
        plain = noise[:at] + b"\n" + inner + b"\n" + noise
        for layer in (plain, gzip.compress(plain), gzip.compress(base64.encodebytes(gzip.compress(plain)))):
            lines = base64.encodebytes(layer).decode()
            for wrapped in (lines, lines.replace("\n", "\r\n"), lines.replace("\n", "\n    ")):
                text = f"begin:\n{wrapped}\nend of it\n"
                spans = [s for s in secret_scan.scan(text) if s[0] == "assign"]
                assert spans and all(7 <= a < b <= 7 + len(wrapped) for _, a, b, _ in spans)
    # two blocks of other lengths behind each other
    first, second = (base64.encodebytes(noise[:n] + b"\n" + inner).decode() for n in (50, 3))
    text = first + "\n".join(second[i : i + 20] for i in range(0, len(second.strip()), 20))
    assert len({s[:3] for s in secret_scan.scan(text) if s[0] == "assign"}) >= 2
    assert secret_scan.scan("a word\nand another\n" * 50) == []


def test_secrets_in_whole_layers():
    import base64
    import bz2
    import gzip

    random = np.random.default_rng(7)
    inner = b'password = "Zq8Kp2Lm9Rt4Wx"'
    noise = bytes(random.integers(33, 127, 3000, dtype=np.uint8)).replace(b"=", b",")
    layers = [
        base64.urlsafe_b64encode(gzip.compress(noise + b"\n" + inner)),
        base64.b64encode(gzip.compress(b"first\n") + gzip.compress(inner)),
        base64.b64encode(bz2.compress(b"first\n") + bz2.compress(inner)),
        base64.b64encode(gzip.compress("é".encode() * (1 << 20) + b"x" * 3 + (b"a b\n" * (1 << 24)) + inner)),
    ]
    deep = inner
    for _ in range(80):
        deep = gzip.compress(deep)
    for data in [*layers, base64.b64encode(deep)]:
        found = secret_scan.scan(f"see {data.decode()} end")
        assert ("assign", 4, 4 + len(data), False) in found


def test_secrets_beside_odd_characters():
    import base64
    import gzip

    inner = 'password = "Zq8Kp2Lm9Rt4Wx"'
    for odd in ("\xa0", "\u200d", "\xad", "\ufeff", "\f", "\x00"):
        data = f"{odd}prose {inner} {odd}".encode()
        at = (len(odd.encode()) + 6) * 8 // 6
        found = secret_scan.scan(f"see {base64.b64encode(data).decode()} end")
        assert [(k, a) for k, a, _, base in found if not base] == [("assign", 4 + at)]
        nested = base64.b64encode(gzip.compress(data)).decode()
        assert [s[0] for s in secret_scan.scan(nested) if not s[3]] == ["assign"]
    data = b"caf\xe9 " + inner.encode() + b" \xff"
    place = (5 * 8 // 6, ((5 + len(inner) - 1) * 8 - 1) // 6 + 1)  # the value's last quote is no part
    assert ("assign", *place, False) in secret_scan.scan(base64.b64encode(data).decode())
    url = "".join(f"%{b:02x}" for b in data)
    assert ("assign", 15, 15 + 3 * (len(inner) - 1), False) in secret_scan.scan(url)
    assert any(s[0] == "assign" for s in secret_scan.scan("\\ud800" + "".join(f"\\u{ord(c):04x}" for c in inner)))


def test_forward_backward_equals_enumeration():
    random = np.random.default_rng(1)
    emission, move = random.normal(size=300), random.normal(size=(2, 2))
    first = np.zeros(300, bool)
    first[[0, 1, 7, 200]] = True
    marginal, _ = toxicity.forward_backward(emission, first, move)
    for a, b in ((0, 1), (1, 7), (200, 300)):
        w = np.stack([np.ones(b - a), np.exp(emission[a:b])], 1)
        f, g = w.copy(), np.ones_like(w)
        for t in range(1, b - a):
            f[t] = f[t - 1] @ np.exp(move) * w[t]
        for t in range(b - a - 2, -1, -1):
            g[t] = np.exp(move) @ (w[t + 1] * g[t + 1])
        p = f * g
        assert np.allclose(marginal[a:b], (p / p.sum(1, keepdims=True))[:, 1])


def test_repeated_words():
    words = [b"w%d" % i for i in range(20)]
    assert quality.repeated_words(words) == 0
    with np.errstate(over="ignore"):
        assert quality.repeated_words(words[:8] + [b"x"] + words[:8]) == 16


def test_capitals_are_counted_in_every_text():
    at = len(quality.STATS) + quality.FEATURES.index("capitals")
    for text in ["MOSTLY CAPITAL Text x", "ÄÖ ß É Ünd", "all small", "ALL"]:
        chars = len(text.replace(" ", ""))
        assert quality.measure(text)[at] == sum(c.isupper() for c in text) / chars


def test_forest_splits_features_that_good_rows_do_not_vary(spark):
    random = np.random.default_rng(6)
    words = [f"word{i}" for i in range(3000)]
    good = [" ".join(random.choice(words, 40)) + "." for _ in range(300)]
    junk = [t.replace(" ", " ### ") for t in good[:60]]
    rows = [(i, t) for i, t in enumerate(good + junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(len(rows))], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.keep(docs, labels).collect()}
    assert sum(i < 300 for i in kept) >= 298
    assert sum(i >= 300 for i in kept) <= 6


def test_threshold_uses_both_labels():
    bins, good = np.array([90, 80, 70, 60]), np.array([0, 1, 1, 998])
    assert quality.threshold(bins, good, np.array([5, 5, 0, 0])) == 80 / quality.BINS
    assert quality.threshold(bins, good, np.zeros(4, int)) == 70 / quality.BINS


def test_suffix_removal_equals_brute_force(spark):
    random = np.random.default_rng(2)
    base = "".join(random.choice(list("abcdefg é"), 900))
    texts = [base, base[:700], "z" + base[100:800] + "y", "q" * 600, base[::-1], None, "", base, "short"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + 100] for d in data for i in range(len(d) - 99))
    for row in suffix.remove(df, window=100).collect():
        d = data[row.doc_id]
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 99):
            if count[d[i : i + 100]] > 1:
                gone[i : i + 100] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        assert (row.n_removed, row.kept_sha256) == (gone.sum(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_join_equals_brute_force(spark, k, percent):
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for n in (4, 12, 40, 90):
        base = list(random.choice(words, n))
        texts += [" ".join(base)]
        for edits in (0, 1, 1, 2, 3, 5):
            copy = list(base)
            for _ in range(edits):
                copy[random.integers(n)] = random.choice(words)
            texts.append(" ".join(copy))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))})
    least = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= percent * len(a | b):
                    least[i] = min(least[i], least[j])
    found = {r.doc_id: r.component_id for r in jaccard.join(df, k=k, percent=percent).collect()}
    assert [found[i] for i in range(len(texts))] == least


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(50, 40)], "a long, b long")
    roots = {r.id: r.root for r in components(links).collect()}
    assert roots == {i: 1 for i in range(1, 21)} | {40: 40, 50: 40}


def test_near_ties_at_large_norms():
    random = np.random.default_rng(8)
    import pandas as pd

    for _ in range(20):
        base = random.normal(size=24) * 1e4
        v = base + random.integers(0, 3, size=(60, 24)) * 1e-11
        q = random.normal(size=(3, 24)) * 1e4
        ids = np.arange(60)
        index = pd.DataFrame({"c": [str(i) for i in ids], "least": ids, "v": list(v)})
        queries = pd.DataFrame({"c": [f"q{i}" for i in range(3)], "v": list(q)})
        found = ann._score(5)(index, queries)
        for i in range(3):
            exact = (v * q[i]).sum(axis=1)
            want = np.lexsort((ids, -exact))[:5]
            assert found[found.q == f"q{i}"].c.astype(int).tolist() == want.tolist()


def test_neighbours_without_cut(spark):
    random = np.random.default_rng(4)
    v = random.normal(size=(40, 5)).round(3)
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(90, [0.0] * 5), (91, None), (92, [None] * 5)]
    rows += [(100 + i, v[0].tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [r for r in ann.search(df, every=20, k=5).collect() if r.query_id == 20]
    every = [(-float(np.dot(v[20], x)), i) for i, x in rows[:40] + rows[43:] if i != 20]
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [i for _, i in sorted(every)[:5]]


def test_personal_data(spark):
    text = "a@b.c_d@e.f 1.2.3.999 10.0.0.1 x 4111 1111 1111 1111 DE89370400440532013000"
    df = spark.createDataFrame([(text,), (None,), ("1" * 20000,)], "text string")
    spans = [[(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(df).collect()]
    email = [("email", m.start(), m.end()) for m in re.finditer(r"[\w.%+-]+@[a-z-]+(\.[a-z-]+)+", text)]
    assert spans[0] == [*email, ("ip", 22, 30), ("card", 33, 52), ("iban", 53, 75)]
    assert spans[1:] == [[], []]
    assert pii.redact(df).first().text == "[EMAIL][EMAIL] 1.2.3.999 [IP] x [CARD] [IBAN]"


def test_account_numbers_before_other_words(spark):
    de, spaced, gb = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    texts = {
        f"{de} Bank": [de],
        f"é {de} I paid": [de],
        f"{spaced} BIC COBADEFF": [spaced],
        f"{de} 4711": [de],
        f"{de} IS THE ACCOUNT OF MY OLD BANK IN TOWN": [de],
        f"{de} {gb}, {spaced}": [de, gb, spaced],
        f"AB12 {de}": [de],
        f"{de}x {de[:-1]}1 Bank": [],
        "XX" + de[2:]: [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in pii.find(df).collect():
        spans = [s for s in row.spans if s.kind == "iban"]
        assert [s.value for s in spans] == texts[row.text], row.text
        assert all(row.text[s.start : s.end] == s.value for s in spans)
    assert pii.redact(df).first().text == "[IBAN] Bank"


def test_mixing_and_sharding(spark):
    rows = [(i, "a" if i % 3 else None, 1 + i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.decide(df).toPandas()
    assert len(got) == 400 and got.copies.between(0, 2).all()
    for _, part in got.groupby("source", dropna=False):
        assert abs((part.copies * part["size"]).sum() - part.target.iloc[0]) <= 7
    again = mixing.decide(df.repartition(5)).toPandas().set_index("doc_id").copies
    assert again.sort_index().equals(got.set_index("doc_id").copies.sort_index())
    shards = sharding.interleave(df, "source", 40).toPandas()
    assert set(shards.shard.value_counts()) == {10}
    assert all(sorted(g.slot) == list(range(10)) for _, g in shards.groupby("shard"))


@pytest.mark.parametrize("which", ["odd", "none"])
def test_edge_cases(spark, request, which):
    df = request.getfixturevalue(which)
    n = df.count()
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    assert suffix.remove(df).count() == n
    assert jaccard.join(df).count() == n
    assert jaccard.keep_one(df).columns == df.columns
    assert pii.redact(df).count() == n
    assert quality.keep(df, labels).columns == df.columns
    assert df.select(secret_scan.spans("text")).count() == n
    from pyspark.sql import functions as F

    assert mixing.mix(df, F.coalesce(F.length("text"), F.lit(0)).cast("long")).columns == df.columns
    model = toxicity.train(df.select("doc_id", "text"), labels, F.lit(True))
    scores = [r.toxicity.score for r in toxicity.score(df, model).collect()]
    assert len(scores) == n and all(0 <= s <= 1 for s in scores)
