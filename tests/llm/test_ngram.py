import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallygrid.llm import arrays, ngram, queries

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall((text or "").encode().lower()), "end"]


def model(texts):
    """The model by the book, with dictionaries of words."""
    toks = [tokens(t) for t in texts]
    words = Counter(w for t in toks for w in t)
    pairs = Counter(p for t in toks for p in zip(["begin", *t], t))
    after, cont = {}, Counter(w for _, w in pairs)
    for (u, _), c in pairs.items():
        after.setdefault(u, []).append(c)
    coc = lambda cs: [sum(c == i for c in cs) for i in (1, 2, 3, 4)]
    high, low = ngram.discounts(*coc(pairs.values())), ngram.discounts(*coc(cont.values()))
    n, v, m = sum(words.values()), len(words), len(pairs)
    take = lambda d, c: max(c - d[min(c, 3) - 1], 0) if c else 0
    mass = lambda d, cs: sum(d[min(c, 3) - 1] for c in cs)

    def alone(w):
        return (take(low, cont[w]) + mass(low, cont.values()) / (v + 1)) / m if m else 1 / (v + 1)

    def p(u, w):
        if u not in after:
            return alone(w)
        return (take(high, pairs[u, w]) + mass(high, after[u]) * alone(w)) / sum(after[u])

    def score(text):
        t = tokens(text)
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        return len(t), sum(w in words for w in t), n, base, sum(math.log10(p(u, w)) for u, w in zip(["begin", *t], t))

    return score, p, words


def texts(seed, n=200):
    draw = random.Random(seed)
    known = [f"W{i}" for i in range(40)] + ["é", "É", "\x1cx", "a b"]
    weights = [1 / (i + 1) for i in range(len(known))]
    return ["", None, " \n", "THE the The", "w1 " * 3000] + [draw.choice([" ", "\n", "\t "]).join(draw.choices(known, weights, k=draw.randint(0, 30))) for _ in range(n)]


@pytest.fixture(params=["plain", "many files"])
def sizes(request, monkeypatch):
    if request.param == "many files":
        for name, value in (("TOKENS", 100), ("WORDS_PER_FILE", 7), ("TOKENS_PER_FILE", 90), ("TOKENS_PER_VOCABULARY_FILE", 300)):
            monkeypatch.setattr(ngram, name, value)


def test_scores_are_those_of_the_book(spark, sizes):
    rows = [(i, t) for i, t in enumerate(texts(1))] + [(None, "w1 w2"), (3, "again w1"), (3, "again w1")]
    got = ngram.score_corpus(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    score, _, _ = model([t for i, t in rows if not out(i)])
    want = sorted((i is None, i or 0, out(i), *score(t)) for i, t in rows)
    have = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:6] == b[:6] and a[6:] == pytest.approx(b[6:], rel=1e-9)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in got)


def test_probabilities_sum_to_one():
    _, p, words = model(texts(2))
    for u in ["begin", b"w0", b"w7", b"never"]:
        assert sum(p(u, w) for w in [*words, "unknown"]) == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    got = ngram.score_texts(docs, ngram.train(docs.where("false"))).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in got] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert ngram.score_corpus(docs.where("false")).collect() == []


def test_discounts():
    y = 10 / (10 + 2 * 6)
    assert ngram.discounts(10, 6, 4, 3) == pytest.approx((1 - 2 * y * 6 / 10, 2 - 3 * y * 4 / 6, 3 - 4 * y * 3 / 4))
    assert ngram.discounts(5, 0, 1, 1) == (0.5, 1.0, 1.5)
    assert ngram.discounts(1, 100, 1, 1)[0] >= 0.01


def test_array_files(tmp_path):
    folder = f"file://{tmp_path}/a"
    columns = {"key": np.array([1, 5, 2**63], np.uint64), "n": np.array([3, 4, 5], np.uint32)}
    arrays.put(folder, "x", columns)
    arrays.put(folder, "x", {"key": np.zeros(1)})  # another attempt: what is there stays
    got = arrays.get(folder, "x")
    assert all((got[c] == columns[c]).all() and got[c].dtype == columns[c].dtype for c in columns)
    assert arrays.places(got["key"], np.array([0, 5, 6, 2**63], np.uint64)).tolist() == [-1, 1, -1, 2]
    assert arrays.get(folder, "y") is None
    assert len(list((tmp_path / "a").iterdir())) == 1


def test_query_beats_single_words_on_held_out_texts(spark, data):
    got = queries.QUERIES["op12_lm_scoring"](spark, data).toPandas()
    assert len(got) == spark.read.parquet(f"{data}/documents.parquet").count()
    held = got[got.held_out]
    assert 0 < len(held) < len(got) and held.score.sum() > held.base_score.sum()
