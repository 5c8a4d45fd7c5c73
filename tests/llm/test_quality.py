import statistics as plain_statistics
from math import isclose, log, log1p, sqrt

import numpy as np
import zlib

from tallygrid.llm import quality as Q

GOOD = "The old river went slowly past the town, and nobody saw it go. "
BAD = "BUY!! NOW!! CHEAP!! %%% $$$ | | "


def docs(spark, n=200):
    rows = [(i, (GOOD if i % 3 else BAD) * (1 + i % 7) + str(i), "en", i % 3) for i in range(n)] + [(n, None, None, 0), (n + 1, "", "en", 0), (n + 2, "x" * 200_000, "en", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, label int"), [(i, int(i % 3 > 0), 0) for i in range(n)]


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_learns_and_holds_out(spark):
    d, labels = docs(spark)
    out = Q.score_quality(d, label_table(spark, labels + [(5, None, None), (None, 1, 0), (6, 3, 0)])).collect()
    assert len(out) == 203 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert all(r.held_out == held(r.doc_id) for r in out)
    right = [r.predicted == int(r.doc_id % 3 > 0) for r in out if r.held_out and r.doc_id < 200]
    assert len(right) > 20 and np.mean(right) > 0.95


def test_held_out_labels_change_nothing(spark):
    d, labels = docs(spark)
    flipped = [(i, 1 - q if held(i) else q, t) for i, q, t in labels]
    assert flipped != labels
    scores = lambda x: {r.doc_id: r.score for r in Q.score_quality(d, label_table(spark, x)).collect()}
    a, b, c = scores(labels), scores(flipped), scores([x for x in labels if not held(x[0])])
    assert all(isclose(a[i], b[i], abs_tol=1e-9) and isclose(a[i], c[i], abs_tol=1e-9) for i in a)


def test_repeated_and_contradicting_labels(spark):
    _, labels = docs(spark, 20)
    teach = lambda x, **k: sorted((r.doc_id, r.label) for r in Q.teaching_labels(label_table(spark, x), **k).collect())
    plain = [(i, q) for i, q, _ in labels if not held(i)]
    assert teach(labels) == plain and teach(labels * 3) == plain
    first = plain[0]
    assert teach([*labels, (first[0], 1 - first[1], 0), (None, 1, 0), (21, None, 0), (22, 2, 0)]) == plain[1:]
    many = label_table(spark, [(i, i % 2, 0) for i in range(20_000)])
    n = Q.teaching_labels(many, most=1000).count()
    assert 850 < n < 1150 and Q.teaching_labels(many, most=1000).distinct().count() == n


def test_same_as_the_density_of_a_full_formula():
    rng = np.random.default_rng(0)
    x = {c: rng.normal(c, 1 + c, (300, Q.D)) for c in (0, 1)}
    m = Q.Discriminant.from_sums({c: (300.0, v.sum(0), v.T @ v) for c, v in x.items()}, 0.2, 0.1)
    assert np.allclose(m.score(x[1][:20]), full_formula(x, x[1][:20], 0.2, 0.1))


def full_formula(x, at, shrink, ridge):
    total = sum(map(len, x.values()))
    pooled = sum((len(v) - 1) * np.cov(v.T) for v in x.values()) / (total - 2)
    pooled = (1 - ridge) * pooled + ridge * np.diag(np.diag(pooled)) + 1e-4 * np.eye(Q.D)
    logs = []
    for c in (0, 1):
        weight = max(shrink, Q.D / (Q.D + len(x[c])))
        cov = (1 - weight) * np.cov(x[c].T) + weight * pooled
        d = at - x[c].mean(0)
        logs.append(log(len(x[c]) / total) - 0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1]))
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def slow_statistics(t):
    data = t.encode()
    share = lambda f: sqrt(sum(map(f, data)) / max(1, len(data)))
    words = t.replace("\r", " ").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w.encode() for w in words if w]
    sizes = [len(w) for w in words] or [0]
    lines = [x for x in t.split("\n") if x]
    return [
        log1p(len(t)), log1p(len(words)), log1p(sum(sizes) / len(sizes)), log1p(plain_statistics.pstdev(sizes)),
        share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in b" \t\n\r\v\f"), share(lambda b: b > 127),
        share(lambda b: b in b".,"), share(lambda b: b in b"!?"), share(lambda b: b in b"%&*#$@^+="), share(lambda b: b in b"|\\~_<>{}[]"),
        share(lambda b: b in b"\"'()-/:;`"), log1p(len(set(words))) / log1p(max(1, len(words))),
        sqrt(sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words))), len(set(lines)) / max(1, len(lines)),
        log1p(len(data) / max(1, len(lines))), sqrt(sum(s <= 3 for s in sizes) / len(sizes)),
    ]


TEXTS = [GOOD * 3, BAD * 2, "", "x", "a a a b\n\n\nb b", "Ünïcode ünd Größe, 12 34!", "one\ttwo\r\nthree", "é" * 5000, "\n", "no stop here"]


def test_statistics_against_brute_force():
    for t in TEXTS:
        assert len(Q.statistics(t)) == Q.D == len(slow_statistics(t))
        assert np.allclose(Q.statistics(t), slow_statistics(t)), t


def test_sums_and_whole_query_against_brute_force(spark):
    d, labels = docs(spark, 150)
    d = d.repartition(3)
    known = {i: q for i, q, _ in labels if not held(i)}
    rows = {r.doc_id: slow_statistics(r.text or "") for r in d.collect()}
    stats = Q.document_statistics(d).join(label_table(spark, labels).selectExpr("doc_id", "quality as label"), "doc_id")
    sums = Q.class_sums(stats.selectExpr("x", "label", "cast(doc_id % 2 as int) as fold"))
    for f in (0, 1):
        for c in (0, 1):
            x = np.array([rows[i] for i, q, _ in labels if i % 2 == f and q == c])
            n, s, ss = sums[f][c]
            assert n == len(x) and np.allclose(s, x.sum(0)) and np.allclose(ss, x.T @ x)
    both = Q.together([*sums.values()])
    everything = np.array([rows[i] for i, q, _ in labels if q == 1])
    assert np.allclose(both[1][2], everything.T @ everything)

    # The whole query: folds, choice of the weights and scores, written out with the full formula.
    folds = {r.doc_id: r.fold for r in Q.document_statistics(d).selectExpr("doc_id", f"pmod(xxhash64(x), {Q.FOLDS}) as fold").collect()}
    by_class = lambda ids: {c: np.array([rows[i] for i in ids if known[i] == c]) for c in (0, 1)}
    best = None
    for i, w in enumerate(Q.WEIGHTS):
        loss = 0.0
        for f in range(Q.FOLDS):
            inside = [k for k in known if folds[k] == f]
            if inside:
                p = full_formula(by_class([k for k in known if folds[k] != f]), np.array([rows[k] for k in inside]), *w)
                loss -= sum(log(max(1e-300, p[j] if known[k] else 1 - p[j])) for j, k in enumerate(inside))
        if best is None or loss < best[0] * (1 - 1e-6):
            best = (loss, w)
    want = full_formula(by_class(known), np.array([rows[i] for i in sorted(rows)]), *best[1])
    got = [r.score for r in sorted(Q.score_quality(d, label_table(spark, labels)).collect(), key=lambda r: r.doc_id)]
    assert np.allclose(got, want, atol=1e-6)


def test_stage_keeps_columns_and_agrees(spark):
    d, labels = docs(spark)
    lab = label_table(spark, labels)
    kept = Q.keep_good(d, lab)
    assert kept.columns == d.columns
    good = {r.doc_id for r in Q.score_quality(d, lab).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == good


def test_no_or_one_class_and_empty(spark):
    d, _ = docs(spark, 6)
    none = label_table(spark, [])
    assert {r.score for r in Q.score_quality(d, none).collect()} == {0.5}
    one = label_table(spark, [(i, 1, 0) for i in range(6)])
    assert {r.score for r in Q.score_quality(d, one).collect()} == {1.0}
    assert Q.score_quality(d.where("false"), one).collect() == []
