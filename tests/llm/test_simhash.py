import random

import numpy as np
from xxhash import xxh64_intdigest

from tallygrid.llm import simhash as S
from tallygrid.llm.common import components


def brute(text):
    w = text.encode().lower().split()
    if not w:
        return 0
    h = [xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for t in ("", " \n", "One", "one TWO", "a b c", "a b c d", "é É ß " * 50, "x y z " * 30_000):
        assert S.simhash(t) == brute(t)


def balls(seed, n):
    draw, out = random.Random(seed), []
    for _ in range(n):
        c = draw.getrandbits(64)
        for _ in range(draw.choice([1, 1, 1, 3, 40])):
            x = c
            for _ in range(draw.randint(0, 3)):
                x ^= 1 << draw.randrange(64)
            out.append(x)
    return list(dict.fromkeys(out))


def test_tree_finds_all_links(spark):
    fps = balls(2, 250)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, node long").repartition(3)
    found = {r.node: r.root for r in components(S.fingerprint_links(classes, shard=60)).collect()}
    assert [found.get(i, i) for i in range(len(fps))] == roots(fps)


def test_crowded_shards_are_cut_again(spark, monkeypatch):
    """Two shards at first; those of more than 40 members are cut by trees of their own, in several rounds, to the same links."""
    monkeypatch.setattr(S, "MOST_SHARDS", 2)
    monkeypatch.setattr(S, "_AGAIN", 3)
    fps = balls(3, 250) + [1 << i for i in range(64)]  # and a ball that no tree can cut well
    fps = list(dict.fromkeys(fps))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, node long").repartition(3)
    found = {r.node: r.root for r in components(S.fingerprint_links(classes, shard=60, crowd=40)).collect()}
    assert [found.get(i, i) for i in range(len(fps))] == roots(fps)
    dealt = spark.createDataFrame([(0, f, i, True) for i, f in enumerate(signed)], S._DEALT)
    shards = S._cut_crowds(dealt, 40).where("home").groupBy("shard").count().collect()
    assert sum(r["count"] for r in shards) == len(fps) and len(shards) > 9


def test_documents(spark):
    draw = random.Random(5)
    base = [" ".join(draw.choice(["sun", "moon", "sea", "hill", "road"]) + str(draw.randint(0, 99)) for _ in range(200)) for _ in range(12)]
    rows = [(i * 10, t) for i, t in enumerate(base)] + [(500 + i, base[i % 3] + (" end" if i % 2 else "")) for i in range(30)]
    rows += [(700, None), (701, ""), (702, " "), (0, base[0]), (None, base[1]), (None, "quite alone")]
    docs = spark.createDataFrame([(d, t, "q") for d, t in rows], "doc_id long, text string, component_id string")
    got = sorted((r.doc_id is None, r.doc_id or 0, int(r.fingerprint, 16), -1 if r.component_id is None else r.component_id) for r in S.near_duplicates(docs).collect())
    fps = [brute(t or "") for _, t in rows]
    label = roots(fps)
    want = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        want.append((d is None, d or 0, fps[i], min(ids) if ids else -1))
    assert got == sorted(want)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    firsts = sorted({w[3] for w in want if not w[0]})
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == firsts
    assert kept.where("doc_id is null").count() == 2


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(none).collect() == [] and S.keep_one(none).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}
