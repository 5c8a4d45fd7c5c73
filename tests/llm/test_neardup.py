import random

import numpy as np
import pytest

from tallygrid.llm import neardup as N


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Tags of the rows that stay."""
    sets = [grams(t) for _, t, _ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (not a and not b) or 5 * len(a & b) >= 4 * len(a | b) > 0:
                x, y = label[i], label[j]
                label = [min(x, y) if k in (x, y) else k for k in label]
    out = {}
    for (d, _, tag), k in zip(rows, label):
        out.setdefault(k, []).append((d is None, d or 0, tag))
    return {min(v)[2] for v in out.values()}, sets


def corpus(seed, n):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(4000)}"
    common = [word() for _ in range(40)]
    out = []
    for _ in range(n):
        base = [word() for _ in range(draw.randint(1, 250))]
        if draw.random() < 0.3:
            base[len(base) // 2 : 0] = common
        for _ in range(draw.choice([1, 1, 2, 4])):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                copy[draw.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, tag int, node int, _ID int").repartition(3)
    kept = N.keep_distinct(docs)
    assert kept.columns == docs.columns
    return sorted(r.tag for r in kept.collect())


def test_against_brute_force_jaccard(spark, monkeypatch):
    rows = [(i * 3, t, i) for i, t in enumerate(corpus(1, 120))]
    rows += [(2000, "", 2000), (2001, None, 2001), (2002, " \n", 2002), (2003, "one two", 2003), (2004, "One two", 2004)]
    want, sets = brute(rows)
    edge = [
        5 * len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i] if a and b and a != b and a & b
    ]
    assert sum(x >= 4 for x in edge) > 20 and sum(3 < x < 4 for x in edge) > 5
    assert check(spark, rows) == sorted(want)
    # On the driver only: another order of the shingles, the same rows.
    monkeypatch.setattr(N, "FREQUENT", 2)
    assert check(spark, rows) == sorted(want)


@pytest.mark.parametrize("few", [N.FEW_LEFT, 3])
def test_large_groups_against_brute_force(spark, few, monkeypatch):
    """Hundreds of loose copies of two texts: shingles of over 32 members with several labels, so the later rounds count, in both forms."""
    monkeypatch.setattr(N, "FEW_LEFT", few)
    draw, texts = random.Random(12), []
    for _ in range(2):
        base = [f"w{draw.randrange(9000)}" for _ in range(200)]
        for _ in range(110):
            copy = list(base)
            for _ in range(draw.choice((1, 2, 3, 4, 4))):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(copy))
    rows = [(i, t, i) for i, t in enumerate(texts)]
    want, _ = brute(rows)
    assert 4 < len(want) < 150
    assert check(spark, rows) == sorted(want)


def test_last_pairs_against_all_pairs():
    import pyarrow as pa

    draw, sets = np.random.default_rng(2), []
    base = draw.integers(0, 2**63, 120)
    for _ in range(150):
        keep = base[draw.random(120) < draw.uniform(0.8, 1)]
        sets.append(np.unique(np.concatenate([keep, draw.integers(0, 2**63, draw.integers(0, 40))])).astype(np.uint64))
    label = draw.integers(0, 4, 150) * (draw.random(150) < 0.7)
    names = ["sh", "node", "n", "at", "label", "bits"]
    rows = [np.zeros(150, np.int64), np.arange(150), np.array([len(x) for x in sets], np.int32), np.zeros(150, np.int32), label.astype(np.int64)]
    batch = pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array([N.parities(x) for x in sets], pa.binary())], names=names)
    got = [tuple(r) for b in N._last_pairs([batch.slice(0, 70), batch.slice(70)]) for r in zip(*(c.to_pylist() for c in b.columns))]
    fits = lambda a, b: N.least_apart(N.parities(sets[a]), N.parities(sets[b])) * 9 <= len(sets[a]) + len(sets[b])
    size = lambda a, b: min(len(sets[a]), len(sets[b])) * 9 >= 4 * (len(sets[a]) + len(sets[b]))
    want = {(a, b) for a in range(150) for b in range(a + 1, 150) if label[a] != label[b] and fits(a, b) and size(a, b)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    near = [tuple(r) for b in N._last_pairs([batch.slice(0, 70), batch.slice(70)], True) for r in zip(*(c.to_pylist() for c in b.columns))]
    most = max(set(label.tolist()), key=label.tolist().count)
    assert set(near) <= want and {x for p in near for x in p} >= {x for p in want for x in p if label[x] != most} and len(near) <= 150
    assert all((a, b) in want for a in range(150) for b in range(a + 1, 150) if label[a] != label[b] and 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])))


def test_pairs_with_few_against_all_pairs():
    import pyarrow as pa

    draw, rows = np.random.default_rng(4), []
    base, none = draw.integers(0, 2**63, 90), np.zeros(0, np.uint64)
    for i in range(120):
        found = np.unique(np.concatenate([base[draw.random(90) < draw.uniform(0.8, 1)], draw.integers(0, 2**63, draw.integers(0, 25))])).astype(np.uint64)
        rows.append((i * 7 % 120, len(found), N.prefix(found, none, none).view(np.int64).tolist(), N.parities(found), int(draw.integers(0, 3)), found))
    few = [r[:5] for r in rows if r[4]]
    batch = pa.RecordBatch.from_pylist([dict(zip(("node", "n", "prefix", "bits", "label"), r)) for r in rows])
    got = [tuple(p) for b in N._pairs_with(few)([batch.slice(0, 50), batch.slice(50)]) for p in zip(*(c.to_pylist() for c in b.columns))]
    assert len(got) == len(set(got)) and all(u < v for u, v in got)
    label = {r[0]: r[4] for r in rows}
    assert all(label[u] != label[v] for u, v in got)
    near = {(min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(rows) for b in rows[:i] if a[4] != b[4] and 5 * len(np.intersect1d(a[5], b[5])) >= 4 * len(np.union1d(a[5], b[5]))}
    assert len(near) > 100 and near <= set(got)


def test_looser_copies_than_two_bits_go(spark):
    from tallygrid.llm import simhash

    draw = random.Random(8)
    base = [f"w{draw.randrange(4000)}" for _ in range(200)]
    texts = [" ".join(base), " ".join("new" if i % 50 == 20 else w for i, w in enumerate(base))]
    assert len(grams(texts[0]) & grams(texts[1])) >= 0.8 * len(grams(texts[0]) | grams(texts[1]))
    assert bin(simhash.simhash(texts[0]) ^ simhash.simhash(texts[1])).count("1") > simhash.RADIUS
    assert check(spark, [(7, texts[0], 0), (3, texts[1], 1)]) == [1]


def test_rows_without_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    assert check(spark, [(None, a, 0), (5, a, 1), (None, a + " x", 2)]) == [1]
    assert len(check(spark, [(None, b, 0), (None, b, 1), (None, b + " x", 2)])) == 1


def test_a_large_group_makes_few_pairs():
    node = np.arange(1000)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.full(1000, 9)), pa.array(node), pa.array(np.full(1000, 50, np.int32)), pa.array(np.zeros(1000, np.int32))], names=["sh", "node", "n", "at"]
    )
    out = pa.Table.from_batches(list(N._first_pairs([batch.slice(0, 300), batch.slice(300)])))
    assert out.num_rows == 1999 and out.column("v").null_count == 1000


def test_parities_never_say_too_much():
    draw = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(draw.integers(0, 2**63, draw.integers(1, 700)).astype(np.uint64))
        b = np.unique(np.concatenate([a[draw.random(len(a)) < draw.random()], draw.integers(0, 2**63, draw.integers(0, 90)).astype(np.uint64)]))
        apart = N.least_apart(N.parities(a), N.parities(b))
        assert apart == N.least_apart(N.parities(b), N.parities(a)) <= len(np.setxor1d(a, b))


def test_empty(spark):
    assert N.keep_distinct(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_simhash_links_copies_before_any_prefix(spark, monkeypatch):
    """Without pairs by prefixes copies within two bits go all the same, by SimHash; texts that only SimHash links stay."""
    from tallygrid.llm import simhash

    monkeypatch.setattr(N, "_first_pairs", lambda batches: iter(()))
    draw = random.Random(21)
    base = [[f"w{draw.randrange(9000)}" for _ in range(400)] for _ in range(6)]
    texts = [" ".join(b) for b in base] + [" ".join([*b, "end"]) for b in base]
    bits = lambda a, b: bin(simhash.simhash(a) ^ simhash.simhash(b)).count("1")
    close = [bits(texts[i], texts[i + 6]) <= simhash.RADIUS for i in range(6)]
    assert sum(close) >= 2
    # Of one fingerprint by a run that both repeat, and else unlike.
    turn, other = ("a b c " * 300 + " ".join(f"{x}{i}" for i in range(10)) for x in "xy")
    assert bits(turn, other) <= simhash.RADIUS and 5 * len(grams(turn) & grams(other)) < 4 * len(grams(turn) | grams(other))
    rows = [(i, t, i) for i, t in enumerate([*texts, turn, other])]
    assert check(spark, rows) == [0, 1, 2, 3, 4, 5, *(i + 6 for i in range(6) if not close[i]), 12, 13]
    classes = spark.createDataFrame([(1, 5), (2, 5), (3, 7), (4, -1)], "node long, fp long")
    assert sorted((r.u, r.v) for r in N.simhash_pairs(classes).collect()) == [(1, 2), (1, 3)]
