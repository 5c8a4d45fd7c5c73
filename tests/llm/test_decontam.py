import random
import re
from collections import Counter

import pytest

from tallygrid.llm import decontam as D


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def grams(w, k):
    return [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = words(t)
        for i, b in items:
            x = words(b)
            k, n = min(5, len(x)), min(len(x), len(w))
            if not x or n < k:
                continue
            want = Counter(grams(x, k))
            for s in range(len(w) - n + 1):
                have = Counter(grams(w[s : s + n], k))
                j = sum((have & want).values()) / sum((have | want).values())
                if j >= 0.8 and j > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (j, s)
    return out


@pytest.fixture(scope="module")
def cases():
    draw = random.Random(4)
    say = lambda n: [f"{draw.choice('abcdefgh')}{draw.randint(0, 60)}" for _ in range(n)]
    items = [(i, " ".join(say(draw.randint(12, 60)))) for i in range(25)] + [(90, "tiny item"), (91, ""), (92, None), (93, "one"), (94, "a1 a1 a1 a1 a1 a1 a1 a1 a1")]
    docs = []
    for d in range(120):
        w = say(draw.randint(0, 150))
        if d % 2:
            x = words(items[d % 25][1])
            for _ in range(d % 4):
                x[draw.choice([0, 1, -1, draw.randrange(len(x))])] = "changed"
            if d % 5 == 0:
                x = x[: int(len(x) * 0.9)]
            at = draw.randint(0, len(w))
            w = w[:at] + x + w[at:] if d % 3 else x
        docs.append((d, ", ".join(w).upper() if d % 7 == 0 else " ".join(w)))
    docs += [(200, None), (201, ""), (202, "tiny  ITEM"), (203, "a1 " * 40), (204, items[3][1] + ". " + items[4][1]), (204, items[5][1])]
    return docs, items


@pytest.mark.parametrize("in_plan", [50_000, 3])
def test_against_brute_force(spark, cases, in_plan):
    docs, items = cases
    got = D.contaminated(
        spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, row int"),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, h int"),
        in_plan=in_plan,
    ).collect()
    want = brute(docs, items)
    assert len(want) > 30
    assert {(r.doc_id, r.item_id): (r.similarity, r.start) for r in got} == want


@pytest.mark.parametrize("in_plan", [50_000, 3])
def test_stage(spark, cases, in_plan):
    docs, items = cases
    rows = docs + [(None, "free"), (None, "free"), (None, "so " + items[6][1]), (300, "kept"), (300, "kept")]
    d = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, row int, __doc int, _MARK int")
    kept = D.keep_clean(d, spark.createDataFrame(items, "item_id long, text string"), in_plan=in_plan)
    assert kept.columns == d.columns
    bad = {n for n, (_, t) in enumerate(rows) if brute([(0, t)], items)}
    say = lambda x: sorted((i is not None, i or 0, t or "", t is None) for i, t in x)
    assert say((r.doc_id, r.text) for r in kept.collect()) == say(x for n, x in enumerate(rows) if n not in bad)


def test_very_long_item_and_document(spark):
    draw = random.Random(9)
    item = [f"w{draw.randrange(200)}" for _ in range(400)]
    near = [x if draw.random() > 0.01 else "other" for x in item]
    far = [x if draw.random() > 0.3 else "other" for x in item]
    docs = [(1, " ".join(["before"] * 500 + near + ["after"] * 5_000)), (2, " ".join(far)), (3, "w1 " * 8_000)]
    items = [(7, " ".join(item)), (8, "w1 " * 300)]
    got = {(r.doc_id, r.item_id): (r.similarity, r.start, r.n_words) for r in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = sum((Counter(grams(near, 5)) & Counter(grams(item, 5))).values())
    assert set(got) == {(1, 7), (3, 8)} and got[3, 8] == (1.0, 0, 300)
    assert got[1, 7][0] >= want / (2 * 396 - want) and abs(got[1, 7][1] - 500) < 20


def test_radius_holds_the_similarity(spark):
    """Fingerprints of windows at the least similarity lie within the radius: none of 6,000 is lost."""
    draw = random.Random(5)
    pairs = []
    for i in range(6000):
        m = draw.choice((9, 14, 18, 27, 36, 54, 90))
        item = [draw.getrandbits(63) for _ in range(m)]
        window = list(item)
        # The most shingles that can differ at 0.8.
        for j in draw.sample(range(m), m - -(-8 * m // 9)):
            window[j] = draw.getrandbits(63)
        pairs.append((i, item, window))
    frame = spark.createDataFrame(pairs, "i int, a array<long>, b array<long>")
    far = frame.select(D.F.bit_count(D.fingerprint(D.F.col("a")).bitwiseXOR(D.fingerprint(D.F.col("b")))).alias("d"))
    told = [r.d for r in far.collect()]
    assert max(told) <= D.RADIUS and 6 < sum(told) / len(told) < 12


def test_empty(spark, cases):
    docs, items = cases
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert D.contaminated(d.where("false"), b).collect() == [] and D.contaminated(d, b.where("false")).collect() == []


def test_native_plan(spark, cases):
    docs, items = cases
    plan = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    said = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in said for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
