from collections import Counter

import numpy as np

from tallygrid.llm import langid as L

TEXTS = {"en": "the river ran past the old town and the people went home", "de": "der fluss lief an der alten stadt vorbei und die leute gingen heim", "fr": "la rivière passait devant la vieille ville et les gens rentraient"}


def test_grams_against_a_plain_count():
    text = "Ab, ab çA"
    codes, counts = L.grams(text)
    want = Counter()
    for w in ("ab", "ab", "ça"):
        p = [0, *map(ord, w), 0]
        want.update((x * 4 + 1) for x in p if x)
        want.update((a * L._BASE + b) * 4 + 2 for a, b in zip(p, p[1:]))
        want.update(((a * L._BASE + b) * L._BASE + c) * 4 + 3 for a, b, c in zip(p, p[1:], p[2:]))
    assert dict(zip(codes.tolist(), counts.tolist())) == dict(want)


def test_distance():
    known = (np.array([2, 5, 9]), np.array([1, 0, 2]))
    assert L.out_of_place(np.array([5, 9, 7]), known, 10) == 0 + 1 + 10
    assert L.ranked(np.array([3, 1, 2]), np.array([5, 5, 9]), 2).tolist() == [2, 1]


def test_predicts_held_out(spark):
    rows = [(i, TEXTS[k] + f" {i}", k) for i in range(90) for k in [("en", "de", "fr")[i % 3]]]
    rows += [(900, None, "en"), (901, "12 34 !!", "de"), (902, "", None), (None, TEXTS["de"], "de"), (1, TEXTS["en"] * 2000, None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = L.predict_languages(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == ("en", "de", "fr")[i % 3] for i in range(2, 90))
    assert any(r.held_out for r in got)
    assert [by[i].lang_pred for i in (900, 901, 902, None)] == ["und", "und", "und", "de"]
    assert L.predict_languages(docs.where("false")).collect() == []


def test_counts_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([("en", TEXTS["en"])] * 30 + [("de", TEXTS["de"])] * 9, "lang string, text string")
    one, many = (sorted(map(tuple, L.gram_counts(docs.repartition(n)).collect())) for n in (1, 7))
    assert one == many


def test_whole_query_against_brute_force(spark):
    import random
    import zlib
    from collections import Counter

    draw, rows = random.Random(2), []
    pools = {"aa": [f"{a}o{b}" for a in "bcdfg" for b in "aeiou"], "bb": [f"{a}é{b}ß" for a in "klmn" for b in "xyz"], "cc": ["the", "of", "and", "köö"]}
    for i in range(150):
        lang = draw.choice(sorted(pools))
        rows.append((i, " ".join(draw.choice(pools[lang]).title() for _ in range(draw.randint(0, 40))), lang if i % 11 else None))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "123 !!", "cc"), (None, "boba bobe", "aa"), (203, "Kéxß, kéxß", None), (203, "the of", None)]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, score string").repartition(3)
    out = L.predict_languages(frame, 20).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    count = lambda t: Counter(dict(zip(*(x.tolist() for x in L.grams(t)))))
    rank = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:20]]
    learned = {}
    for d, t, lang in rows:
        if d is not None and t is not None and lang is not None and not held(d):
            learned.setdefault(lang, Counter()).update(count(t))
    profiles = {lang: rank(c) for lang, c in learned.items()}
    want = []
    for d, t, _ in rows:
        mine = rank(count(t)) if t else []
        if not mine:
            want.append((str(d), held(d), "und", 0.0))
            continue
        far = sorted((sum(abs(i - p.index(g)) if g in p else 20 for i, g in enumerate(mine)), lang) for lang, p in profiles.items())
        total = far[0][0] + far[1][0]
        want.append((str(d), held(d), far[0][1], far[1][0] / total if total else 0.5))
    assert sorted((str(r.doc_id), r.held_out, r.lang_pred, r.score) for r in out) == sorted(want)
    assert len({w[2] for w in want}) == 4
