import functools
import hashlib
import random

import numpy as np

from tallygrid.llm.sketch import Sketch, compare_edits, edited, fingerprints
from tallygrid.llm.common import shingle_hashes, word_hashes


def words(seed, n):
    draw = random.Random(seed)
    return " ".join(str(draw.randint(0, 10**9)) for _ in range(n))


def exact(a, b):
    x, y = (set(shingle_hashes(word_hashes(t), 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def test_estimates():
    common, a, b = words(1, 2000), words(2, 1000), words(3, 500)
    s, t = Sketch.of(common + " " + a, 512), Sketch.of(common + " " + b, 512)
    assert abs(s.resemblance(t) - exact(common + " " + a, common + " " + b)) < 0.08
    assert abs(t.containment(s) - 0.8) < 0.1
    assert abs(s.distinct() / 2996 - 1) < 0.15
    m = Sketch.of(a, 512).merge(Sketch.of(b, 512))
    assert set(m.hashes.tolist()) <= set(Sketch.of(a, 512).hashes.tolist()) | set(Sketch.of(b, 512).hashes.tolist())


def test_merged_parts_are_the_sketch_of_the_union():
    for n, k in ((3, 64), (40, 64), (900, 64), (900, 512)):
        parts = [words(100 * n + i, n) for i in range(5)]
        every = np.unique(np.concatenate([shingle_hashes(word_hashes(p), 5) for p in parts]))
        merged = functools.reduce(Sketch.merge, (Sketch.of(p, k) for p in parts))
        assert merged.hashes.tolist() == np.sort(every)[:k].tolist()
        if len(every) < k:
            assert merged.distinct() == len(every)


def test_small_sets_are_exact_and_round_trip():
    a, b = "one two three four five six seven", "ONE two  three\nfour five six eight"
    assert Sketch.of(a).resemblance(Sketch.of(b)) == exact(a, b) == 0.5
    assert Sketch.of("a a a a a a a a").distinct() == 1
    assert Sketch.of("x").resemblance(Sketch.of("X")) == 1 and Sketch.of("").resemblance(Sketch.of("x")) == 0
    for text in ("", "x", words(4, 5000), "r r r r r r " * 3000 + words(9, 300)):
        assert Sketch.load(Sketch.of(text).dump()).dump() == Sketch.of(text).dump()


def test_edits_against_brute_force(spark):
    rows = [(i * 3, words(i, i % 40)) for i in range(120)] + [(50, None), (51, ""), (52, "é" * 30_000), (None, "null id"), (9, "again"), (9, "again")]
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, at int").repartition(3)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in compare_edits(frame).collect())
    order = sorted(((d is not None, d or 0, t or "") for d, t in rows))
    want = []
    for i, (known, d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][2]
        e = edited(t, after)
        want.append((known, d, len(t), hashlib.sha256(e.encode()).hexdigest(), Sketch.of(t).resemblance(Sketch.of(e)), Sketch.of(t).resemblance(Sketch.of(after))))
    assert got == sorted(want)


def test_many_ranges_give_the_same(spark):
    rows = [(None if i % 3 == 0 else i % 50, words(i, i % 30) if i % 7 else "same text") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    say = lambda f: sorted(str(tuple(r)) for r in f.collect())
    assert say(compare_edits(frame, rows_per_range=7)) == say(compare_edits(frame, rows_per_range=1000))


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    r = compare_edits(one).first()
    assert r.near_next == 1 and r.fingerprint == fingerprints(one).first().fingerprint
    assert compare_edits(one.where("false")).collect() == []
