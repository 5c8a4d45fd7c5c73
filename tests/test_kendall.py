"""Concordance by blocks of blocks against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.operators import ranks


def test_weighted_inversions():
    draw = np.random.default_rng(5)
    for n in (0, 1, 2, 63, 64, 65, 300):
        v, w = draw.integers(0, 40, n), draw.integers(1, 9, n)
        want = sum(int(w[i] * w[j]) for i in range(n) for j in range(i + 1, n) if v[i] > v[j])
        assert ranks.inversions(v, w) == want
        assert ranks.inversions(v) == sum(1 for i in range(n) for j in range(i + 1, n) if v[i] > v[j])


@pytest.mark.parametrize("block", [1, 7])
def test_no_grid_of_all_blocks(spark, monkeypatch, block):
    draw = random.Random(block)
    rows = [(f"s{i:03d}", float(draw.randrange(60)), float(draw.randrange(60))) for i in range(240)]
    frame = spark.createDataFrame(rows, "segment_id string, x double, y double").repartition(3)
    a, b = frame.select("segment_id", F.col("x").alias("rate")), frame.select("segment_id", F.col("y").alias("rate"))
    pa = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    pb = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    same = sum((pa[x[0]] < pa[y[0]]) == (pb[x[0]] < pb[y[0]]) for i, x in enumerate(rows) for y in rows[i + 1 :])
    monkeypatch.setattr(ranks, "FACTOR", 4)
    monkeypatch.setattr(ranks, "GRID", 5)
    asked = []
    real = type(spark).range
    monkeypatch.setattr(type(spark), "range", lambda self, *n: asked.append(n[0]) or real(self, *n))
    assert ranks.kendall_concordance(a, b, block).first() == (240 * 239 // 2, same)
    # The grid has no more than the few blocks of the last level.
    assert asked and max(asked) <= 25
