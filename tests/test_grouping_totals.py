"""Totals of cases by level against the roll-up that counts different cases, and its plan."""

import random

from pyspark.sql import functions as F

from tallygrid.operators import crash


def test_totals_equal_the_rollup_without_sets_by_level(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, 1, 2, 3]), draw.choice([None, 1, 2]), draw.choice(["a", "b", None]), draw.choice([None, *range(40)])) for _ in range(600)]
    rows += [(9, 9, "a", None), (None, None, "c", None)]
    frame = spark.createDataFrame(rows, "state long, county long, mode string, case_id long")
    got = crash.grouping_totals(frame, "state", "county", "mode", "case_id")
    want = frame.rollup("mode", "state", "county").agg(F.count_distinct("case_id").alias("cases"), F.grouping_id().alias("level")).where("mode is not null")
    assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
    said = lambda d: sorted(map(repr, d.collect()))
    assert said(got) == said(want)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
