from pyspark.sql import functions as F

from tallygrid.operators import dedupe


def greedy(pairs):
    gone = set()
    for b in sorted({p[1] for p in pairs}):
        if any(a not in gone for a, x, *_ in pairs if x == b):
            gone.add(b)
    return gone


def test_chains_longer_than_the_rounds_settle(spark):
    # A report a minute at two spots, duplicates up to ten minutes apart: one survivor of each spot a round.
    pairs = [(s + i, s + j, 60 * i, 60 * j) for s in (0, 1000) for i in range(60) for j in range(i + 1, min(60, i + 11))]
    frame = spark.createDataFrame(pairs, "a long, b long, a_epoch long, b_epoch long").repartition(2)
    for rounds, few in ((2, 1), (3, 900), (0, 1)):
        got = [r.report_id for r in dedupe.removed_reports(frame, rounds, few).collect()]
        assert sorted(got) == sorted(greedy(pairs)), (rounds, few)


def test_short_edges_need_more_than_a_hundred_rounds(spark):
    from tallygrid.operators import network

    n = 130
    segments = spark.range(n).select(F.format_string("s%03d", "id").alias("segment_id"))
    step = spark.range(n - 1).select(F.format_string("s%03d", "id").alias("u"), F.format_string("s%03d", F.col("id") + 1).alias("v"), F.lit(1.0).alias("w"))
    both = step.unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v"), "w"))
    near = network.network_neighbors(segments.where("segment_id = 's000'"), both, 120.0)
    assert near.agg(F.count("*"), F.max("d")).first() == (121, 120.0)
