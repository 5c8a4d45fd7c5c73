"""Ranking, top-k and rank statistics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numerics as N
from .shared import kept


def top_by(rows: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    """The k rows of greatest value, ties by `tie`, with their place from 1; rows without value left out."""
    best = rows.where(F.col(value).isNotNull()).orderBy(F.desc(value), tie).limit(k)
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc(value), tie)))


def rank_by_rate(rated: DataFrame, k: int, tie: str = "pos") -> DataFrame:
    """Publishable, rated segments by falling rate; ties keep the order of `tie`, the input position."""
    return top_by(rated.where("publishable"), "rate", tie, k)


def fractional_ranks(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Adds the average rank of each value, ascending; equal values share it. Ranks are summed over ranges."""
    from .hotspot import cumulative

    counts = cumulative(rows.groupBy(value).agg(F.count("*").alias("__c")), value, "__c")
    ranks = counts.select(F.col(value).alias("__v"), (F.col("upto") - (F.col("__c") - 1) / 2).alias(out))
    return rows.join(ranks, rows[value] == F.col("__v")).drop("__v")


def spearman(rows: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, rho): Pearson correlation of average ranks; null with under two rows or no spread."""
    known = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    ranked = fractional_ranks(fractional_ranks(known, x, "rx"), y, "ry")
    sums = ranked.agg(F.count("*").alias("n"), F.covar_pop("rx", "ry").alias("c"), F.var_pop("rx").alias("vx"), F.var_pop("ry").alias("vy"))
    return sums.select("n", F.when((F.col("n") >= 2) & (F.col("vx") > 0) & (F.col("vy") > 0), F.col("c") / F.sqrt(F.col("vx") * F.col("vy"))).alias("rho"))


def shared_top(base: DataFrame, other: DataFrame, k: int = 5) -> DataFrame:
    """One row: how many ids of the base's top k (segment_id, rate) are in the other's."""
    a, b = top_by(base, "rate", "segment_id", k), top_by(other, "rate", "segment_id", k)
    return a.join(b.select("segment_id"), "segment_id", "left_semi").agg(F.count("*").alias("shared"))


def topk_overlap(base: DataFrame, other: DataFrame, k: int = 5) -> DataFrame:
    """One row: Jaccard index of both top-k id sets; 0 if both are empty."""
    ids = lambda d: top_by(d, "rate", "segment_id", k).agg(F.collect_set("segment_id").alias("s"))
    both = ids(base).crossJoin(ids(other).withColumnRenamed("s", "t"))
    union = F.size(F.array_union("s", "t"))
    return both.select(F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect("s", "t")) / union).alias("overlap"))


def numbered(rows: DataFrame, order: list, out: str) -> DataFrame:
    """Adds a number from 0 in the given order, without one task for all rows.

    Rows are sorted by ranges into partitions and kept so; a partition's rows are numbered in
    their order, after the count of the partitions before it.
    """
    low = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = kept(rows.orderBy(*order).withColumn("__place", F.monotonically_increasing_id()))
    part = F.shiftright("__place", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("c"))
    before = counts.select("__part", (F.sum("c").over(Window.orderBy("__part")) - F.col("c")).alias("__before"))
    return placed.withColumn("__part", part).join(F.broadcast(before), "__part").withColumn(out, F.col("__before") + low).drop("__place", "__part", "__before")


def inversions(values, weights=None) -> int:
    """Pairs of an array in which the greater comes first, by merging sorted halves; with weights each pair counts their product."""
    import numpy as np

    n = len(values)
    if n < 2:
        return 0
    weights = np.ones(n, np.int64) if weights is None else weights
    if n <= 64:
        greater = np.triu(values[:, None] > values[None, :], 1)
        return int((weights @ greater) @ weights)
    half = n // 2
    left, right = values[:half], values[half:]
    order = np.argsort(left, kind="stable")
    upto = np.concatenate([[0], np.cumsum(weights[:half][order])])
    across = (upto[-1] - upto[np.searchsorted(left[order], right, side="right")]) @ weights[half:]
    return inversions(left, weights[:half]) + inversions(right, weights[half:]) + int(across)


#: Rows of a block in which inversions are counted at once, blocks of a block of the next level, and blocks of a side whose pairs are counted by a grid.
BLOCK, FACTOR, GRID = 50_000, 64, 512


def kendall_concordance(base: DataFrame, other: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row (comparable, concordant): pairs of the ids that both rankings have, and those in the same order.

    Rows are segment_id and rate, ranked by falling rate, then id; those without a rate do not
    count, nor those that a column `publishable` says are not. Discordant pairs are inversions
    of one ranking against the other. They are counted by blocks of consecutive places in both:
    within one block by merging, between different blocks from the counts of the pairs of blocks that
    occur, which are put in blocks in the same way until a side has few.
    """
    fit = lambda d: d.where(F.col("rate").isNotNull() & (F.col("publishable") if "publishable" in d.columns else F.lit(True)))
    both = fit(base).select("segment_id", F.col("rate").alias("ra")).join(fit(other).select("segment_id", F.col("rate").alias("rb")), "segment_id")
    placed = numbered(numbered(both, [F.desc("ra"), "segment_id"], "pa"), [F.desc("rb"), "segment_id"], "pb")
    n = placed.count()
    found, points, side, step = None, placed.select("pa", "pb", F.lit(1).cast("long").alias("c")), n, block
    while found is None or side > GRID:
        points = kept(points.select("*", F.floor(F.col("pa") / step).alias("a"), F.floor(F.col("pb") / step).alias("b")))
        # Pairs of one block of the first ranking; of one of the second but not of the first.
        part = _within(points, "a", None).unionByName(_within(points, "b", "a"))
        found = part if found is None else found.unionByName(part)
        points = points.groupBy(F.col("a").alias("pa"), F.col("b").alias("pb")).agg(F.sum("c").alias("c"))
        side, step = -(-side // step), FACTOR
    if side > 1:
        grid = placed.sparkSession.range(side * side).select(F.floor(F.col("id") / side).alias("a"), (F.col("id") % side).alias("b"))
        cells = grid.join(points.toDF("a", "b", "c"), ["a", "b"], "left").select("a", "b", F.coalesce("c", F.lit(0)).alias("c"))
        above = Window.partitionBy("b").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
        beyond = Window.partitionBy("a").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
        summed = cells.withColumn("s", F.coalesce(F.sum("c").over(above), F.lit(0)))
        crossed = summed.withColumn("t", F.coalesce(F.sum("s").over(beyond), F.lit(0)))
        found = found.unionByName(crossed.agg(F.sum(F.col("c") * F.col("t")).alias("n")))
    pairs = n * (n - 1) // 2
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad")).select(F.lit(pairs).cast("long").alias("comparable"), (F.lit(pairs) - F.col("bad")).cast("long").alias("concordant"))


def _within(points: DataFrame, by: str, but: str | None) -> DataFrame:
    """Inversions of points (pa, pb, c) of one block, less those of one block of `but` as well; points of one pa or one pb have none."""
    import numpy as np

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        pa, pb, c = (rows[x].to_numpy() for x in ("pa", "pb", "c"))
        order = np.lexsort((pb, pa))
        n = inversions(pb[order], c[order])
        if but is not None:
            block = np.unique(rows[but].to_numpy(), return_inverse=True)[1].astype(np.int64)
            place = np.unique(pb, return_inverse=True)[1].astype(np.int64)
            # Each block is lifted above the one before, so that only pairs of one block are turned.
            order = np.lexsort((pb, pa, block))
            n -= inversions((place + block * (len(rows) + 1))[order], c[order])
        return pd.DataFrame({"n": [n]})

    return points.groupBy(by).applyInPandas(count, "n long")


def median_reference(rated: DataFrame) -> DataFrame:
    """(segment_id, rate) nearest to the median rate of published segments, the least id of equals."""
    fit = rated.where("publishable and rate is not null")
    mid = fit.agg(F.median("rate").alias("m"))
    return fit.crossJoin(F.broadcast(mid)).withColumn("far", F.abs(F.col("rate") - F.col("m"))).orderBy("far", "segment_id").limit(1).select("segment_id", "rate")


def reports_to_distinguish(rated: DataFrame, reference_high: float, per: float = 1000.0, z: float = N.Z_CITY, most: int = 500) -> DataFrame:
    """(segment_id, needed): the least count whose lower bound is above the reference's upper; null beyond `most`."""
    tries = F.sequence(F.lit(0), F.lit(most))
    enough = F.filter(tries, lambda n: N.rate_low(n, F.col("estimate"), per, z) > reference_high)
    return rated.where("estimate > 0").select("segment_id", F.array_min(enough).alias("needed"))


def dominant_type(typed: DataFrame) -> DataFrame:
    """(segment_id, hazard_type, n): the most frequent type of each segment, the first by name of equals."""
    most = typed.groupBy("segment_id").agg(F.max("n").alias("most"))
    return typed.join(most, "segment_id").where("n = most").groupBy("segment_id").agg(
        F.min("hazard_type").alias("hazard_type"), F.max("n").alias("n")
    )


def rate_classes(rated: DataFrame, classes: int = 5) -> DataFrame:
    """(segment_id, rate, class): class by quantile breaks at rounded positions, breaks all different."""
    from .hotspot import cumulative

    rates = rated.where("rate is not null")
    counts = cumulative(rates.groupBy("rate").agg(F.count("*").alias("c")), "rate", "c")
    total = counts.agg(F.sum("c").alias("total"))
    places = total.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(classes - 1)), lambda i: F.floor(i * (F.col("total") - 1) / classes + 0.5))).alias("at"))
    # The value at a place from 0 in ascending order; a handful of places, so a handful of breaks.
    found = counts.join(F.broadcast(places), (F.col("upto") > F.col("at")) & (F.col("upto") - F.col("c") <= F.col("at")))
    breaks = found.agg(F.collect_set("rate").alias("breaks"))
    return rates.crossJoin(F.broadcast(breaks)).select(
        "segment_id", "rate", F.size(F.filter("breaks", lambda b: b < F.col("rate"))).alias("class")
    )
