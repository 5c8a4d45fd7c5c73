"""Density surfaces, time and weather breakdowns, noisy releases."""

from __future__ import annotations

import hashlib
import hmac
import math
import secrets

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import numerics as N
from ..functions import text as X
from .spatial import bounded_broadcast


def kde_surface(points: DataFrame, plane: geo.Plane, bandwidth: float = 150.0, grid: int = 24) -> DataFrame:
    """(pos, row, col, lat, lon, intensity): Gaussian kernels summed at grid x grid cell centres.

    The grid spans the box of all points; kernels end at 4 bandwidths. Points are spread to the
    grid cells in reach by arithmetic, not by a join, and summed before the shuffle.
    """
    box = points.agg(*(f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for n, f in (("lo", F.min), ("hi", F.max)))).where("lo_lat is not null")
    spaced = box.select(
        "*", ((F.col("hi_lat") - F.col("lo_lat")) / grid).alias("dlat"), ((F.col("hi_lon") - F.col("lo_lon")) / grid).alias("dlon")
    )
    cells = (
        spaced.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .select(
            (F.col("row") * grid + F.col("col")).alias("pos"), "row", "col",
            (F.col("lo_lat") + (F.col("row") + 0.5) * F.col("dlat")).alias("lat"),
            (F.col("lo_lon") + (F.col("col") + 0.5) * F.col("dlon")).alias("lon"),
        )
    )
    reach = 4 * bandwidth
    placed = points.select("lat", "lon").crossJoin(F.broadcast(spaced))

    def span(x, low, step, per):
        """First and last cell index whose centre can lie in reach."""
        cells_in = F.when(step > 0, F.lit(reach) / (step * per)).otherwise(F.lit(float(grid)))
        at = F.when(step > 0, (x - low) / step).otherwise(F.lit(0.0)) - 0.5
        return (
            F.greatest(F.lit(0), F.ceil(at - cells_in).cast("int")),
            F.least(F.lit(grid - 1), F.floor(at + cells_in).cast("int")),
        )

    r0, r1 = span(F.col("lat"), F.col("lo_lat"), F.col("dlat"), geo.METRES_PER_LAT)
    c0, c1 = span(F.col("lon"), F.col("lo_lon"), F.col("dlon"), plane.per_lon)
    some = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    spread = (
        placed.withColumns({"rows": some(r0, r1), "cols": some(c0, c1)})
        .withColumn("row", F.explode("rows"))
        .withColumn("col", F.explode("cols"))
    )
    dx = (F.col("lon") - (F.col("lo_lon") + (F.col("col") + 0.5) * F.col("dlon"))) * plane.per_lon
    dy = (F.col("lat") - (F.col("lo_lat") + (F.col("row") + 0.5) * F.col("dlat"))) * geo.METRES_PER_LAT
    d2 = dx * dx + dy * dy
    sums = (
        spread.select((F.col("row") * grid + F.col("col")).alias("pos"), d2.alias("d2"))
        .where(F.col("d2") <= reach * reach)
        .groupBy("pos")
        .agg(F.sum(F.exp(-0.5 * F.col("d2") / (bandwidth * bandwidth))).alias("intensity"))
    )
    return cells.join(sums, "pos", "left").withColumn("intensity", F.coalesce("intensity", F.lit(0.0)))


def kde_binned(points: DataFrame, plane: geo.Plane, bandwidth: float = 150.0, grid: int = 24, per_bandwidth: int = 8) -> DataFrame:
    """(pos, row, col, lat, lon, intensity, bound): the surface of `kde_surface` from counts of reports in fine bins.

    An odd number of bins cuts each cell on each axis, so that none is wider than the bandwidth over `per_bandwidth`. The kernel is a
    product, so it is summed along one axis and then along the other: first each row of bins into the columns in reach, then
    those into the rows in reach. What is shuffled grows with the bins in use, whatever the reports are. No intensity is
    further from that of `kde_surface` than its bound: a report moves by half a bin's diagonal at the most, over which the kernel
    changes by less than that over the bandwidth times e^-0.5, and what one form counts beyond its reach is under e^-8.
    One row of numbers, the box, comes to the driver. No point: no row.
    """
    box = points.agg(*(f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for n, f in (("lo", F.min), ("hi", F.max)))).first()
    spark = points.sparkSession
    schema = "pos int, row int, col int, lat double, lon double, intensity double, bound double"
    if box.lo_lat is None:
        return spark.createDataFrame([], schema)
    axes = {}
    for c, per in (("lat", geo.METRES_PER_LAT), ("lon", plane.per_lon)):
        low, step = box[f"lo_{c}"], (box[f"hi_{c}"] - box[f"lo_{c}"]) / grid
        cut = max(1, math.ceil(step * per / (bandwidth / per_bandwidth)))
        cut += cut % 2 == 0
        axes[c] = (low, step, per, cut, step / cut)
    reach = 4 * bandwidth
    half = math.hypot(*(a[4] * a[2] / 2 for a in axes.values()))

    def bin_of(c: str) -> Column:
        low, step, _, cut, fine = axes[c]
        at = F.floor((F.col(c) - low) / fine) if step > 0 else F.lit(0).cast("long")
        return F.least(F.lit(grid * cut - 1), at).cast("int")

    def spread(rows: DataFrame, c: str, at: str, into: str) -> DataFrame:
        """Rows with a bin to the cells in reach on one axis, `k` the kernel's factor."""
        _, step, per, cut, fine = axes[c]
        wide = reach + fine * per / 2
        centre = (F.col(at) + 0.5) * fine
        if step > 0:
            first = F.greatest(F.lit(0), F.ceil((centre - wide / per) / step - 0.5).cast("int"))
            last = F.least(F.lit(grid - 1), F.floor((centre + wide / per) / step - 0.5).cast("int"))
        else:
            first, last = F.lit(0), F.lit(grid - 1)
        cells = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        d = (centre - (F.col(into) + 0.5) * step) * per
        return rows.withColumn(into, F.explode(cells)).withColumn("k", F.exp(-0.5 * d * d / (bandwidth * bandwidth)))

    bins = points.where("lat is not null and lon is not null").groupBy(bin_of("lat").alias("by"), bin_of("lon").alias("bx")).agg(F.count("*").alias("n"))
    along = spread(bins, "lon", "bx", "col").groupBy("by", "col").agg(F.sum(F.col("n") * F.col("k")).alias("s"), F.sum("n").alias("n"))
    sums = spread(along, "lat", "by", "row").groupBy("row", "col").agg(F.sum(F.col("s") * F.col("k")).alias("intensity"), F.sum("n").alias("n"))
    worst = math.exp(-0.5) * half / bandwidth + math.exp(-8)
    cells = spark.range(grid * grid).select(F.col("id").cast("int").alias("pos"), F.floor(F.col("id") / grid).cast("int").alias("row"), (F.col("id") % grid).cast("int").alias("col"))
    centre = lambda c, i: (axes[c][0] + (F.col(i) + 0.5) * axes[c][1]).alias(c)
    return cells.join(sums, ["row", "col"], "left").select(
        "pos", "row", "col", centre("lat", "row"), centre("lon", "col"), F.coalesce("intensity", F.lit(0.0)).alias("intensity"), (F.coalesce("n", F.lit(0)) * worst).alias("bound")
    )


def kde_peak(surface: DataFrame) -> DataFrame:
    """The one row of greatest intensity, the first in row-major order of equals."""
    return surface.orderBy(F.desc("intensity"), "pos").limit(1)


def peak_segment(peak: DataFrame, centroids: DataFrame) -> DataFrame:
    """(segment_id, d): the centroid nearest to the peak."""
    far = centroids.crossJoin(F.broadcast(peak.select(F.col("lat").alias("__lat"), F.col("lon").alias("__lon")))).withColumn(
        "d", geo.haversine(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon"))
    )
    return far.orderBy("d", "segment_id").limit(1).select("segment_id", "d")


def temporal_counts(records: DataFrame, by: str) -> DataFrame:
    """(key, n) of readable local times by 'hour', 'weekday' or 'part'."""
    hour = X.local_hour(F.col("occurred_at"))
    key = {
        "hour": hour.cast("string"),
        "weekday": X.weekday_name(X.local_date(F.col("occurred_at"))),
        "part": X.part_of_day(hour),
    }[by]
    return records.where(X.epoch(F.col("occurred_at")).isNotNull()).groupBy(key.alias("key")).agg(F.count("*").alias("n"))


def temporal_breakdown(records: DataFrame, by: str, k: int = 3) -> DataFrame:
    """The counts, or no row if fewer than `k` records have a time."""
    counts = temporal_counts(records, by)
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col("total") >= k).select("key", "n", (F.col("n") / F.col("total")).alias("share"))


def first_seen_peak(records: DataFrame, key: str, small_n: int = 5) -> DataFrame:
    """(key, n): the most frequent key, of equals the one seen first in order of (epoch, report_id)."""
    seen = records.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.count("*").alias("n"), F.min(F.struct("epoch", "report_id")).alias("first")
    )
    total = seen.agg(F.sum("n").alias("total"))
    return seen.crossJoin(F.broadcast(total)).where(F.col("total") >= small_n).orderBy(F.desc("n"), "first").limit(1).select("key", "n")


def is_wet(wet, precip_mm):
    """An explicit flag, else rain above zero; nothing known is dry."""
    return F.coalesce(wet, precip_mm > 0, F.lit(False))


def weather_by_condition(records: DataFrame, weather: DataFrame) -> DataFrame:
    """(condition, n, baseline_wet_share): records of matched days by condition, beside the wet share of all days."""
    days = bounded_broadcast(weather.select("date", "condition"))
    dated = records.select(X.local_date(F.col("occurred_at")).alias("date")).groupBy("date").agg(F.count("*").alias("n"))
    base = weather.agg(F.avg(is_wet(F.col("wet"), F.col("precip_mm")).cast("double")).alias("baseline_wet_share"))
    return dated.join(days, "date").groupBy("condition").agg(F.sum("n").alias("n")).crossJoin(F.broadcast(base))


def weather_join(records: DataFrame, weather: DataFrame) -> DataFrame:
    """One row: records matched to a day of weather and not, wet and dry ones, wet share of the matched."""
    days = bounded_broadcast(weather.select("date", is_wet(F.col("wet"), F.col("precip_mm")).alias("is_wet")))
    dated = records.select(X.local_date(F.col("occurred_at")).alias("date")).groupBy("date").agg(F.count("*").alias("n"))
    sums = dated.join(days, "date", "left").agg(
        *(
            F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(a)
            for a, c in (
                ("matched", F.col("is_wet").isNotNull()), ("unmatched", F.col("is_wet").isNull()),
                ("wet", F.col("is_wet")), ("dry", ~F.col("is_wet")),
            )
        )
    )
    return sums.withColumn("wet_share", F.when(F.col("matched") > 0, F.col("wet") / F.col("matched")))


def dp_true_counts(records: DataFrame) -> DataFrame:
    """(segment_id, part, true_count) of snapped records with a readable time."""
    hour = X.local_hour(F.col("occurred_at"))
    return (
        records.where(F.col("segment_id").isNotNull() & hour.isNotNull())
        .groupBy("segment_id", X.part_of_day(hour).alias("part"))
        .agg(F.count("*").alias("true_count"))
    )


def _noise(secret: bytes, epsilon: float):
    """Laplace noise of a cell, from an HMAC of its name. The secret travels in the function, not in the plan."""

    @F.pandas_udf("double")
    def uniform(segment: pd.Series, part: pd.Series) -> pd.Series:
        def draw(s, p):
            digest = hmac.new(secret, f"{s}\x1f{p}".encode(), hashlib.sha256).digest()
            return ((int.from_bytes(digest[:7], "big") >> 4) + 0.5) / 2.0**52 - 0.5

        return pd.Series([draw(s, p) for s, p in zip(segment, part)], dtype="float64")

    return N.laplace_noise(uniform(F.col("segment_id").cast("string"), F.col("part")), 1.0 / epsilon)


def _secret(secret: bytes | None, epsilon: float) -> bytes:
    if not epsilon > 0:
        raise ValueError("epsilon must be above 0")
    if secret is not None and len(secret) < 16:
        raise ValueError("a secret has 128 bits at least")
    return secret if secret is not None else secrets.token_bytes(32)


def dp_release(true_counts: DataFrame, epsilon: float, enabled: bool, signed_off: bool, secret: bytes | None = None) -> DataFrame:
    """(segment_id, part, published): counts with Laplace noise, rounded and not below zero.

    Disabled gives no row; enabled without sign-off raises, and so does an epsilon that is not
    above 0. One record touches one cell, so the scale is 1 / epsilon. Noise follows from a
    secret of 128 bits or more and the cell, so that a task that runs again draws the same and
    nobody without the secret can take it off; without a secret a fresh one is drawn, which
    is not kept. The true counts are not passed on.
    """
    if not enabled:
        return true_counts.where("false").select("segment_id", "part", F.lit(0).cast("long").alias("published"))
    if not signed_off:
        raise PermissionError("a noisy release needs sign-off")
    noisy = F.col("true_count") + _noise(_secret(secret, epsilon), epsilon)
    return true_counts.select("segment_id", "part", F.greatest(F.lit(0), F.round(noisy)).cast("long").alias("published"))


def dp_accounting(true_counts: DataFrame, epsilon: float, secret: bytes | None = None) -> DataFrame:
    """One row on a release: cells, noise_scale, composed_epsilon, mean_absolute_noise, theater.

    `theater` says that the noise is on average as large as the counts, or as 1, so that little can be read from them.
    """
    rows = true_counts.select("true_count", F.abs(_noise(_secret(secret, epsilon), epsilon)).alias("far"))
    sums = rows.agg(F.count("*").alias("cells"), F.coalesce(F.avg("far"), F.lit(0.0)).alias("noise"), F.coalesce(F.avg("true_count"), F.lit(0.0)).alias("mean"))
    return sums.select(
        "cells", F.lit(1.0 / epsilon).alias("noise_scale"), (F.col("cells") * epsilon).alias("composed_epsilon"),
        N.floor_round(F.col("noise"), 4).alias("mean_absolute_noise"), ((F.col("cells") > 0) & (F.col("noise") >= F.greatest("mean", F.lit(1.0)))).alias("theater"),
    )
