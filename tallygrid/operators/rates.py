"""Counts, exposure and exposure-normalised rates of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numerics as N

DAY_S = 86_400


def segment_aggregate(clean: DataFrame) -> DataFrame:
    """Snapped records per segment: n, n_primary (neither low_accuracy nor far_snap) and the set of flags."""
    doubtful = F.arrays_overlap("quality_flags", F.array(F.lit("low_accuracy"), F.lit("far_snap")))
    return (
        clean.where("segment_id is not null")
        .groupBy("segment_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(~doubtful).alias("n_primary"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("quality_flags")))).alias("flags"),
        )
    )


def excluded_fraction(clean: DataFrame) -> DataFrame:
    """One row: the share of snapped records that are flagged as doubtful, 0 without any."""
    sums = segment_aggregate(clean).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_primary"), F.lit(0)).alias("p"))
    return sums.select(F.when(F.col("n") > 0, N.floor_round((F.col("n") - F.col("p")) / F.col("n"), 4)).otherwise(0.0).alias("excluded_fraction"))


def hazard_counts(clean: DataFrame) -> DataFrame:
    """Snapped records per segment and hazard."""
    return clean.where("segment_id is not null").groupBy("segment_id", "hazard_type").agg(F.count("*").alias("n"))


def hazard_breakdown(clean: DataFrame, small_n: int = 5) -> DataFrame:
    """Per segment a map of hazard to count, null if the segment has fewer than `small_n` records."""
    pairs = hazard_counts(clean).groupBy("segment_id").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("hazard_type", "n")))).alias("m")
    )
    return pairs.select("segment_id", "n", F.when(F.col("n") >= small_n, F.col("m")).alias("hazard_breakdown"))


def attach_exposure(segments: DataFrame, exposure: DataFrame) -> DataFrame:
    """Segments with their exposure columns, null where there is none."""
    return segments.join(exposure, "segment_id", "left")


def usable(exposure: Column, floor: float = 0.0) -> Column:
    return F.coalesce(exposure > floor, F.lit(False))


def exposure_mismatch(segments: DataFrame, exposure: DataFrame) -> DataFrame:
    """Exposure ids that are no segment, in order."""
    return exposure.select("segment_id").distinct().join(segments, "segment_id", "left_anti").orderBy("segment_id")


def check_id_scheme(segments: DataFrame, exposure: DataFrame) -> None:
    """Raise if exposure is given and none of it belongs to a segment."""
    known = segments.select("segment_id", F.lit(True).alias("known"))
    seen = exposure.select("segment_id").join(known, "segment_id", "left").agg(F.count("*").alias("n"), F.count("known").alias("k")).first()
    if seen.n and not seen.k:
        raise ValueError("no exposure id is a segment id")


def exposure_coverage(attached: DataFrame, floor: float = 0.0) -> DataFrame:
    """One row: segments, those with usable exposure, and their share (0 without segments)."""
    return attached.agg(
        F.count("*").alias("segments"), F.count_if(usable(F.col("estimate"), floor)).alias("usable")
    ).withColumn("coverage", F.when(F.col("segments") > 0, F.col("usable") / F.col("segments")).otherwise(0.0))


def corroboration(readings: Column) -> tuple[Column, Column]:
    """Ratio of least to greatest positive reading and 1 minus it; null with fewer than two."""
    good = F.filter(readings, lambda r: r > 0)
    ratio = F.when(F.size(good) >= 2, F.array_min(good) / F.array_max(good))
    return ratio, 1 - ratio


def is_stale(date_epoch: Column, reference_epoch: Column, days: int = 365) -> Column:
    """Whether exposure is further than `days` from the reference; unknown dates are not stale."""
    return F.coalesce(F.abs(date_epoch - reference_epoch) > days * DAY_S, F.lit(False))


def reference_date(records: DataFrame) -> DataFrame:
    """One row: the greatest occurred_at as a string."""
    return records.agg(F.max("occurred_at").alias("reference"))


def dispersion(attached: DataFrame) -> DataFrame:
    """One row: Pearson dispersion over positive exposures; 1 with fewer than two units or no event."""
    rows = attached.where("estimate > 0").select(F.coalesce("n", F.lit(0)).alias("n"), "estimate")
    whole = rows.agg(
        F.count("*").alias("units"), F.sum("n").alias("y"), F.sum("estimate").alias("e"),
        F.sum(F.col("n") * F.col("n") / F.col("estimate")).alias("q"),
    )
    # Sum of (n - tE)^2 / (tE) with t = y / e is q e / y - y.
    phi = (F.col("q") * F.col("e") / F.col("y") - F.col("y")) / (F.col("units") - 1)
    return whole.select("units", F.when((F.col("units") < 2) | (F.col("y") <= 0), 1.0).otherwise(phi).alias("phi"))


def published_flags(n: Column, small_n: int, usable_: Column, stale: Column, low_confidence: Column) -> Column:
    """Flags of a published segment, sorted."""
    return F.array_sort(
        F.array_compact(
            F.array(
                F.when(~usable_, "exposure_unknown"),
                F.when((n > 0) & (n < small_n), "low_sample"),
                F.when(low_confidence, "geocode_low_confidence"),
                F.when(stale, "exposure_stale"),
            )
        )
    )


def confidence_label(n: Column, usable_: Column, small_n: int = 5) -> Column:
    return F.when(~usable_, "exposure_unknown").when(n < small_n, "uncertain").otherwise("certain")


def publishable(n: Column, k: int = 3) -> Column:
    """k-anonymity: from 1 to k - 1 records are withheld; none may be told."""
    return ~((n > 0) & (n < k))


def segment_rates(
    attached: DataFrame,
    per: float = 1000.0,
    z: float = N.Z_CITY,
    small_n: int = 5,
    k: int = 3,
    floor: float = 0.0,
    phi: Column | None = None,
) -> DataFrame:
    """Rates of segments from their primary counts, with interval, label and sensitivity.

    Rows need segment_id, n, n_primary, estimate. A rate is null without usable exposure. The
    sensitivity is the rate of all records minus that of the primary ones, where that of all
    lies outside the interval.
    """
    n, p = F.coalesce("n", F.lit(0)), F.coalesce("n_primary", F.lit(0))
    e = F.when(usable(F.col("estimate"), floor), F.col("estimate"))
    out = attached.withColumns({"n": n, "n_primary": p}).withColumns(
        {
            "rate": N.rate(F.col("n_primary"), e, per),
            "rate_ci_low": N.rate_low(F.col("n_primary"), e, per, z, phi),
            "rate_ci_high": N.rate_high(F.col("n_primary"), e, per, z, phi),
            "confidence_label": confidence_label(F.col("n"), e.isNotNull(), small_n),
            "publishable": publishable(F.col("n"), k),
        }
    )
    everything = N.rate(F.col("n"), e, per)
    return out.withColumn(
        "rate_sensitivity_delta",
        F.when((everything < F.col("rate_ci_low")) | (everything > F.col("rate_ci_high")), everything - F.col("rate")),
    )


def rates_by_type(
    clean: DataFrame, exposure: DataFrame, per: float = 1000.0, z: float = N.Z_CITY, small_n: int = 5, floor: float = 0.0
) -> DataFrame:
    """Rates per segment and hazard with at least `small_n` records, all records counted, never widened."""
    rows = hazard_counts(clean).where(F.col("n") >= small_n).join(exposure, "segment_id").where(F.col("estimate") > floor)
    n, e = F.col("n"), F.col("estimate")
    return rows.select(
        "segment_id", "hazard_type", "n",
        N.rate(n, e, per).alias("rate"), N.rate_low(n, e, per, z).alias("rate_ci_low"), N.rate_high(n, e, per, z).alias("rate_ci_high"),
    )


def bias_shares(counts: DataFrame, exposure: DataFrame) -> DataFrame:
    """Share of events against share of exposure for all ids of positive exposure.

    Returns segment_id, report_share, exposure_share, difference; no row if either total is zero.
    """
    rows = exposure.where("estimate > 0").join(counts, "segment_id", "left").select(
        "segment_id", F.coalesce("n", F.lit(0)).alias("n"), "estimate"
    )
    total = rows.agg(F.sum("n").alias("all_n"), F.sum("estimate").alias("all_e"))
    shared = rows.crossJoin(F.broadcast(total)).where("all_n > 0 and all_e > 0")
    return shared.select(
        "segment_id",
        (F.col("n") / F.col("all_n")).alias("report_share"),
        (F.col("estimate") / F.col("all_e")).alias("exposure_share"),
    ).withColumn("difference", F.col("report_share") - F.col("exposure_share"))


def bias_extremes(shares: DataFrame, most: int = 3) -> DataFrame:
    """The most over- and under-represented ids: side, place, segment_id, difference."""
    over = shares.where("difference > 0").orderBy(F.desc("difference"), "segment_id").limit(most)
    under = shares.where("difference < 0").orderBy("difference", "segment_id").limit(most)
    place = lambda order: F.row_number().over(Window.orderBy(*order))  # noqa: E731  over at most three rows
    return over.select(
        F.lit("over").alias("side"), place([F.desc("difference"), "segment_id"]).alias("place"), "segment_id", "difference"
    ).unionByName(
        under.select(F.lit("under").alias("side"), place(["difference", "segment_id"]).alias("place"), "segment_id", "difference")
    )


def counter_snap(counts: DataFrame, segments: DataFrame, plane, max_snap_m: float = 30.0) -> DataFrame:
    """Counter readings (counter_id, lat, lon, count) with their nearest segment within the distance, null if there is none.

    Readings without a place or a positive count are left out.
    """
    from .spatial import snap_nearest

    good = counts.where("lat is not null and lon is not null and count > 0")
    named = good.select(F.col("counter_id").alias("report_id"), "lat", "lon", "count")
    return snap_nearest(named, segments, plane, max_snap_m).select(F.col("report_id").alias("counter_id"), "segment_id", "count")


def build_exposure(
    snapped: DataFrame, segments: DataFrame, source: str, date: str, how: str = "sum", fallback: bool = False, prior: float | None = None
) -> DataFrame:
    """Exposure (segment_id, estimate, source, date) from snapped readings (segment_id, count) by sum, mean or max.

    With `fallback` the segments without a reading get the prior, or else the median of the
    estimates, if it is positive, under a source that says so.
    """
    reduce = {"sum": F.sum, "mean": F.avg, "max": F.max}[how]
    known = snapped.where("segment_id is not null").groupBy("segment_id").agg(reduce("count").cast("double").alias("estimate"))
    out = known.select("segment_id", "estimate", F.lit(source).alias("source"), F.lit(date).alias("date"))
    if not fallback:
        return out
    middle = known.agg((F.percentile("estimate", 0.5) if prior is None else F.lit(float(prior))).alias("estimate"))
    others = segments.select("segment_id").join(known, "segment_id", "left_anti").crossJoin(F.broadcast(middle)).where("estimate > 0")
    return out.unionByName(others.select("segment_id", "estimate", F.lit(f"modeled_flat_prior ({source})").alias("source"), F.lit(date).alias("date")))


#: First and last colour of the map's ramp, as red, green and blue.
RAMP = ((220, 232, 235), (20, 91, 115))


def map_color(value: Column, most: Column) -> Column:
    """The colour of a value on the ramp, by the root of its share of the greatest."""
    share = F.sqrt(value / F.greatest(F.lit(1), most))
    channels = (F.floor(a + (b - a) * share + 0.5).cast("string") for a, b in zip(*RAMP))
    return F.concat(F.lit("rgb("), F.concat_ws(", ", *channels), F.lit(")"))
