"""The city pipeline: reports to clean records, and to published segment statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import numerics as N
from ..functions import text as X
from . import hotspot, network, rates
from .dedupe import dedupe
from .spatial import geocode, snap_nearest


def in_window(occurred_at: Column, start: str | None, end: str | None) -> Column:
    """Whether the local date is within the bounds, both included, either open."""
    date = X.local_date(occurred_at)
    return (F.lit(True) if start is None else date >= start) & (F.lit(True) if end is None else date <= end)


def window_filter(reports: DataFrame, start: str | None, end: str | None) -> tuple[DataFrame, DataFrame]:
    """(reports in the window, reports out of it)."""
    inside = F.coalesce(in_window(F.col("occurred_at"), start, end), F.lit(False))
    return reports.where(inside), reports.where(~inside)


def quality_flags(segment: Column, distance: Column, accuracy: Column, snap_max: float) -> Column:
    """unsnapped, low_accuracy and far_snap, in this order, as far as they hold."""
    return F.array_compact(
        F.array(
            F.when(segment.isNull(), "unsnapped"),
            F.when(accuracy > snap_max, "low_accuracy"),
            F.when(segment.isNotNull() & (distance > snap_max * 0.6), "far_snap"),
        )
    )


def clean_records(reports: DataFrame, segments: DataFrame, plane: geo.Plane, snap_max: float = 25.0) -> DataFrame:
    """Snap, classify and flag."""
    snapped = snap_nearest(reports, segments, plane, snap_max)
    return snapped.select(
        "report_id", "occurred_at", "epoch", "segment_id", "snapped_distance_m", "mode", "severity", "reporter_token",
        X.classify(F.col("hazard_type")).alias("hazard_type"),
        quality_flags(F.col("segment_id"), F.col("snapped_distance_m"), F.col("accuracy_m"), snap_max).alias("quality_flags"),
    )


def run_pipeline(
    reports: DataFrame, segments: DataFrame, plane: geo.Plane, start: str | None = None, end: str | None = None,
    gazetteer: DataFrame | None = None, snap_max: float = 25.0, distance_m: float = 15.0, window_s: int = 600,
) -> DataFrame:
    """Window, deduplicate, geocode, snap, classify, flag. Geocoding follows deduplication, so
    address-only reports, all at (0, 0), are duplicates if the rest agrees."""
    kept, _ = window_filter(reports, start, end)
    kept = dedupe(kept, plane, distance_m, window_s)
    if gazetteer is not None:
        kept = geocode(kept, gazetteer)
    return clean_records(kept, segments, plane, snap_max)


def stage_summary(
    reports: DataFrame, segments: DataFrame, plane: geo.Plane, start: str | None = None, end: str | None = None,
    gazetteer: DataFrame | None = None, snap_max: float = 25.0, distance_m: float = 15.0, window_s: int = 600,
) -> DataFrame:
    """One row on a run of the pipeline: reports_in, out_of_window, duplicates_removed, snapped, unsnapped."""
    inside, _ = window_filter(reports, start, end)
    clean = run_pipeline(reports, segments, plane, start, end, gazetteer, snap_max, distance_m, window_s)
    seen = reports.agg(F.count("*").alias("reports_in")).crossJoin(inside.agg(F.count("*").alias("inside")))
    ends = clean.agg(F.count("segment_id").alias("snapped"), F.count_if(F.col("segment_id").isNull()).alias("unsnapped"))
    return seen.crossJoin(ends).select(
        "reports_in", (F.col("reports_in") - F.col("inside")).alias("out_of_window"),
        (F.col("inside") - F.col("snapped") - F.col("unsnapped")).alias("duplicates_removed"), "snapped", "unsnapped",
    )


def segment_statistics(
    clean: DataFrame, segments: DataFrame, exposure: DataFrame, plane: geo.Plane, per: float = 1000.0, z: float = N.Z_CITY,
    small_n: int = 5, k: int = 3, alpha: float = 0.05, band: float = 300.0, node_snap: float = 5.0, adjust: bool = False,
) -> DataFrame:
    """Everything that is published of a segment: counts, exposure, rate and interval, Gi*, significance, labels."""
    # Used many times below, and perhaps worked out of a large table.
    segments, exposure = network.kept(segments), network.kept(exposure)
    rates.check_id_scheme(segments, exposure)
    attached = rates.attach_exposure(segments.join(rates.segment_aggregate(clean), "segment_id", "left"), exposure)
    phi = None
    if adjust:
        attached = network.kept(attached)
        attached = attached.crossJoin(F.broadcast(rates.dispersion(attached).select("phi")))
        phi = F.col("phi")
    # One row per segment, used several times below: worked out once.
    rated = network.kept(rates.segment_rates(attached, per, z, small_n, k, phi=phi))
    adjacency = network.kept(network.segment_adjacency(segments, plane, node_snap))
    near = network.network_neighbors(segments, adjacency, band).select("a", "b")
    known = rated.where("rate is not null").select(F.col("segment_id").alias("id"), F.col("rate").alias("value"))
    flagged = hotspot.hotspot_significance(hotspot.getis_ord_star(known, near), alpha)
    return rated.join(flagged.select(F.col("id").alias("segment_id"), "z", "p", "significant"), "segment_id", "left").withColumn(
        "significant", F.coalesce("significant", F.lit(False))
    )
