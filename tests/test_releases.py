"""Changes between releases and the hard rules, on the cases that a reader of the rules would try."""

import hashlib
import json

import pytest

from tallygrid.operators import governance, releases

SEGMENT = "segment_id string, significant boolean, report_count long, exposure_estimate double, exposure_source string, exposure_date string"
METHODS = {"confidence_z": 1.96, "fdr_alpha": 0.05, "getis_ord_band_m": 300.0, "kde_bandwidth_m": 150.0, "min_publish_n": 3, "rate_per": 1000.0, "significance": "Gi*", "small_n": 5}


def changes(spark, old, new, more=None, methods=True):
    row = lambda s, hot, n, e=800.0, d="2024": (s, hot, n, e, "counts", d)
    frame = lambda rows: spark.createDataFrame([row(*r) for r in rows], SEGMENT)
    said = (METHODS, METHODS | (more or {})) if methods else (None, None)
    return {r.segment_id: (r.change, r.cause) for r in releases.hotspot_changes(frame(old), frame(new), *said).collect()}


@pytest.mark.parametrize(
    "old, new, more, want",
    [
        ([("s", False, 3)], [("s", True, 12)], {}, ("appeared", "new_reports")),
        ([("s", True, 6, 800.0)], [("s", False, 6, 5000.0)], {}, ("disappeared", "revised_exposure")),
        ([("s", True, 6, 800.0)], [("s", False, 7, 5000.0)], {}, ("disappeared", "new_reports")),
        ([("s", True, 6, 800.0, "2024")], [("s", False, 6, 800.0, "2025")], {}, ("disappeared", "revised_exposure")),
        ([("s", True, 6)], [("s", False, 6)], {"getis_ord_band_m": 500.0}, ("disappeared", "method_change")),
        ([("s", True, 6)], [("s", False, 9)], {"fdr_alpha": 0.01}, ("disappeared", "threshold_change")),
        ([("s", True, 6)], [], {"getis_ord_band_m": 500.0}, ("withdrawn", "suppression")),
        ([], [("s", True, 2)], {"min_publish_n": 2}, ("appeared", "threshold_change")),
        ([], [("s", True, 4)], {"min_publish_n": 4}, ("appeared", "recomputation")),
        ([], [("s", True, 4)], {"rate_per": 1.0}, ("appeared", "method_change")),
        ([("s", False, 6)], [("s", True, 6)], {}, ("appeared", "recomputation")),
        ([("s", True, 6)], [("s", True, 9)], {}, None),
        ([("s", False, 6)], [], {}, None),
        ([("s", None, 6)], [("s", False, 9)], {}, None),
    ],
)
def test_causes(spark, old, new, more, want):
    if not old or not new:
        pad = [("other", False, 1)]
        old, new = old + pad, new + pad
    assert changes(spark, old, new, more).get("s") == want


def test_methods_count_only_if_both_tell_them(spark):
    assert changes(spark, [("s", True, 6)], [("s", False, 6)], {"fdr_alpha": 0.1}, methods=False) == {"s": ("disappeared", "recomputation")}


GOOD = {
    "segment_id": "seg-1", "report_count": 9, "n": 9, "rate": 4.5, "rate_ci_low": 2.0, "rate_ci_high": 8.0, "exposure_estimate": 2000, "exposure_source": "counts", "exposure_date": "2024-01-01",
    "quality_flags": [], "confidence_label": "certain", "hazard_breakdown": {"dooring": 9},
}


def verdict(spark, tmp_path, change=None, gone=(), geometry="LineString", metadata=None, sidecar=(), tampered=False):
    properties = {k: v for k, v in (GOOD | (change or {})).items() if k not in gone}
    said = {"type": "FeatureCollection", "metadata": {"privacy": "p", "significance": "s", "data_card": "d"} | (metadata or {}), "features": [{"type": "Feature", "geometry": {"type": geometry, "coordinates": []}, "properties": properties}, {"type": "Feature", "geometry": {"type": "MultiLineString", "coordinates": []}, "properties": GOOD | {"rate": None, "n": 0, "report_count": 0}}]}
    path, beside = tmp_path / "r.geojson", tmp_path / "r.metadata.json"
    path.write_text(json.dumps(said, indent=1))
    digest = hashlib.sha256(path.read_bytes() + b"x" * tampered).hexdigest()
    if sidecar is not None:
        beside.write_text(json.dumps({"geojson_sha256": digest, "methods": {"min_publish_n": 3, "small_n": 5}, "schema": "s", "schema_version": "1", "version": "2"} | dict(sidecar)))
    found = releases.verify_release(spark, str(path), str(beside) if sidecar is not None else None).collect()
    return sorted((r.rule, r.problem) for r in found), {r.segment_id for r in found}


def test_a_good_release_keeps_all_rules(spark, tmp_path):
    assert verdict(spark, tmp_path) == ([], set())
    assert verdict(spark, tmp_path, {"n": 4, "quality_flags": ["low_sample"]})[0] == []
    assert verdict(spark, tmp_path, {"n": 4, "confidence_label": "uncertain"})[0] == []


@pytest.mark.parametrize(
    "rule, problem, how",
    [
        ("HR1", "report_count is missing", {"gone": ["report_count"]}), ("HR1", "report_count is no whole number of 0 or more", {"change": {"report_count": 2.5}}),
        ("HR1", "a property presents a count as danger", {"change": {"danger_score": 3}}), ("HR1", "a rate without a positive exposure", {"change": {"exposure_estimate": 0}}),
        ("HR1", "a rate without the source of its exposure", {"change": {"exposure_source": ""}}), ("HR1", "a rate without the date of its exposure", {"gone": ["exposure_date"]}),
        ("HR2", "a rate outside its interval", {"change": {"rate_ci_low": 5.5}}), ("HR2", "a rate without an interval", {"change": {"rate_ci_high": None}}),
        ("HR2", "a rate that is no number", {"change": {"rate": "4.5"}}), ("HR2", "a rate without an n", {"change": {"n": 9.0}}), ("HR2", "reports without an n of 1 or more", {"change": {"n": 0}}),
        ("HR2", "a small sample that is not marked", {"change": {"n": 4}}), ("HR3", "metadata.privacy is missing", {"metadata": {"privacy": " "}}), ("HR3", "metadata.data_card is missing", {"metadata": {"data_card": None}}),
        ("HR3", "quality_flags is missing or no array", {"change": {"quality_flags": "none"}}), ("HR4", "fewer reports than may be told", {"change": {"n": 1, "quality_flags": ["low_sample"]}}),
        ("HR4", "a property tells of single reports", {"change": {"reporter_token": "abc123"}}), ("HR4", "a property tells of single reports", {"change": {"more": [{"by-Mode": 1}]}}),
        ("HR4", "the geometry is not a segment's", {"geometry": "Point"}), ("HR5", "geojson_sha256 is not that of the file", {"tampered": True}), ("HR5", "the manifest is missing", {"sidecar": None}),
        ("HR5", "methods is missing", {"sidecar": {"methods": {}}}), ("HR5", "geojson_sha256 is missing", {"sidecar": {"geojson_sha256": ""}}),
    ],
)
def test_each_rule_can_be_broken(spark, tmp_path, rule, problem, how):
    assert verdict(spark, tmp_path, **how)[0] == [(rule, problem)]


def test_values_with_key_like_texts_are_no_names(spark, tmp_path):
    assert verdict(spark, tmp_path, {"name": 'says "mode": and \\"token\\": too', "exposure_note_free": 1})[0] == [("HR4", "a property tells of single reports")]
    assert verdict(spark, tmp_path, {"name": 'says "mode": and "token": too'})[0] == []


def test_duplicates_inside_a_batch(spark):
    schema = "report_id string, occurred_at string, lat double, lon double, address string, mode string, hazard_type string, severity string, accuracy_m double, note string"
    row = lambda i, lat=1.0, note=None: (i, "2026-01-01T10:00:00Z", lat, 2.0, None, "cyclist", "dooring", "minor", None, note)
    batch = spark.createDataFrame([row("a"), row("b"), row("c", 3.0, "plate abc1234, call 555-123-4567"), row("d", 5.0)], schema)
    queue = spark.createDataFrame([(*row("q", 5.0), "pending"), (*row("r", 3.0), "rejected")], schema + ", status string")
    got = {r.report_id: r.flags for r in governance.submit(batch, queue, spark.createDataFrame([], "hash string")).collect()}
    assert got == {"a": [], "b": ["possible_duplicate"], "c": ["possible_phone_in_note", "possible_plate_in_note"], "d": ["possible_duplicate"]}
