"""Published releases: what changed between two of them and why, and whether one keeps the hard rules."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of a release's methods that say how the statistic is worked out, and those that say where a published
#: segment becomes significant; below this many reports nothing is published.
METHOD_KEYS = ("getis_ord_band_m", "kde_bandwidth_m", "rate_per", "significance")
SIGNIFICANCE_KEYS = ("fdr_alpha", "confidence_z", "small_n")
PUBLICATION_KEY = "min_publish_n"

#: Words in a property's name that present a count as danger, and those that tell of single reports.
DANGER_WORDS = ("danger", "score", "threat")
REPORT_WORDS = (
    "reporter", "token", "severity", "heading", "accuracy", "note", "notes", "mode", "modes", "timestamp", "datetime", "occurred",
    "lat", "lon", "lng", "latitude", "longitude", "coordinate", "coordinates", "coord", "coords", "uuid", "email",
)
#: Geometries of segments, statements that metadata must make, and fields that a manifest must have.
SEGMENT_GEOMETRIES = ("LineString", "MultiLineString")
STATEMENTS = ("privacy", "significance", "data_card")
MANIFEST_FIELDS = ("methods", "schema", "schema_version", "version")


# ---------------------------------------------------------------- changes


def _changed(old: dict | None, new: dict | None, keys: tuple[str, ...]) -> bool:
    return bool(old and new) and any(old.get(k) != new.get(k) for k in keys)


def hotspot_changes(old: DataFrame, new: DataFrame, old_methods: dict | None = None, new_methods: dict | None = None) -> DataFrame:
    """(segment_id, change, cause) of segments that became or ceased to be hot spots between two releases.

    Rows are published segments: segment_id, significant, report_count, exposure_estimate, exposure_source, exposure_date; one that is
    withheld has no row. change is appeared, disappeared (published still), or withdrawn. The first cause that holds counts:
    method_change; threshold_change (one of significance, or a lower floor of publication for one that was withheld);
    revised_exposure, with the same count of reports; new_reports; suppression of one that is withdrawn; else recomputation. Methods
    count only if both releases tell theirs. Nothing here says that a hazard was removed.
    """
    exposure = ("exposure_estimate", "exposure_source", "exposure_date")
    told = lambda rows, p: rows.select("segment_id", F.lit(True).alias(f"{p}_there"), F.coalesce("significant", F.lit(False)).alias(f"{p}_hot"), *(F.col(c).alias(f"{p}_{c}") for c in ("report_count", *exposure)))
    both = told(old, "a").join(told(new, "b"), "segment_id", "full_outer")
    hot = lambda p: F.coalesce(f"{p}_hot", F.lit(False))
    change = F.when(hot("b") & ~hot("a"), "appeared").when(hot("a") & F.col("b_there").isNull(), "withdrawn").when(hot("a") & ~hot("b"), "disappeared")
    differs = lambda c: ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    floors = [m.get(PUBLICATION_KEY) if m else None for m in (old_methods, new_methods)]
    lowered = None not in floors and floors[1] < floors[0]
    cause = (
        F.when(F.col("change") == "withdrawn", "suppression")
        .when(F.lit(_changed(old_methods, new_methods, METHOD_KEYS)), "method_change")
        .when(F.col("a_there").isNull(), "threshold_change" if lowered else "recomputation")
        .when(F.lit(_changed(old_methods, new_methods, SIGNIFICANCE_KEYS)), "threshold_change")
        .when(differs("report_count"), "new_reports")
        .when(reduce(lambda x, y: x | y, map(differs, exposure)), "revised_exposure")
        .otherwise("recomputation")
    )
    return both.withColumn("change", change).where("change is not null").select("segment_id", "change", cause.alias("cause"))


# ---------------------------------------------------------------- hard rules


def features(rows: DataFrame, geometry: str = "LineString") -> DataFrame:
    """Rows of a frame as features of a release: pos, geometry (its type), properties (all columns, nulls left out of them)."""
    said = F.parse_json(F.to_json(F.struct(*rows.columns)))
    return rows.select(F.monotonically_increasing_id().alias("pos"), F.lit(geometry).alias("geometry"), said.alias("properties"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The same of a GeoJSON file. A release is small; larger collections are read by `sources.collections`."""
    row = "struct<features: array<struct<geometry: struct<type: string>, properties: string>>>"
    found = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", row)["features"]).alias("pos", "f"))
    return found.select(F.col("pos").cast("long"), F.col("f.geometry.type").alias("geometry"), F.try_parse_json(F.coalesce("f.properties", F.lit("{}"))).alias("properties"))


def _words(names: Column) -> Column:
    """The different words of names, in lower case."""
    return F.array_distinct(F.flatten(F.transform(names, lambda n: F.regexp_extract_all(F.lower(n), F.lit("([a-z0-9]+)"), 1))))


def feature_problems(found: DataFrame, k: int = 3, small_n: int = 5) -> DataFrame:
    """(rule, segment_id, problem) of features (pos, geometry, properties) that break a hard rule.

    HR1: a count is named report_count, and a rate has its denominator with source and date; HR2: a rate lies in its interval, rests on
    an n, and is marked if that is small; HR3: quality_flags is an array; HR4: no n from 1 to k - 1, no name that tells of
    single reports at any depth, and the geometry is a segment's.
    """
    at = lambda name, kind: F.try_variant_get("properties", f"$.{name}", kind)
    kind = lambda name: F.coalesce(F.schema_of_variant(at(name, "variant")), F.lit("VOID"))
    there = lambda name: kind(name) != "VOID"
    whole = lambda name: kind(name) == "BIGINT"
    number = lambda name: whole(name) | kind(name).isin("DOUBLE", "FLOAT") | kind(name).startswith("DECIMAL")
    value = lambda name: F.when(number(name), at(name, "double"))
    text = lambda name: (kind(name) == "STRING") & (at(name, "string") != "")
    listed = lambda name: kind(name).startswith("ARRAY")
    said = F.to_json("properties")
    names, own = F.regexp_extract_all(said, F.lit(r'"((?:[^"\\]|\\.)*)":'), 1), F.json_object_keys(said)
    rate, n, low, high = value("rate"), F.when(whole("n"), at("n", "long")), value("rate_ci_low"), value("rate_ci_high")
    count = F.when(whole("report_count"), at("report_count", "long"))
    marked = F.coalesce(F.array_contains(at("quality_flags", "array<string>"), "low_sample"), F.lit(False)) | F.coalesce(at("confidence_label", "string").isin("uncertain", "exposure_unknown"), F.lit(False))
    rules = (
        ("HR1", "report_count is missing", ~there("report_count")),
        ("HR1", "report_count is no whole number of 0 or more", there("report_count") & ~F.coalesce(count >= 0, F.lit(False))),
        ("HR1", "a property presents a count as danger", F.arrays_overlap(_words(own), F.array(*map(F.lit, DANGER_WORDS)))),
        ("HR1", "a rate without a positive exposure", there("rate") & ~F.coalesce(value("exposure_estimate") > 0, F.lit(False))),
        ("HR1", "a rate without the source of its exposure", there("rate") & ~text("exposure_source")),
        ("HR1", "a rate without the date of its exposure", there("rate") & ~text("exposure_date")),
        ("HR2", "a rate that is no number", there("rate") & ~number("rate")),
        ("HR2", "a rate without an interval", number("rate") & (low.isNull() | high.isNull())),
        ("HR2", "a rate outside its interval", number("rate") & ((rate < low) | (rate > high))),
        ("HR2", "a rate without an n", number("rate") & ~F.coalesce(n >= 0, F.lit(False))),
        ("HR2", "reports without an n of 1 or more", number("rate") & ((count > 0) | (rate > 0)) & (n == 0)),
        ("HR2", "a small sample that is not marked", number("rate") & (n > 0) & (n < small_n) & ~marked),
        ("HR3", "quality_flags is missing or no array", ~listed("quality_flags")),
        ("HR4", "fewer reports than may be told", (n > 0) & (n < k)),
        ("HR4", "a property tells of single reports", F.arrays_overlap(_words(names), F.array(*map(F.lit, REPORT_WORDS)))),
        ("HR4", "the geometry is not a segment's", ~F.coalesce(F.col("geometry").isin(*SEGMENT_GEOMETRIES), F.lit(False))),
    )
    broken = F.array_compact(F.array(*(F.when(bad, F.struct(F.lit(rule).alias("rule"), F.lit(problem).alias("problem"))) for rule, problem, bad in rules)))
    label = F.coalesce(F.when(text("segment_id"), at("segment_id", "string")), F.concat(F.lit("feature["), F.col("pos").cast("string"), F.lit("]")))
    return found.select(label.alias("segment_id"), F.explode(broken).alias("x")).select("x.rule", "segment_id", "x.problem")


def metadata_problems(metadata: dict | None) -> list[tuple[str, str]]:
    """HR3 of a whole release: the statements that its metadata must make."""
    said = metadata if isinstance(metadata, dict) else None
    out = [("HR3", "metadata is missing")] if said is None else []
    return out + [("HR3", f"metadata.{k} is missing") for k in STATEMENTS if not (isinstance((said or {}).get(k), str) and said[k].strip())]


def manifest_problems(sha256: str, sidecar: dict | None) -> list[tuple[str, str]]:
    """HR5: a manifest is there, has the digest of the file, and says by what methods, schema and version it was made."""
    if not isinstance(sidecar, dict):
        return [("HR5", "the manifest is missing")]
    told = sidecar.get("geojson_sha256")
    out = [("HR5", "geojson_sha256 is missing")] if not (isinstance(told, str) and told) else []
    if not out and told.lower() != sha256:
        out = [("HR5", "geojson_sha256 is not that of the file")]
    empty = lambda v: v is None or (isinstance(v, (str, dict, list)) and not v)
    return out + [("HR5", f"{k} is missing") for k in MANIFEST_FIELDS if empty(sidecar.get(k))]


def verify_release(spark: SparkSession, path: str, sidecar: str | None = None, k: int | None = None) -> DataFrame:
    """(rule, segment_id, problem) of a release's file and its manifest; no row if it keeps all rules.

    The floor and the size of a small sample are those of the manifest's methods, else 3 and 5.
    """
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    said = json.loads(content)
    beside = json.loads(spark.read.text(sidecar, wholetext=True).first()[0]) if sidecar else None
    methods = beside.get("methods") if isinstance(beside, dict) and isinstance(beside.get("methods"), dict) else {}
    whole = metadata_problems(said.get("metadata") if isinstance(said, dict) else None) + manifest_problems(hashlib.sha256(content).hexdigest(), beside)
    rows = feature_problems(read_features(spark, path), k or methods.get("min_publish_n", 3), methods.get("small_n", 5))
    more = spark.createDataFrame([(rule, None, problem) for rule, problem in whole], "rule string, segment_id string, problem string")
    return rows.unionByName(more)

