"""Moderation, contributors' rights, coverage, preregistration, vintages, conformance, scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numerics as N
from ..functions import text as X
from .shared import bounded_broadcast

#: Keys that no published row may have.
PRIVATE_KEYS = ("reporter_token", "occurred_at", "note", "heading_deg", "lat", "lon", "accuracy_m", "mode", "severity", "true_count")


# ---------------------------------------------------------------- intake and moderation


def validate_reports(reports: DataFrame) -> DataFrame:
    """Adds problems, an array of messages, empty for a valid report."""
    bad = {
        "mode": ~F.coalesce(F.col("mode").isin(*X.MODES), F.lit(False)),
        "hazard_type": ~F.coalesce(F.col("hazard_type").isin(*X.HAZARDS), F.lit(False)),
        "severity": ~F.coalesce(F.col("severity").isin(*X.SEVERITIES), F.lit(False)),
        "lat": ~F.coalesce(F.col("lat").between(-90, 90), F.lit(True)),
        "lon": ~F.coalesce(F.col("lon").between(-180, 180), F.lit(True)),
        "location": (F.col("lat").isNull() | F.col("lon").isNull()) & F.col("address").isNull(),
        "accuracy_m": F.coalesce((F.col("accuracy_m") <= 0) | (F.col("accuracy_m") > 100_000), F.lit(False)),
    }
    return reports.withColumn("problems", F.array_compact(F.array(*(F.when(b, F.lit(f"{name}: not valid")) for name, b in bad.items()))))


def accept_batch(reports: DataFrame) -> DataFrame:
    """The reports; raises if any has a problem, so that a batch is stored whole or not at all."""
    wrong = validate_reports(reports).where(F.size("problems") > 0)
    if not wrong.isEmpty():
        raise ValueError(f"{wrong.count()} invalid reports")
    return reports


def tombstone_anti(rows: DataFrame, tombstones: DataFrame, identity: str = "report_id") -> DataFrame:
    """Rows whose hashed identity was not deleted."""
    return rows.withColumn("__h", X.tombstone_key(F.col(identity))).join(
        tombstones.select(F.col("hash").alias("__h")), "__h", "left_anti"
    ).drop("__h")


def record_tombstones(old: DataFrame, ids: DataFrame, identity: str = "report_id") -> DataFrame:
    """Hashes of both, each once."""
    return old.select("hash").unionByName(ids.select(X.tombstone_key(F.col(identity)).alias("hash"))).distinct()


def coarse_key() -> list[Column]:
    """Place to 4 digits, address, hazard and hour, without nulls."""
    at = lambda c: F.coalesce(F.floor(F.col(c) * 1e4 + 0.5), F.lit(-(2**62)))
    return [at("lat"), at("lon"), F.coalesce("address", F.lit("")), F.coalesce("hazard_type", F.lit("")), F.coalesce(F.substring("occurred_at", 1, 13), F.lit(""))]


def coarse_duplicates(reports: DataFrame) -> DataFrame:
    """Adds possible_duplicate: an earlier row has the same coarse place, address, hazard and hour."""
    return reports.withColumn("possible_duplicate", F.row_number().over(Window.partitionBy(*coarse_key()).orderBy("report_id")) > 1)


def submit(batch: DataFrame, queue: DataFrame, tombstones: DataFrame) -> DataFrame:
    """The batch as pending submissions with review flags; raises if a report is not valid or was deleted before.

    `queue` has the columns of reports and status; a report is a possible duplicate if one of the queue that was
    not rejected, or an earlier one of the batch by report_id, has the same coarse place, address, hazard and hour.
    """
    good = accept_batch(batch)
    kept_out = good.select("report_id").join(tombstone_anti(good.select("report_id"), tombstones), "report_id", "left_anti")
    if not kept_out.isEmpty():
        raise ValueError(f"{kept_out.count()} reports were deleted by their contributors")
    open_ = queue.where("status <> 'rejected'").select(*(c.alias(f"__k{i}") for i, c in enumerate(coarse_key()))).distinct().withColumn("__seen", F.lit(True))
    keyed = good.withColumns({f"__k{i}": c for i, c in enumerate(coarse_key())}).join(open_, [f"__k{i}" for i in range(len(coarse_key()))], "left")
    keyed = keyed.withColumn("__again", F.row_number().over(Window.partitionBy(*(f"__k{i}" for i in range(len(coarse_key())))).orderBy("report_id")) > 1)
    note = F.col("note") if "note" in batch.columns else F.lit(None).cast("string")
    flags = F.concat(F.coalesce(X.pii_flags(note), F.array().cast("array<string>")), F.when(F.coalesce("__seen", F.lit(False)) | F.col("__again"), F.array(F.lit("possible_duplicate"))).otherwise(F.array().cast("array<string>")))
    return keyed.select(*batch.columns, F.lit("pending").alias("status"), flags.alias("flags"))


#: What a submission can be.
STATUSES = ("pending", "approved", "rejected")


def moderation_report(submissions: DataFrame, k: int = 5) -> DataFrame:
    """(breakdown, key, n, withheld): counts by status, review flag and, of rejected ones, category of reason.

    Rows need status, flags and reason. Counts from 1 to k - 1 are withheld as null; every status
    and category has a row. One row (withheld, cells) tells how many were withheld.
    """
    spark = submissions.sparkSession
    names = [("status", s) for s in STATUSES] + [("reason", c) for c in (*(n for n, _ in X.REASONS), "other")]
    seen = submissions.select(F.explode(F.concat(
        F.array(F.struct(F.lit("status").alias("breakdown"), F.col("status").alias("key"))),
        F.transform(F.coalesce("flags", F.array().cast("array<string>")), lambda f: F.struct(F.lit("flag").alias("breakdown"), f.alias("key"))),
        F.when(F.col("status") == "rejected", F.array(F.struct(F.lit("reason").alias("breakdown"), X.reason_category(F.col("reason")).alias("key")))).otherwise(F.array().cast("array<struct<breakdown:string,key:string>>")),
    )).alias("x")).groupBy("x.breakdown", "x.key").agg(F.count("*").alias("n"))
    every = spark.createDataFrame(names, "breakdown string, key string").join(seen, ["breakdown", "key"], "full_outer").withColumn("n", F.coalesce("n", F.lit(0)))
    small = (F.col("n") > 0) & (F.col("n") < k)
    told = every.select("breakdown", "key", F.when(~small, F.col("n")).alias("n"), small.alias("withheld"))
    return told.unionByName(told.agg(F.count_if("withheld").alias("n")).select(F.lit("withheld").alias("breakdown"), F.lit("cells").alias("key"), "n", F.lit(False).alias("withheld")))


def latest_state(events: DataFrame) -> DataFrame:
    """Newest status of each submission from (submission_id, seq, status); once rejected it stays so."""
    return events.groupBy("submission_id").agg(
        F.max_by("status", "seq").alias("last"), F.bool_or(F.col("status") == "rejected").alias("no")
    ).select("submission_id", F.when(F.col("no"), "rejected").otherwise(F.col("last")).alias("status"))


def moderation_counts(submissions: DataFrame, by: Column, k: int = 5) -> DataFrame:
    """(key, n): counts with those from 1 to k - 1 withheld as null."""
    counts = submissions.groupBy(by.alias("key")).agg(F.count("*").alias("n"))
    return counts.select("key", F.when(~((F.col("n") > 0) & (F.col("n") < k)), F.col("n")).alias("n"))


def decision_latency(submissions: DataFrame, k: int = 5) -> DataFrame:
    """One row: decided, and the median hours from receipt to decision, withheld under k decisions."""
    decided = submissions.where("decided_epoch is not null").withColumn("h", (F.col("decided_epoch") - F.col("received_epoch")) / 3600.0)
    out = decided.agg(F.count("*").alias("decided"), F.percentile("h", 0.5).alias("median"))
    return out.select("decided", F.when(F.col("decided") >= k, N.floor_round(F.col("median"), 2)).alias("median_hours"))


def token_split(reports: DataFrame, token: str) -> tuple[DataFrame, DataFrame]:
    """(that contributor's rows, all others)."""
    mine = F.coalesce(F.col("reporter_token") == token, F.lit(False))
    return reports.where(mine), reports.where(~mine)


def retention_purge(reports: DataFrame, now_epoch: int, days: int) -> DataFrame:
    """Rows young enough; those without a readable time stay; zero days keep all."""
    if days <= 0:
        return reports
    return reports.where(F.coalesce(X.epoch(F.col("occurred_at")) >= now_epoch - days * 86_400, F.lit(True)))


def approved_union(queue: DataFrame, store: DataFrame) -> DataFrame:
    """Approved rows of both, one for each report_id, the queue's first."""
    both = queue.withColumn("__s", F.lit(0)).unionByName(store.withColumn("__s", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("report_id").orderBy("__s"))
    return both.withColumn("__r", place).where("__r = 1").drop("__s", "__r")


# ---------------------------------------------------------------- publication


def private_columns(rows: DataFrame) -> list[str]:
    """Columns that no published row may have. Geometry, an array of points, is not looked into."""
    return [c for c in rows.columns if c.lower() in PRIVATE_KEYS]


def published_rows(rated: DataFrame, k: int = 3, count: str = "n") -> DataFrame:
    """What may be told of each publishable segment; raises if a private column or a count from 1 to k - 1 would be."""
    private = private_columns(rated)
    if private:
        raise ValueError("private columns: " + ", ".join(private))
    told = rated.where("publishable")
    if count in rated.columns and not told.where((F.col(count) > 0) & (F.col(count) < k)).isEmpty():
        raise ValueError(f"a published count is below {k}")
    return told


def metadata_leaks(text: str, reports: DataFrame) -> DataFrame:
    """(problem, what): private keys in the JSON text of metadata, and reports both of whose coordinates, to 5 digits, stand in it."""
    keys = F.array(*(F.lit(k) for k in PRIVATE_KEYS if f'"{k}"' in text)) if any(f'"{k}"' in text for k in PRIVATE_KEYS) else F.array().cast("array<string>")
    said = reports.sparkSession.range(1).select(F.lit("private key").alias("problem"), F.explode(keys).alias("what"))
    there = lambda c: F.contains(F.lit(text), F.round(c, 5).cast("string"))
    at = reports.where(there(F.col("lat")) & there(F.col("lon"))).select(F.lit("raw coordinate").alias("problem"), F.col("report_id").cast("string").alias("what"))
    return said.unionByName(at)


def geometry_leaks(segments: DataFrame, reports: DataFrame) -> DataFrame:
    """Published vertices that equal a raw report position to 6 digits."""
    at = lambda c: F.floor(c * 1e6 + 0.5)
    vertices = segments.select("segment_id", F.explode("coords").alias("p")).select("segment_id", at(F.col("p.lat")).alias("y"), at(F.col("p.lon")).alias("x"))
    return vertices.join(reports.select(at(F.col("lat")).alias("y"), at(F.col("lon")).alias("x")).distinct(), ["y", "x"], "left_semi")


def coverage_assess(attached: DataFrame, stale: Column, usable_floor: float = 0.0) -> DataFrame:
    """One row: usable and observed shares, stale ones, and the evidence tier from 0 to 3."""
    usable = F.coalesce(F.col("estimate") > usable_floor, F.lit(False))
    counts = attached.agg(
        F.count("*").alias("segments"), F.count_if(usable).alias("usable"),
        F.count_if(usable & (F.col("tier") == "observed")).alias("observed"), F.count_if(usable & stale).alias("stale"),
    )
    share = lambda c: F.when(F.col("segments") > 0, F.col(c) / F.col("segments")).otherwise(0.0)
    return counts.withColumns({"usable_share": share("usable"), "observed_share": share("observed")}).withColumn(
        "tier",
        F.when(F.col("usable") == 0, 0).when(F.col("usable_share") < 0.5, 1).when(F.col("observed_share") < 0.5, 2).otherwise(3),
    )


def readiness(groups: DataFrame, k: int = 3) -> DataFrame:
    """One row: groups (key, n), those under k, and their rows."""
    small = (F.col("n") > 0) & (F.col("n") < k)
    return groups.agg(
        F.count("*").alias("groups"), F.count_if(small).alias("small_groups"),
        F.coalesce(F.sum(F.when(small, F.col("n"))), F.lit(0)).alias("small_rows"), F.sum("n").alias("rows"),
    )


# ---------------------------------------------------------------- preregistration and vintages


def preregister(rated: DataFrame) -> DataFrame:
    """Frozen predictions: significant, publishable, rated segments, with their place by rate."""
    fit = rated.where("significant and publishable and rate is not null")
    return fit.select("segment_id", F.col("rate").alias("predicted_rate"))


def score_preregistration(predicted: DataFrame, held_out: DataFrame, z: float = N.Z_CITY) -> DataFrame:
    """One row: evaluable predictions, hits, hit rate with Wilson interval, and unevaluable ones."""
    seen = predicted.join(held_out.select("segment_id", F.col("significant").alias("hit"), "rate"), "segment_id", "left")
    sums = seen.agg(
        F.count_if(F.col("rate").isNotNull()).alias("evaluable"),
        F.count_if(F.col("rate").isNotNull() & F.coalesce("hit", F.lit(False))).alias("hits"),
        F.count_if(F.col("rate").isNull()).alias("unevaluable"),
    )
    low, high = N.wilson(F.col("hits"), F.col("evaluable"), z)
    return sums.withColumns({"hit_rate": F.when(F.col("evaluable") > 0, F.col("hits") / F.col("evaluable")), "low": low, "high": high})


def scorecard(verdicts: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: recall, precision, false-positive rates by role and interval coverage, null on nothing.

    Truth rows (segment_id, role, true_rate) with roles hotspot, decoy, bias_trap, background.
    """
    t = truth.join(verdicts, "segment_id", "left").withColumn("flag", F.coalesce("significant", F.lit(False)))
    part = lambda a, b: N.floor_round(F.count_if(a) / F.nullif(F.count_if(b), F.lit(0)), 4)
    role = lambda r: F.col("role") == r
    covered = F.col("true_rate").between(F.col("rate_ci_low"), F.col("rate_ci_high"))
    return t.agg(
        part(role("hotspot") & F.col("flag"), role("hotspot")).alias("recall"),
        part(role("hotspot") & F.col("flag"), F.col("flag")).alias("precision"),
        *(part(role(r) & F.col("flag"), role(r)).alias(f"{r}_fp") for r in ("decoy", "bias_trap", "background")),
        part(F.coalesce(covered, F.lit(False)), F.col("rate_ci_low").isNotNull()).alias("ci_coverage"),
    )


#: The axes on which each source's bias has to be described.
BIAS_AXES = ("route_choice", "reporter_pool", "app_access", "language", "demographic_skew", "survivorship", "salience", "temporal_campaign")
#: Characters that an answer about an axis has at least.
LEAST_ANSWER = 40


def crosswalk_problems(said: dict) -> list[str]:
    """What is wrong with a crosswalk as its file has it: missing keys, targets outside the vocabularies, bias axes without an answer."""
    source, out = said.get("source", {}), []
    out += [f"source.{k} is missing" for k in ("id", "name", "url", "license", "bias_label") if k not in source]
    answers = source.get("bias_profile", {})
    out += [f"bias axis {a} is not known" for a in sorted(set(answers) - set(BIAS_AXES))]
    out += [f"bias axis {a} is not answered" for a in BIAS_AXES if len(str(answers.get(a, "")).strip()) < LEAST_ANSWER]
    for part, known, default in (("hazard_type", X.HAZARDS, "other"), ("severity", X.SEVERITIES, "near_miss")):
        rules = said.get(part, {})
        targets = [rules.get("default", default), *(r["value"] for r in rules.get("rules", []))]
        out += [f"{part}: {t} is not known" for t in sorted({t for t in targets if t not in known})]
    return out


def apply_crosswalk(rows: DataFrame, said: dict, hazard: str, severity: str) -> DataFrame:
    """Adds hazard_type and severity by a crosswalk's rules, and its source's id and label of bias; raises if the crosswalk is not valid."""
    problems = crosswalk_problems(said)
    if problems:
        raise ValueError("; ".join(problems))
    spark = rows.sparkSession

    def mapped(frame: DataFrame, part: str, key: str, column: str, default: str, exact: bool) -> DataFrame:
        told = said.get(part, {})
        rules = spark.createDataFrame([(i, r[key], r["value"]) for i, r in enumerate(told.get("rules", []))], "priority int, pattern string, target string")
        return crosswalk_lookup(frame, rules, column, told.get("default", default), exact).withColumnRenamed("mapped", f"__{part}")

    out = mapped(mapped(rows, "hazard_type", "when", hazard, "other", True), "severity", "contains", severity, "near_miss", False)
    out = out.withColumns({"hazard_type": F.col("__hazard_type"), "severity": F.col("__severity"), "source_id": F.lit(said["source"]["id"]), "bias_label": F.lit(said["source"]["bias_label"])})
    return out.drop("__hazard_type", "__severity")


def crosswalk_lookup(rows: DataFrame, rules: DataFrame, value: str, default: str, exact: bool = False) -> DataFrame:
    """Adds mapped: the target of the first rule (priority, pattern, target) that the value meets.

    A value meets a rule of severity if it contains the pattern in any case of letters, one of hazards (`exact`) if it equals the
    pattern. A missing or empty value gets the default. Each different value is looked up once: exact rules by a join on the
    value, others against the rules, which are broadcast if they are few; the answers are joined back.
    """
    told = rules.select(F.col("priority").alias("__priority"), F.col("pattern").alias("__pattern"), F.col("target").alias("__target"))
    values = rows.select(F.col(value).alias("__value")).where("__value <> ''").distinct()
    meets = F.col("__value") == F.col("__pattern") if exact else F.contains(F.lower("__value"), F.lower("__pattern"))
    first = values.join(bounded_broadcast(told), meets).groupBy("__value").agg(F.min_by("__target", F.struct("__priority", "__pattern")).alias("__mapped"))
    return rows.join(first, F.col(value) == F.col("__value"), "left").withColumn("mapped", F.coalesce("__mapped", F.lit(default))).drop("__value", "__mapped")
