"""Annual releases: pinned contracts, indexes, corrections, artifacts and their accounting."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contract_violations(contracts: DataFrame) -> DataFrame:
    """(year, revision, violation) of annual contracts (year, revision, digest, previous, stage).

    Revisions of a year count from 1 without gap, each names the digest of the one before, and
    the stage never falls.
    """
    w = Window.partitionBy("year").orderBy("revision")
    seen = contracts.withColumns({"at": F.row_number().over(w), "before": F.lag("digest").over(w), "was": F.lag("stage").over(w)})
    rules = {
        "gap": F.col("revision") != F.col("at"),
        "predecessor": ~F.col("previous").eqNullSafe(F.col("before")),
        "stage": F.coalesce(F.col("stage") < F.col("was"), F.lit(False)),
    }
    return seen.select("year", "revision", F.explode(F.array_compact(F.array(*(F.when(b, n) for n, b in rules.items())))).alias("violation"))


def release_index(artifacts: DataFrame) -> DataFrame:
    """(name, bytes, sha256) of artifacts (name, content), in order of name."""
    return artifacts.select("name", F.octet_length("content").cast("long").alias("bytes"), F.sha2(F.col("content").cast("binary"), 256).alias("sha256")).orderBy("name")


def index_mismatch(index: DataFrame, inventory: DataFrame) -> DataFrame:
    """(name, problem): missing, unlisted or changed files between an index and what is there."""
    a = index.select("name", F.col("bytes").alias("b1"), F.col("sha256").alias("s1"))
    b = inventory.select("name", F.col("bytes").alias("b2"), F.col("sha256").alias("s2"))
    problem = F.when(F.col("s2").isNull(), "missing").when(F.col("s1").isNull(), "unlisted").when((F.col("b1") != F.col("b2")) | (F.col("s1") != F.col("s2")), "changed")
    return a.join(b, "name", "full_outer").select("name", problem.alias("problem")).where("problem is not null")


def state_shards(rows: DataFrame, state: str, order: list[str]) -> DataFrame:
    """(state, features, content, bytes, sha256): the rows of each state as one JSON list, in order; what is public of them is in the columns."""
    said = F.to_json(F.struct(*(c for c in rows.columns if c != state)))
    lists = rows.groupBy(F.col(state).alias("state")).agg(F.array_sort(F.collect_list(F.struct(*order, said.alias("__json")))).alias("x"))
    content = F.concat(F.lit("["), F.array_join(F.transform("x", lambda r: r["__json"]), ","), F.lit("]\n"))
    return lists.select("state", F.size("x").alias("features"), content.alias("content")).withColumns({"bytes": F.octet_length("content").cast("long"), "sha256": F.sha2(F.col("content").cast("binary"), 256)})


def county_release_index(values: DataFrame, boundaries: DataFrame, states: DataFrame) -> DataFrame:
    """(state, value_bytes, value_sha256, boundary_bytes, boundary_sha256, problem) of the shards that every state needs.

    The problem is missing_values, missing_boundaries or unlisted_state, null if there is none.
    """
    side = lambda frame, name: frame.select("state", F.col("bytes").alias(f"{name}_bytes"), F.col("sha256").alias(f"{name}_sha256"))
    both = side(values, "value").join(side(boundaries, "boundary"), "state", "full_outer")
    every = states.select("state", F.lit(True).alias("__listed")).join(both, "state", "full_outer")
    problem = F.when(F.col("__listed").isNull(), "unlisted_state").when(F.col("value_sha256").isNull(), "missing_values").when(F.col("boundary_sha256").isNull(), "missing_boundaries")
    return every.withColumn("problem", problem).drop("__listed")


def outcome_problems(outcomes: DataFrame, key: str) -> DataFrame:
    """(key, problem) of normalised outcomes (key, occurred_on, state_code, lat, lon, fatality_count): what keeps them out of an artifact."""
    repeated = outcomes.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.lit("repeated").alias("problem"))
    rules = {
        "no identity": F.col(key).isNull(),
        "no date": ~F.coalesce(F.col("occurred_on").rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(F.col("occurred_on"), F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False)),
        "no state": F.col("state_code").isNull(),
        "place out of range": ~(F.coalesce(F.col("lat").between(-90, 90), F.lit(True)) & F.coalesce(F.col("lon").between(-180, 180), F.lit(True))) | (F.col("lat").isNull() != F.col("lon").isNull()),
        "no fatality": ~F.coalesce(F.col("fatality_count") >= 1, F.lit(False)),
    }
    found = outcomes.select(key, F.explode(F.array_compact(F.array(*(F.when(b, n) for n, b in rules.items())))).alias("problem"))
    return found.unionByName(repeated)


def joined_records(outcomes: DataFrame, summaries: DataFrame, jurisdictions: DataFrame, key: str, year: int) -> DataFrame:
    """One record per case of the contract's year: structs outcome, summary and jurisdiction, the rest under no key.

    Raises if a case is not in each of the three exactly once, lies in another year, or is told in two states.
    """
    frames = {"outcome": outcomes, "summary": summaries, "jurisdiction": jurisdictions}
    counts = None
    for name, frame in frames.items():
        one = frame.groupBy(key).agg(F.count("*").alias(name))
        counts = one if counts is None else counts.join(one, key, "full_outer")
    if not counts.where(" or ".join(f"coalesce({n}, 0) <> 1" for n in frames)).isEmpty():
        raise ValueError("a case is not in each part exactly once")
    parts = [f.select(key, F.struct(*(c for c in f.columns if c != key)).alias(n)) for n, f in frames.items()]
    out = parts[0].join(parts[1], key).join(parts[2], key)
    if not out.where((F.col("outcome.year") != year) | (F.col("outcome.state") != F.col("jurisdiction.state"))).isEmpty():
        raise ValueError("a case lies in another year, or in two states")
    return out


def correction_ledger(old: DataFrame, new: DataFrame, key: str, free: tuple[str, ...]) -> DataFrame:
    """(key, field, before, after) of changed fields; raises if a field other than the `free` ones changed."""
    fields = [c for c in old.columns if c != key]
    said = lambda f, side: F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias(side)) for c in fields))
    a = old.select(key, F.explode(said(old, "before")).alias("x")).select(key, "x.*")
    b = new.select(key, F.explode(said(new, "after")).alias("x")).select(key, "x.*")
    changed = a.join(b, [key, "field"]).where(~F.col("before").eqNullSafe(F.col("after")))
    if not changed.where(~F.col("field").isin(*free)).isEmpty():
        raise ValueError("a correction may only change " + ", ".join(free))
    return changed


def public_county_cells(counties: DataFrame, modes: DataFrame, cells: DataFrame, k: int = 10) -> DataFrame:
    """Dense county cells; k must be from 10 to 10,000."""
    from .crash import dense_cells

    if not 10 <= k <= 10_000:
        raise ValueError("k must be from 10 to 10,000")
    return dense_cells(counties, modes, cells, "geoid", "mode", k=k)


def crosswalk_problems(crosswalk: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """(problem, n): duplicate, unresolved (null target), missing and surplus keys of a crosswalk."""
    keys = crosswalk.groupBy(*on).agg(F.count("*").alias("n"), F.count("geoid").alias("known"))
    parts = [
        keys.where("n > 1").agg(F.lit("duplicate").alias("problem"), F.count("*").alias("n")),
        keys.where("known = 0").agg(F.lit("unresolved").alias("problem"), F.count("*").alias("n")),
        wanted.select(*on).distinct().join(keys, on, "left_anti").agg(F.lit("missing").alias("problem"), F.count("*").alias("n")),
        keys.join(wanted.select(*on).distinct(), on, "left_anti").agg(F.lit("surplus").alias("problem"), F.count("*").alias("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def artifact_accounting(outcomes: DataFrame, summaries: DataFrame, key: str) -> DataFrame:
    """One row: outcomes, summaries, outcomes without summary, summaries without outcome, fatalities that differ."""
    a = outcomes.select(key, F.col("fatality_count").alias("f1"), F.lit(True).alias("a"))
    b = summaries.select(key, F.col("fatalities").alias("f2"), F.lit(True).alias("b"))
    both = a.join(b, key, "full_outer")
    one = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return both.agg(
        one(F.col("a")).alias("outcomes"), one(F.col("b")).alias("summaries"), one(F.col("a") & F.col("b").isNull()).alias("without_summary"),
        one(F.col("b") & F.col("a").isNull()).alias("without_outcome"), one(F.col("f1") != F.col("f2")).alias("fatality_mismatch"),
    )


def sensitivity_grid(reports: DataFrame, segments: DataFrame, plane, snaps: tuple[float, ...], windows: tuple[int, ...], distances: tuple[float, ...]) -> DataFrame:
    """(snap_max, window_s, distance_m, kept, snapped): the pipeline's counts under each setting.

    Reports are snapped once, within the greatest distance, and patches of reports that can repeat each other are found
    once, for the greatest distance; each is settled under every window and distance. All settings are counted in one pass over the reports.
    """
    from .dedupe import removed_by_setting
    from .shared import kept
    from .spatial import snap_nearest

    # A file of few row groups would be snapped by as few tasks.
    rows = kept(snap_nearest(reports.repartition("report_id"), segments, plane, max(snaps)).select("report_id", "snapped_distance_m"))
    settings = [(w, d) for w in windows for d in distances]
    gone = removed_by_setting(reports, plane, settings)
    each = F.array(*(F.struct(F.lit(w).alias("window_s"), F.lit(d).alias("distance_m")) for w, d in settings))
    asked = rows.select("report_id", "snapped_distance_m", F.explode(each).alias("x")).select("report_id", "snapped_distance_m", "x.*")
    left = asked.join(gone, ["report_id", "window_s", "distance_m"], "left_anti")
    counts = left.groupBy("window_s", "distance_m").agg(F.count("*").alias("kept"), *(F.count_if(F.col("snapped_distance_m") <= s).alias(f"within_{i}") for i, s in enumerate(snaps)))
    every = reports.sparkSession.createDataFrame(settings, "window_s int, distance_m double")
    counts = every.join(counts, ["window_s", "distance_m"], "left").na.fill(0, ["kept", *(f"within_{i}" for i in range(len(snaps)))])
    told = F.array(*(F.struct(F.lit(s).alias("snap_max"), F.col(f"within_{i}").alias("snapped")) for i, s in enumerate(snaps)))
    return counts.select("window_s", "distance_m", "kept", F.explode(told).alias("s")).select("s.snap_max", "window_s", "distance_m", "kept", "s.snapped")


#: What a tier of evidence allows to be said.
CLAIMS = {
    0: ("where reports were made", "any rate or ranking"),
    1: ("counts of reports by place", "rates; comparisons of places"),
    2: ("rates where exposure is known, with their intervals", "a ranking of all places"),
    3: ("rates and hot spots with their intervals", "causes; predictions for single places"),
}


def claims(tiers: DataFrame) -> DataFrame:
    """Adds allowed and forbidden by tier."""
    pick = lambda i: F.create_map(*(F.lit(x) for t, said in CLAIMS.items() for x in (t, said[i])))[F.col("tier")]
    return tiers.withColumns({"allowed": pick(0), "forbidden": pick(1)})


def symbology_violations(layer: DataFrame, k: int = 3) -> DataFrame:
    """(segment_id, violation) of a published layer: a colour without rate, a rate without interval, a small cell, a label that claims more."""
    c = F.col
    rules = {
        "class_without_rate": c("class").isNotNull() & c("rate").isNull(),
        "rate_without_interval": c("rate").isNotNull() & (c("rate_ci_low").isNull() | c("rate_ci_high").isNull()),
        "small_cell": (c("n") > 0) & (c("n") < k),
        "label": (c("confidence_label") == "certain") & c("rate").isNull(),
    }
    return layer.select("segment_id", F.explode(F.array_compact(F.array(*(F.when(b, n) for n, b in rules.items())))).alias("violation"))


# ---------------------------------------------------------------- files of the driver


def write_pinned(path: str, value: dict) -> str:
    """Canonical JSON with a SHA-256 beside it; returns the digest."""
    from ..sources.sinks import canonical_json

    data = canonical_json(value)
    digest = hashlib.sha256(data).hexdigest()
    for name, content in ((path, data), (path + ".sha256", (digest + "\n").encode())):
        Path(name + ".new").write_bytes(content)
        os.replace(name + ".new", name)
    return digest


def read_pinned(path: str) -> dict:
    """The value, if its bytes still have the digest beside them."""
    data = Path(path).read_bytes()
    if hashlib.sha256(data).hexdigest() != Path(path + ".sha256").read_text().strip():
        raise ValueError(f"{path} is not what was pinned")
    return json.loads(data)


def ingest_once(root: str, raw: bytes, normalize) -> dict:
    """Store raw bytes and what `normalize` makes of them under their digests, then a receipt.

    The receipt is written last, by one rename; the same bytes again give the same receipt and
    store nothing. A failure leaves no receipt.
    """
    digest = hashlib.sha256(raw).hexdigest()
    receipt = Path(root, "receipts", f"{digest}.json")
    if receipt.exists():
        return json.loads(receipt.read_text())
    made = normalize(raw)
    out = {"raw": digest, "normalized": hashlib.sha256(made).hexdigest()}
    for kind, name, content in (("raw", out["raw"], raw), ("normalized", out["normalized"], made), ("receipts", f"{digest}.json", json.dumps(out, sort_keys=True).encode())):
        folder = Path(root, kind)
        folder.mkdir(parents=True, exist_ok=True)
        own = folder / f".{uuid.uuid4().hex}"
        own.write_bytes(content)
        os.replace(own, folder / name)
    return out


def replay(root: str, normalize) -> list[str]:
    """Digests of receipts whose raw bytes no longer give the normalized ones."""
    wrong = []
    for path in sorted(Path(root, "receipts").glob("*.json")):
        said = json.loads(path.read_text())
        raw = Path(root, "raw", said["raw"]).read_bytes()
        if hashlib.sha256(raw).hexdigest() != said["raw"] or hashlib.sha256(normalize(raw)).hexdigest() != said["normalized"]:
            wrong.append(said["raw"])
    return wrong
