"""Crash records: row validation, header-line join, mode roll-ups, dense suppressed cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spatial import bounded_broadcast

#: Involved modes in their order.
MODE_ORDER = ("motor_vehicle_occupant", "motorcyclist", "pedalcyclist", "pedestrian", "other_road_user", "unknown")
#: Latitudes that stand for an unknown position, and person types allowed and of other road users by coding period.
UNKNOWN_LATITUDES = (77.7777, 88.8888, 99.9999)
PERSON_TYPES = {
    "legacy": ((*range(1, 14), 19), (4, 8, 10, 11, 12, 13)),
    "2020-2021": ((1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13), (4, 10, 11, 12, 13)),
    "2022-2024": ((*range(1, 11), 19), (4, 8, 10)),
}
SUPPRESSED = "suppressed_or_zero"


def whole_number(text: Column) -> Column:
    return F.when(text.rlike(r"^[+]?[0-9]+$"), text.try_cast("long"))


def map_rows(accidents: DataFrame) -> DataFrame:
    """Adds reason: the first of invalid_identity, invalid_date, invalid_location, invalid_fatality_count, or null.

    Rows of text columns ST_CASE, YEAR, MONTH, DAY, HOUR, MINUTE, LATITUDE, LONGITUD, FATALS. Adds
    occurred_on, local_time (null if there is none), lat, lon and fatality_count too.
    """
    number = {c: whole_number(F.col(c)) for c in ("ST_CASE", "YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "FATALS")}
    part = lambda c, n: F.lpad(number[c].cast("string"), n, "0")
    date = F.try_to_timestamp(F.concat(part("YEAR", 4), F.lit("-"), part("MONTH", 2), F.lit("-"), part("DAY", 2)), F.lit("yyyy-MM-dd"))
    lat, lon = F.col("LATITUDE").try_cast("double"), F.col("LONGITUD").try_cast("double")
    bad_place = lat.isNull() | lon.isNull() | ~lat.between(-90, 90) | ~lon.between(-180, 180)
    for value in UNKNOWN_LATITUDES:
        bad_place = bad_place | (F.abs(lat - value) < 1e-4)
    bad = lambda c, least: F.coalesce(number[c] < least, F.lit(True))
    reason = (
        F.when(bad("ST_CASE", 1) | bad("YEAR", 1975), "invalid_identity")
        .when(date.isNull(), "invalid_date")
        .when(bad_place, "invalid_location")
        .when(bad("FATALS", 1), "invalid_fatality_count")
    )
    time = F.when(number["HOUR"].between(0, 23) & number["MINUTE"].between(0, 59), F.concat(part("HOUR", 2), F.lit(":"), part("MINUTE", 2)))
    return accidents.withColumns(
        {"reason": reason, "occurred_on": F.date_format(date, "yyyy-MM-dd"), "local_time": time, "lat": lat, "lon": lon, "fatality_count": number["FATALS"]}
    )


def drop_all_duplicates(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): every member of a group of equal keys is rejected."""
    counted = rows.withColumn("__n", F.count("*").over(Window.partitionBy(key)))
    return counted.where("__n = 1").drop("__n"), counted.where("__n > 1").drop("__n")


def reject_accounting(rows: DataFrame, reason: str = "reason") -> DataFrame:
    """(reason, n) of rejected rows."""
    return rows.where(F.col(reason).isNotNull()).groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))


def mode_code(person_type: Column, body_type: Column, period: str) -> Column:
    """Involved mode of a person by type of person and body, as that period codes them; null for an invalid code."""
    allowed, others = PERSON_TYPES[period]
    body = F.coalesce(body_type, F.lit(99))
    return F.when(
        person_type.isin(*allowed),
        F.when(person_type == 5, "pedestrian")
        .when(person_type.isin(6, 7), "pedalcyclist")
        .when(person_type.isin(*others), "other_road_user")
        .when((person_type == 19) | body.isin(98, 99), "unknown")
        .when(body.between(80, 89), "motorcyclist")
        .when(body.between(1, 97), "motor_vehicle_occupant"),
    )


def county_status(code: Column) -> Column:
    """Whether a three-digit county code names a county, or why not."""
    known = {"000": "not_applicable", "997": "other", "998": "not_reported", "999": "unknown"}
    out = F.when(code.isNull(), "unknown")
    for value, status in known.items():
        out = out.when(code == value, status)
    return out.otherwise("reported")


def join_violations(headers: DataFrame, lines: DataFrame, key: str, line_key: str, declared: str, fatal: Column) -> DataFrame:
    """(violation, key): why a header-line batch can't be joined; no row means that it can.

    duplicate_header, duplicate_line, orphan_line, header_without_lines, and fatal_mismatch
    where the declared number differs from that of fatal lines.
    """
    k = F.col(key)
    per_header = headers.groupBy(key).agg(F.count("*").alias("n"), F.max(declared).alias("declared"))
    per_line = lines.groupBy(key, line_key).agg(F.count("*").alias("n"), F.max(fatal.cast("int")).alias("fatal"))
    per_case = per_line.groupBy(key).agg(F.max("n").alias("most"), F.sum("fatal").alias("fatal"), F.count("*").alias("lines"))
    both = per_header.join(per_case, key, "full_outer")
    checks = {
        "duplicate_header": F.col("n") > 1,
        "duplicate_line": F.col("most") > 1,
        "orphan_line": F.col("n").isNull(),
        "header_without_lines": F.col("lines").isNull(),
        "fatal_mismatch": F.col("n").isNotNull() & F.col("lines").isNotNull() & ~F.col("declared").eqNullSafe(F.col("fatal")),
    }
    said = F.explode(F.array_compact(F.array(*(F.when(c, name) for name, c in checks.items()))))
    return both.select(said.alias("violation"), k.alias("key"))


def reconciled(headers: DataFrame, lines: DataFrame, key: str, line_key: str, declared: str, fatal: Column) -> DataFrame:
    """The lines with their headers; raises if anything is wrong with any of them."""
    wrong = join_violations(headers, lines, key, line_key, declared, fatal).limit(5).collect()
    if wrong:
        raise ValueError("the batch does not reconcile: " + ", ".join(f"{r.violation} {r.key}" for r in wrong))
    return lines.join(headers, key)


def mode_rollup(lines: DataFrame, key: str, mode: str, fatal: Column, order: tuple[str, ...] = MODE_ORDER) -> DataFrame:
    """Per case, involved and fatal counts of each mode, as columns <mode>_involved and <mode>_fatal."""
    sums = []
    for m in order:
        sums += [F.count_if(F.col(mode) == m).alias(f"{m}_involved"), F.count_if((F.col(mode) == m) & fatal).alias(f"{m}_fatal")]
    return lines.groupBy(key).agg(*sums)


def mode_cells(lines: DataFrame, geography: str, key: str, mode: str) -> DataFrame:
    """(geography, mode, cases): cases that involve a mode, each once for each mode."""
    return lines.select(geography, key, mode).distinct().groupBy(geography, mode).agg(F.count("*").alias("cases"))


def suppress(cells: DataFrame, count: str, k: int) -> DataFrame:
    """Adds status, and nulls the count of cells under max(5, k)."""
    fit = F.col(count) >= max(5, k)
    return cells.withColumns({"status": F.when(fit, "published").otherwise(SUPPRESSED), count: F.when(fit, F.col(count))})


def dense_cells(geographies: DataFrame, modes: DataFrame, cells: DataFrame, geography: str, mode: str, count: str = "cases", k: int = 10) -> DataFrame:
    """Every geography with every mode; a missing or small cell is suppressed_or_zero and has no count."""
    every = geographies.select(geography).distinct().crossJoin(bounded_broadcast(modes.select(mode).distinct()))
    joined = every.join(cells.select(geography, mode, count), [geography, mode], "left")
    fit = F.coalesce(F.col(count) >= k, F.lit(False))
    return joined.select(geography, mode, F.when(fit, "published").otherwise(SUPPRESSED).alias("status"), F.when(fit, F.col(count)).alias(count))


def cell_accounting(cells: DataFrame, count: str, k: int) -> DataFrame:
    """One row: cells and contributions, published and suppressed."""
    fit = F.col(count) >= max(5, k)
    return cells.agg(
        F.count("*").alias("cells"), F.count_if(fit).alias("published_cells"),
        F.sum(count).alias("contributions"), F.coalesce(F.sum(F.when(~fit, F.col(count))), F.lit(0)).alias("suppressed_contributions"),
    )


def grouping_totals(rows: DataFrame, geography: str, county: str, mode: str, key: str) -> DataFrame:
    """Cases by (state, county, mode), by (state, mode) and by mode; level says which.

    Rows of a case and mode are put in order of place once. The first of them counts for the mode, the first of each state for
    the state, the first of each county for the county; so no level holds or sends its own sets of cases.
    """
    one = Window.partitionBy(key, mode).orderBy(geography, county)
    before = F.lag(F.struct(geography, county)).over(one)
    first = F.row_number().over(one) == 1
    known = rows.where(F.col(mode).isNotNull()).select(geography, county, mode, key)
    marked = known.select(
        geography, county, mode, key, first.alias("__mode"), (first | ~before[geography].eqNullSafe(F.col(geography))).alias("__state"),
        (first | ~before.eqNullSafe(F.struct(geography, county))).alias("__county"),
    )
    # Rows without a case make their group known but count for nothing.
    counts = marked.groupBy(mode, geography, county).agg(*(F.count_if(F.col(c) & F.col(key).isNotNull()).alias(c) for c in ("__mode", "__state", "__county")))
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    told = F.array(
        F.struct(F.col(geography), F.col(county), F.lit(0).cast("long").alias("level"), F.col("__county").alias("cases")),
        F.struct(F.col(geography), none(county), F.lit(1).cast("long").alias("level"), F.col("__state").alias("cases")),
        F.struct(none(geography), none(county), F.lit(3).cast("long").alias("level"), F.col("__mode").alias("cases")),
    )
    levels = counts.select(mode, F.explode(told).alias("x")).select(mode, "x.*")
    return levels.groupBy(mode, geography, county, "level").agg(F.sum("cases").alias("cases")).select(mode, geography, county, "cases", "level")


def county_cells(rows: DataFrame, geography: str, county: str, mode: str, key: str) -> DataFrame:
    """(kind, state, cell, mode, cases): reported counties, what stands for one by its status, and totals of the state.

    Each case counts once for each mode; county codes have three digits. Counties and
    sentinels of a state and mode add up to its total.
    """
    status = county_status(F.col(county))
    cell = F.when(status == "reported", F.col(county)).otherwise(status)
    one = rows.select(F.col(geography).alias("state"), F.when(status == "reported", "county").otherwise("sentinel").alias("kind"), cell.alias("cell"), F.col(mode).alias("mode"), F.col(key).alias("key")).distinct()
    cells = one.groupBy("kind", "state", "cell", "mode").agg(F.count("*").alias("cases"))
    totals = one.select("state", "mode", "key").distinct().groupBy("state", "mode").agg(F.count("*").alias("cases"))
    return cells.unionByName(totals.select(F.lit("total").alias("kind"), "state", F.lit(None).cast("string").alias("cell"), "mode", "cases"))


def unreconciled(cells: DataFrame) -> DataFrame:
    """(state, mode, parts, cases) where the counties and sentinels of `county_cells` do not add up to the total."""
    parts = cells.where("kind <> 'total'").groupBy("state", "mode").agg(F.sum("cases").alias("parts"))
    both = cells.where("kind = 'total'").select("state", "mode", "cases").join(parts, ["state", "mode"], "full_outer")
    return both.where(~F.col("cases").eqNullSafe(F.col("parts"))).select("state", "mode", "parts", "cases")


def project_counties(cells: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """`county_cells` with counties under the crosswalk's geoid (state, cell, geoid); sentinels and totals stay as they are.

    Raises if a county has no geoid, or if the parts no longer add up to the totals.
    """
    counties = cells.where("kind = 'county'")
    told = project_cells(counties.select("state", "cell", "mode", "cases"), crosswalk.select("state", "cell", F.struct("state", "geoid").alias("to")), ["state", "cell"], "to", "mode", "cases")
    out = told.select(F.lit("county").alias("kind"), "to.state", F.col("to.geoid").alias("cell"), "mode", "cases").unionByName(cells.where("kind <> 'county'").select("kind", "state", "cell", "mode", "cases"))
    if not unreconciled(out).isEmpty():
        raise ValueError("projected counties do not add up to their states")
    return out


def project_cells(cells: DataFrame, crosswalk: DataFrame, on: list[str], target: str, mode: str, count: str) -> DataFrame:
    """Cells counted again under the crosswalk's target ids; raises if a cell has no target."""
    missing = cells.join(crosswalk, on, "left_anti")
    if not missing.isEmpty():
        raise ValueError("cells without a crosswalk target")
    return cells.join(crosswalk, on).groupBy(target, mode).agg(F.sum(count).alias(count))


def unequal_rows(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the left side for which the right has none that is equal in all columns, nulls included."""
    same = reduce(lambda a, c: a & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), columns, F.lit(True))
    return left.alias("a").join(right.alias("b"), same, "left_anti")


def segment_time_cells(snapped: DataFrame, k: int = 5) -> DataFrame:
    """(segment_id, part, mode, cases) of at least max(5, k) cases; no mode known is unknown_mode."""
    modes = F.when(F.size("modes") > 0, F.col("modes")).otherwise(F.array(F.lit("unknown_mode")))
    return (
        snapped.where("segment_id is not null")
        .select("segment_id", "part", "case_id", F.explode(F.array_distinct(modes)).alias("mode"))
        .groupBy("segment_id", "part", "mode")
        .agg(F.count_distinct("case_id").alias("cases"))
        .where(F.col("cases") >= max(5, k))
    )


def regressions(totals: DataFrame, series: str, revision: str, total: str) -> DataFrame:
    """Revisions whose total is under that of the one before, unless allowed."""
    before = F.lag(total).over(Window.partitionBy(series).orderBy(revision))
    return totals.withColumn("before", before).where((F.col(total) < F.col("before")) & ~F.coalesce("allowed", F.lit(False)))
