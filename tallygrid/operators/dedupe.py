"""Spatio-temporal deduplication: a report goes if it repeats an earlier one that stays."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .network import component_roots, kept
from .shared import bounded_broadcast


#: Steps to cells of (time, x, y) that come after one's own, so that two neighbouring cells meet once.
AHEAD = [(t, x, y) for t in (0, 1) for x in (-1, 0, 1) for y in (-1, 0, 1) if (t, x, y) >= (0, 0, 0)]


def duplicate_pairs(reports: DataFrame, plane: geo.Plane, distance_m: float = 15.0, window_s: int = 600) -> DataFrame:
    """(a, b, a_epoch, b_epoch, d): reports that are duplicates of each other, a before b in order of (epoch, id), d metres apart.

    Within the distance and the time window, and of one reporter if both have a token, else of
    one hazard and mode. Candidates share the token, or hazard and mode, and a cell of space
    and time; one side is sent to its own cell and those that come after it. Rows need
    report_id, lat, lon, epoch, reporter_token, hazard_type, mode.
    """
    size = max(1.0, distance_m + geo.margin(distance_m))
    token = F.nullif("reporter_token", F.lit(""))
    named = lambda kind, *c: F.when(F.concat(*c).isNotNull(), F.struct(F.lit(kind).alias("kind"), F.concat_ws("\x1f", *c).alias("key")))
    base = reports.where("epoch is not null").select(
        F.struct("epoch", "report_id", "lat", "lon", token.isNotNull().alias("told")).alias("r"),
        F.explode(F.array_compact(F.array(named("token", token), named("kind", F.col("hazard_type"), F.col("mode"))))).alias("k"),
        geo.cell(plane.x(F.col("lon")), size).alias("cx"), geo.cell(plane.y(F.col("lat")), size).alias("cy"),
        F.floor(F.col("epoch") / max(1, window_s)).alias("ct"),
    ).select("r", "k.kind", "k.key", "cx", "cy", "ct")
    steps = F.array(*(F.struct((F.col("ct") + t).alias("ct"), (F.col("cx") + x).alias("cx"), (F.col("cy") + y).alias("cy"), F.lit((t, x, y) == (0, 0, 0)).alias("own")) for t, x, y in AHEAD))
    ahead = base.select(F.col("r").alias("s"), "kind", "key", F.explode(steps).alias("c")).select("s", "kind", "key", "c.ct", "c.cx", "c.cy", "c.own")
    near = base.join(ahead, ["kind", "key", "ct", "cx", "cy"])
    order = lambda c: F.struct(F.col(f"{c}.epoch"), F.col(f"{c}.report_id"))
    first, last = F.when(order("r") < order("s"), F.col("r")).otherwise(F.col("s")), F.when(order("r") < order("s"), F.col("s")).otherwise(F.col("r"))
    # In one cell both orders meet; two reports with a token count by it alone.
    met = near.where((~F.col("own") | (order("r") < order("s"))) & ((F.col("kind") == "token") | ~(F.col("r.told") & F.col("s.told"))))
    pairs = met.select(first.alias("a"), last.alias("b")).where(F.col("b.epoch") - F.col("a.epoch") <= window_s)
    far = geo.haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    return pairs.withColumn("d", far).where(F.col("d") <= distance_m).select(
        F.col("a.report_id").alias("a"), F.col("b.report_id").alias("b"), F.col("a.epoch").alias("a_epoch"), F.col("b.epoch").alias("b_epoch"), "d"
    )


#: Duplicate pairs up to which one task settles them all.
FEW_PAIRS = 100_000


def removed_reports(pairs: DataFrame, most_rounds: int = 12, few: int = FEW_PAIRS) -> DataFrame:
    """(report_id) of the reports that go, from duplicate pairs (a, b, a_epoch, b_epoch), a before b.

    Greedy in order of time: a row stays once all its earlier duplicates are gone, and all
    later duplicates of a row that stays go. A counted, small number of pairs is settled in one
    task. Beyond, each round settles in parallel every row whose earlier duplicates are
    settled, until few pairs are left. What `most_rounds` rounds leave are long chains: each
    set of connected rows is then settled in one pass in order of time.
    """
    edges = kept(pairs.select("a", "b", "a_epoch", "b_epoch").distinct())
    gone = edges.select(F.col("b").alias("report_id")).where("false")
    n = edges.limit(few + 1).count()
    if n == 0:
        return gone
    if n <= few:
        return _settled_at_once(edges)
    live = edges
    for _ in range(most_rounds):
        n = live.limit(few + 1).count()
        if n == 0:
            return gone
        if n <= few:
            return gone.unionByName(_settled_at_once(live))
        later = live.select(F.col("b").alias("a")).distinct()
        stay = live.select("a").distinct().join(later, "a", "left_anti")
        dead = kept(live.join(stay, "a", "left_semi").select(F.col("b").alias("report_id")).distinct())
        gone = kept(gone.unionByName(dead))
        live = kept(
            live.join(dead.select(F.col("report_id").alias("b")), "b", "left_anti")
            .join(dead.select(F.col("report_id").alias("a")), "a", "left_anti")
            .select("a", "b", "a_epoch", "b_epoch")
        )
    nodes = live.select(F.col("a").alias("node")).union(live.select("b")).distinct()
    roots = component_roots(nodes, live.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return gone.unionByName(_settled_at_once(live.join(roots.withColumnRenamed("node", "a"), "a"), "root"))


def _settled_at_once(edges: DataFrame, by: str | None = None) -> DataFrame:
    """The rows that go, in one task for all pairs, or for those of each value of a column."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        earlier: dict = {}
        when: dict = {}
        for a, b, ta, tb in rows[["a", "b", "a_epoch", "b_epoch"]].itertuples(index=False):
            earlier.setdefault(b, []).append(a)
            when[a], when[b] = (ta, a), (tb, b)
        gone = set()
        for r in sorted(earlier, key=when.get):
            if any(e not in gone for e in earlier[r]):
                gone.add(r)
        return pd.DataFrame({"report_id": pd.Series(list(gone), dtype=rows["b"].dtype)})

    kind = edges.schema["b"].dataType.simpleString()
    groups = edges.groupBy(by) if by else edges.withColumn("all", F.lit("all")).groupBy("all")
    return groups.applyInPandas(settle, f"report_id {kind}")


#: Reports of a connected patch of the plane up to which one task settles them without pairs.
PATCH = 1_000_000


def removed_by_setting(reports: DataFrame, plane: geo.Plane, settings: list[tuple[int, float]], most: int = PATCH) -> DataFrame:
    """(report_id, window_s, distance_m) of the reports that go under each window and distance.

    Reports repeat each other within a patch of cells that touch only. A patch of no more than `most` reports is settled in order of
    time in one pass, each report held against those that stay, so that pairs of copies are never listed. Reports of greater
    patches are paired and settled by rounds.
    """
    from ..streaming.dedupe import Held, settle

    widest = max(d for _, d in settings)
    size = max(1.0, widest + geo.margin(widest))
    key = lambda x, y: (x * (1 << 31) + y).cast("long")
    kind = F.when(F.col("hazard_type").isNotNull() & F.col("mode").isNotNull(), F.concat_ws("\x1f", "hazard_type", "mode"))
    at = {"cx": geo.cell(plane.x(F.col("lon")), size), "cy": geo.cell(plane.y(F.col("lat")), size)}
    rows = reports.where("epoch is not null and lat is not null and lon is not null").withColumns(at)
    cells = kept(rows.groupBy("cx", "cy").agg(F.count("*").alias("c")))
    steps = F.array(*(F.struct((F.col("cx") + x).alias("cx"), (F.col("cy") + y).alias("cy")) for x, y in ((0, 1), (1, -1), (1, 0), (1, 1))))
    ahead = cells.select(key(F.col("cx"), F.col("cy")).alias("u"), F.explode(steps).alias("s")).select("u", "s.cx", "s.cy")
    touching = ahead.join(cells, ["cx", "cy"]).select("u", key(F.col("cx"), F.col("cy")).alias("v"))
    named = cells.select("cx", "cy", "c", key(F.col("cx"), F.col("cy")).alias("node"))
    patches = named.join(component_roots(named.select("node"), touching), "node")
    sizes = patches.groupBy("root").agg((F.sum("c") <= most).alias("few"))
    patches = kept(patches.join(sizes, "root").select("cx", "cy", "root", "few"))
    placed = rows.join(bounded_broadcast(patches), ["cx", "cy"])

    def settled(found: pd.DataFrame) -> pd.DataFrame:
        held = [Held(*r, True, float("inf")) for r in zip(*(found[c].tolist() for c in Held._fields[:6]))]
        parts = []
        for w, d in settings:
            gone = [r.report_id for r in settle(held, [], d, w, twins=False) if not r.stays]
            parts.append(pd.DataFrame({"report_id": pd.Series(gone, dtype=found["report_id"].dtype), "window_s": w, "distance_m": d}))
        return pd.concat(parts)

    named = placed.where("few").select("root", "report_id", "epoch", "lat", "lon", F.nullif("reporter_token", F.lit("")).alias("token"), kind.alias("kind"))
    told = reports.schema["report_id"].dataType.simpleString()
    gone = named.groupBy("root").applyInPandas(settled, f"report_id {told}, window_s int, distance_m double")
    if patches.where("not few").isEmpty():
        return gone
    pairs = kept(duplicate_pairs(placed.where("not few").select(*reports.columns), plane, widest, max(w for w, _ in settings)))
    for w, d in settings:
        mine = pairs.where((F.col("b_epoch") - F.col("a_epoch") <= w) & (F.col("d") <= d))
        gone = gone.unionByName(removed_reports(mine).select("report_id", F.lit(w).alias("window_s"), F.lit(d).cast("double").alias("distance_m")))
    return gone


def dedupe(reports: DataFrame, plane: geo.Plane, distance_m: float = 15.0, window_s: int = 600) -> DataFrame:
    """The reports that stay. Reports without a readable time are never duplicates."""
    gone = removed_by_setting(reports, plane, [(window_s, distance_m)]).select("report_id").distinct()
    return reports.join(gone, "report_id", "left_anti")
