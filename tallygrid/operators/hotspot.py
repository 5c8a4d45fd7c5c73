"""Local Gi* hot spots with false-discovery control, and the one-call unit analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import numerics as N
from .shared import kept


def getis_ord_star(values: DataFrame, neighbors: DataFrame) -> DataFrame:
    """(id, z) from (id, value) and (a, b) neighbour pairs; every unit is its own neighbour.

    Population deviation about the global mean; z is 0 with fewer than three units, no spread,
    or a neighbourhood that is everything. Neighbours without a value do not count.
    """
    own = values.where("value is not null").select("id", "value")
    whole = own.agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    pairs = neighbors.where("a <> b").select("a", "b").distinct().unionByName(own.select(F.col("id").alias("a"), F.col("id").alias("b")))
    sums = (
        pairs.join(own.select(F.col("id").alias("b"), "value"), "b")
        .join(own.select(F.col("id").alias("a")), "a", "left_semi")
        .groupBy("a")
        .agg(F.count("*").alias("w"), F.sum("value").alias("wx"))
    )
    return sums.crossJoin(F.broadcast(whole)).select(F.col("a").alias("id"), standard_score().alias("z"), F.col("w").alias("neighbors"))


def standard_score() -> Column:
    """Gi* from n, mean and sd of all values, and the number w and the sum wx of those in a neighbourhood."""
    n, w = F.col("n"), F.col("w")
    spread = F.col("sd") * F.sqrt(F.greatest(F.lit(0.0), (n * w - w * w) / (n - 1)))
    return F.when((n < 3) | (F.col("sd") == 0) | (spread == 0), 0.0).otherwise((F.col("wx") - F.col("mean") * w) / spread)


#: Cells to the band, and to a block of cells of one row; a row of the band lies in two blocks at the most.
CELLS, BLOCK = 8, 32


def band_sums(units: DataFrame, plane: geo.Plane, band: float) -> DataFrame:
    """(a, w, wx): number and sum of the values of units (id, lat, lon, value) within the band of each, itself included.

    No list of pairs: units of one place are counted once, with their number and sum. Cells wholly inside the band count by running
    sums of their row, two look-ups of blocks a row at the most, and only places in cells on the rim are tested one by one.
    So what is shuffled grows with the places, not with pairs of units, wherever the band is wide against the crowd.
    """
    size, inner, outer = band / CELLS, band - geo.margin(band), band + geo.margin(band)
    valued = units.where("value is not null and lat is not null and lon is not null")
    spots = valued.groupBy("lat", "lon").agg(F.count("*").alias("c"), F.sum("value").alias("s"))
    spots = spots.select(F.struct("lat", "lon").alias("id"), "lat", "lon", "c", "s", plane.x(F.col("lon")).alias("x"), plane.y(F.col("lat")).alias("y"))
    placed = kept(spots.withColumns({"cx": geo.cell(F.col("x"), size), "cy": geo.cell(F.col("y"), size)}))
    cells = placed.groupBy("cx", "cy").agg(F.sum("c").alias("c"), F.sum("s").alias("s"))
    upto = lambda what, kind: F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.aggregate("t", F.lit(0).cast(kind), lambda a, t: a + F.when(t["i"] <= i, t[what]).otherwise(F.lit(0).cast(kind))))
    held = cells.groupBy("cy", F.floor(F.col("cx") / BLOCK).alias("bx")).agg(F.collect_list(F.struct(F.pmod("cx", F.lit(BLOCK)).alias("i"), "c", "s")).alias("t"))
    blocks = held.select("cy", "bx", upto("c", "long").alias("c"), upto("s", "double").alias("s"))

    reach = int(outer / size) + 1
    rows = placed.select("id", "lat", "lon", "x", "y", F.explode(F.sequence(F.col("cy") - reach, F.col("cy") + reach)).alias("cy"))
    low, high = F.col("cy") * size, (F.col("cy") + 1) * size
    far = F.greatest(F.abs(F.col("y") - low), F.abs(F.col("y") - high))
    near = F.greatest(F.lit(0.0), low - F.col("y"), F.col("y") - high)
    half = lambda radius, dy: F.sqrt(F.lit(radius * radius) - dy * dy)
    inside, within = far < inner, near <= outer
    rows = rows.where(within).withColumns({
        "i0": F.when(inside, F.ceil((F.col("x") - half(inner, far)) / size)), "i1": F.when(inside, F.floor((F.col("x") + half(inner, far)) / size) - 1),
        "o0": F.floor((F.col("x") - half(outer, near)) / size), "o1": F.floor((F.col("x") + half(outer, near)) / size),
    })
    full = F.coalesce(F.col("i0") <= F.col("i1"), F.lit(False))
    block = lambda c: F.floor(F.col(c) / BLOCK)
    asked = rows.where(full).select("id", "cy", "i0", "i1", F.explode(F.array_distinct(F.array(block("i0"), block("i1")))).alias("bx"))
    found = asked.join(blocks, ["cy", "bx"])
    last = F.when(F.col("bx") == block("i1"), F.pmod("i1", F.lit(BLOCK))).otherwise(F.lit(BLOCK - 1)).cast("int")
    before = F.when(F.col("bx") == block("i0"), F.pmod("i0", F.lit(BLOCK)) - 1).otherwise(F.lit(-1)).cast("int")
    part = lambda c: F.get(c, last) - F.when(before >= 0, F.get(c, before)).otherwise(0)
    whole = found.select("id", part("c").alias("w"), part("s").alias("wx"))

    some = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
    rim = F.when(full, F.concat(some(F.col("o0"), F.col("i0") - 1), some(F.col("i1") + 1, F.col("o1")))).otherwise(some(F.col("o0"), F.col("o1")))
    edge = rows.select("id", "lat", "lon", "cy", F.explode(rim).alias("cx"))
    other = placed.select("cx", "cy", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "c", "s")
    met = edge.join(other, ["cx", "cy"]).where(geo.haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) <= band)
    sums = whole.unionByName(met.select("id", F.col("c").alias("w"), F.col("s").alias("wx")))
    around = sums.groupBy("id").agg(F.sum("w").alias("w"), F.sum("wx").alias("wx")).select(F.col("id.lat").alias("lat"), F.col("id.lon").alias("lon"), "w", "wx")
    told = valued.select(F.col("id").alias("a"), "lat", "lon").join(around, ["lat", "lon"])
    return told.groupBy("a").agg(F.sum("w").alias("w"), F.sum("wx").alias("wx"))


def getis_ord_band(units: DataFrame, plane: geo.Plane, band: float) -> DataFrame:
    """(id, z, neighbors) as `getis_ord_star`, from units (id, lat, lon, value) whose neighbours are those within the band."""
    own = units.where("value is not null")
    whole = own.agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    return band_sums(own, plane, band).crossJoin(F.broadcast(whole)).select(F.col("a").alias("id"), standard_score().alias("z"), F.col("w").alias("neighbors"))


def benjamini_hochberg(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds `rejected`: p at or under the greatest p whose rank r has p <= r / m * alpha.

    The rank of a p is the number of tests at or under it, so ties share the greatest rank;
    this rejects the same tests. Ranks come from counts of different p, summed over ranges.
    """
    counts = tests.where("p is not null").groupBy("p").agg(F.count("*").alias("c"))
    ranks = cumulative(counts, "p", "c").crossJoin(F.broadcast(counts.agg(F.sum("c").alias("m"))))
    last = ranks.where(F.col("p") <= F.col("upto") / F.col("m") * alpha).agg(F.max("p").alias("last"))
    return tests.crossJoin(F.broadcast(last)).withColumn("rejected", F.coalesce(F.col("p") <= F.col("last"), F.lit(False))).drop("last")


def cumulative(rows: DataFrame, key: str, count: str, buckets: int = 256) -> DataFrame:
    """Adds `upto`, the running sum of `count` in order of `key` (all different), without one task for all.

    Rows are cut into ranges of the key; each is summed, the at most `buckets` sums give the
    offsets, and the running sum goes on within each range.
    """
    cuts = rows.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 10_000).alias("cuts"))
    placed = rows.crossJoin(F.broadcast(cuts)).withColumn("__b", F.size(F.filter("cuts", lambda c: c < F.col(key)))).drop("cuts")
    sums = placed.groupBy("__b").agg(F.sum(count).alias("s"))
    offsets = sums.select("__b", (F.sum("s").over(Window.orderBy("__b")) - F.col("s")).alias("before"))
    within = F.sum(count).over(Window.partitionBy("__b").orderBy(key))
    return placed.join(F.broadcast(offsets), "__b").withColumn("upto", within + F.col("before")).drop("__b", "before")


def hotspot_significance(z: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds p, rejected and significant: rejected with positive z."""
    tested = benjamini_hochberg(z.withColumn("p", N.two_sided_p(F.col("z"))), alpha)
    return tested.withColumn("significant", F.col("rejected") & (F.col("z") > 0))


def unit_analyze(
    units: DataFrame, plane: geo.Plane, band: float, per: float = 1000.0, z: float = N.Z95, alpha: float = 0.05
) -> DataFrame:
    """Rates, intervals, Gi* and significance of units (id, lat, lon, n, exposure).

    Units without positive exposure come back with null rate and z and are not significant.
    """
    n, e = F.col("n"), F.col("exposure")
    rated = units.withColumns(
        {"rate": N.rate(n, e, per), "rate_ci_low": N.rate_low(n, e, per, z), "rate_ci_high": N.rate_high(n, e, per, z)}
    )
    rated = kept(rated)
    known = rated.where("rate is not null")
    gi = getis_ord_band(known.select("id", "lat", "lon", F.col("rate").alias("value")), plane, band)
    flagged = hotspot_significance(gi, alpha).select("id", "z", "p", "significant")
    return rated.join(flagged, "id", "left").withColumn("significant", F.coalesce("significant", F.lit(False)))


def planted_units(spark) -> DataFrame:
    """Units with a planted hot spot, a decoy with many events and as much exposure, and context."""
    hot = [(f"hot-{i}", 0.001 * i, 0.0, 40, 100.0) for i in range(3)]
    decoy = [("decoy", 0.02, 0.02, 400, 10_000.0)]
    context = [(f"context-{i}", 0.05 + 0.01 * i, 0.05, 4 + i % 2, 100.0) for i in range(8)]
    return spark.createDataFrame(hot + decoy + context, "id string, lat double, lon double, n long, exposure double")
