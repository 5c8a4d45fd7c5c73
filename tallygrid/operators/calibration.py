"""False positives of the hot-spot test on reports dealt out anew at random."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numerics as N
from .hotspot import standard_score
from .ranks import numbered
from .shared import bounded_broadcast, kept

#: Rounds of the network, the prime by which its function is reduced, and the lowest bit of it that is used: low ones mix little.
ROUNDS, PRIME, SHIFT = 8, 2**31 - 1, 8


def half_bits(n: int) -> int:
    """Bits of one half of the least domain of an even number of bits that holds n places."""
    return max(1, -(-(n - 1).bit_length() // 2)) if n > 1 else 1


def keys(seed: int, shuffle: int) -> list[tuple[int, int, int]]:
    """Three numbers of 31 bits for each round."""
    said = (hashlib.md5(f"{seed}-{shuffle}-{k}".encode()).hexdigest() for k in range(ROUNDS))
    return [tuple(int(h[i : i + 8], 16) >> 1 for i in (0, 8, 16)) for h in said]


def permuted(places: np.ndarray, n: int, seed: int, shuffle: int) -> np.ndarray:
    """Where a seeded permutation of 0 ... n - 1 sends each place, each by itself.

    A Feistel network is a bijection of its domain, whatever its function. A place that it sends to n or beyond goes through it
    again until it comes back; so the places below n are permuted among themselves.
    """
    bits, told = half_bits(n), keys(seed, shuffle)
    mask = (1 << bits) - 1
    out = places.astype(np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for a, b, c in told:
            left, right = right, left ^ (((right * right % PRIME) * a + right * b + c) % PRIME >> SHIFT & mask)
        out[todo] = left << bits | right
        todo = todo[out[todo] >= n]
    return out


def null_calibration(
    units: DataFrame, neighbors: DataFrame, shuffles: int = 200, seed: int = 20260101, alpha: float = 0.05, per: float = 1000.0
) -> DataFrame:
    """(shuffle, false_positives): units flagged after the counts of reports were dealt out anew, exposures and neighbours held fixed.

    Rows need id, n and exposure; those without a positive exposure take no part. In each shuffle the unit at a place, in order of id,
    gets the count of the unit at the permuted place, which each task works out for its own units. The last rank that
    Benjamini-Hochberg rejects is found by counting: from all tests down, the number at or under the threshold of a rank
    becomes the next rank, until it stays. So nothing is sorted by shuffle.
    """
    known = kept(numbered(units.where("exposure > 0").select("id", F.col("n").cast("long").alias("n"), F.col("exposure").cast("double").alias("exposure")), ["id"], "place"))
    total = known.count()
    kind = known.schema["id"].dataType.simpleString()

    def deal(batches):
        for batch in batches:
            place = batch.column("place").to_numpy()
            for s in range(shuffles):
                came = permuted(place, total, seed, s)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), s, np.int32)), batch.column("id"), batch.column("exposure"), pa.array(came)], names=["shuffle", "id", "exposure", "place"])

    dealt = known.select("id", "exposure", "place").mapInArrow(deal, f"shuffle int, id {kind}, exposure double, place long")
    table = kept(dealt.join(bounded_broadcast(known.select("place", "n")), "place").select("shuffle", "id", N.rate(F.col("n"), F.col("exposure"), per).alias("value")))
    own = known.select(F.col("id").alias("a"), F.col("id").alias("b"))
    pairs = bounded_broadcast(neighbors.where("a <> b").select("a", "b").distinct().unionByName(own).join(own.select("a"), "a", "left_semi"))
    stats = table.groupBy("shuffle").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    sums = table.join(pairs, table.id == pairs.b).groupBy("shuffle", "a").agg(F.count("*").alias("w"), F.sum("value").alias("wx"))
    tested = kept(sums.join(F.broadcast(stats), "shuffle").select("shuffle", "n", standard_score().alias("z")).withColumn("p", N.two_sided_p(F.col("z"))))
    # One row a shuffle: as many as the caller has asked for.
    ranks = {s: total for s in range(shuffles)}
    while True:
        last = tested.sparkSession.createDataFrame([*ranks.items()], "shuffle int, rank long")
        under = F.col("p") <= F.col("rank") / F.col("n") * alpha
        found = tested.join(F.broadcast(last), "shuffle").groupBy("shuffle").agg(F.count_if(under).alias("rank"), F.count_if(under & (F.col("z") > 0)).alias("false_positives")).collect()
        now = {r.shuffle: r["rank"] for r in found}
        if not found or all(now[s] == ranks[s] for s in now):
            told = {r.shuffle: r.false_positives for r in found}
            return tested.sparkSession.createDataFrame([(s, told.get(s, 0)) for s in range(shuffles)], "shuffle int, false_positives long")
        ranks |= now
