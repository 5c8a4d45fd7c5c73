"""Benchmark decontamination. DataFrame functions only.

A document's windows, each as long as a benchmark item, get SimHash fingerprints. Candidates are
the pairs of a document and an item with fingerprints within the radius, found through
an index of blocks, which misses none of them. Then the weighted similarity of the shingles
of all windows of a candidate is computed exactly, by running sums over the changes from one
window to the next, so that the work is in proportion to the shingles in common.

Necessary conditions keep the windows few, and lose none that can reach the threshold t. With
n and m shingles, a similarity of t needs t / (1 + t) * (n + m) shingles in common, and at least
t * m. So a window holds one of any m - ceil(t * m) + 1 shingles of the item (its anchors). These
are chosen around the item's longest words, so that few words (its pivots) lie in all of
them; only documents with a pivot are looked at by shingle, and only windows of the lengths
of items whose anchor the document has. A window must hold at least the needed number of
shingles that any item has, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded, fresh, saved

WORDS = 5
THRESHOLD = 0.8
#: Differing bits up to which every pair of fingerprints is found. A similarity of 0.8 has 10 on average.
RADIUS = 23
BLOCKS = 8
#: Item shingles up to which the set of them stands in the plan itself; more are joined.
IN_PLAN = 50_000
#: All ways to change at most RADIUS // BLOCKS bits of a block.
_MASKS = [m for m in range(256) if m.bit_count() <= RADIUS // BLOCKS]


def words_of(text: Column) -> Column:
    """The runs of letters and digits of a text, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _positions(n: Column, size: int) -> Column:
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def shingles(words: Column, size: int) -> Column:
    """Hashes of the runs of `size` words, by position."""
    return F.transform(_positions(F.size(words), size), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(size))))


def fingerprint(hashes: Column) -> Column:
    """SimHash of an array of shingle hashes: a bit is set if over half of the hashes have it."""
    one = F.lit(1).cast("long")

    def bits(held: Column) -> Column:
        half = F.size(held) / 2
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(63)),
            F.lit(0).cast("long"),
            lambda acc, b: F.when(
                F.aggregate(held, F.lit(0).cast("long"), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(one)) > half,
                acc.bitwiseOR(F.call_function("shiftleft", one, b)),
            ).otherwise(acc),
        )

    # As a lambda's variable the hashes are worked out once, not for every bit.
    return F.get(F.transform(F.array(hashes), bits), F.lit(0))


def _sums(hashes: Column) -> Column:
    """The sums of the lower and of the upper halves of hashes, the same in any order."""
    half = F.lit(0xFFFFFFFF).cast("long")
    return F.aggregate(
        hashes, F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")),
        lambda s, h: F.struct((s["a"] + h.bitwiseAND(half)).alias("a"), (s["b"] + F.call_function("shiftright", h, F.lit(32)).bitwiseAND(half)).alias("b")),
    )


def _block(fp: Column, b: Column) -> Column:
    return F.call_function("shiftright", fp, (b * 8).cast("int")).bitwiseAND(F.lit(255).cast("long"))


def prepared(benchmark: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """Items with a word: at (a number of the row), item_id, words, w (how many), k (shingle size), hashes, fp, pivots."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.select(
        F.monotonically_increasing_id().alias("at"), "item_id", F.size("words").alias("w"), F.least(F.size("words"), F.lit(WORDS)).alias("k"), "words"
    )
    by_size = F.coalesce(*(F.when(F.col("k") == k, shingles(F.col("words"), k)) for k in range(1, WORDS + 1)))
    items = items.withColumn("hashes", by_size)
    return saved(items.withColumns({"fp": fingerprint(F.col("hashes")), "pivots": _pivots(t)}))


def _pivots(t: float) -> Column:
    """Positions of words of an item (words, w, k), the longest first, that lie in enough shingles.

    Shingles j with p - k < j <= p hold the word p. Words are taken until those that hold one of
    them number m - ceil(t * m) + 1 at least. The state is the shingles that none of the taken words lies in.
    """
    m, k = F.col("w") - F.col("k") + 1, F.col("k")
    most_left = F.ceil(t * m - 1e-9) - 1
    order = F.array_sort(F.transform("words", lambda w, i: F.struct((-F.char_length(w)).alias("n"), i.alias("i"))))
    start = F.struct(F.sequence(F.lit(0), m - 1).alias("left"), F.array().cast("array<int>").alias("taken"))

    def take(state: Column, x: Column) -> Column:
        left = F.filter(state["left"], lambda j: (j > x["i"]) | (j <= x["i"] - k))
        return F.when(F.size(state["left"]) <= most_left, state).otherwise(F.struct(left.alias("left"), F.array_append(state["taken"], x["i"]).alias("taken")))

    return F.aggregate(order, start, take, lambda state: state["taken"])


def contaminated(docs: DataFrame, benchmark: DataFrame, t: float = THRESHOLD, in_plan: int = IN_PLAN) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): the best window of a document for each item that it holds.

    A window is a run of words as long as the item, or the whole of a shorter document. It
    matches at a similarity of at least 0.8 of its five-word shingles, counted with repeats; an
    item of fewer than five words is one shingle. Of equal windows the first is told. Words are
    runs of letters and digits in lower case. Null and empty texts, and items without a word,
    match nothing; rows of equal doc_id are one document; repeated items match each; other
    columns are ignored. Documents that hold no item are not returned. Shingles are told apart
    by 64-bit hashes. Up to `in_plan` different item shingles stand in the plan; more are
    joined, to the same result.
    """
    found = _matches(docs, benchmark, t, in_plan)
    best = found.groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"), F.max_by(F.struct("start", "n"), F.struct(F.col("similarity"), -F.col("start"), F.col("n"))).alias("x")
    )
    return best.select("doc_id", "item_id", "similarity", F.col("x.start").alias("start"), F.col("x.n").alias("n_words"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, t: float = THRESHOLD, in_plan: int = IN_PLAN) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns. Each row is judged by its own text."""
    keys = fresh(docs, "nul", "doc", "mark")
    names = docs.columns
    say = lambda doc, mark: [doc.isNull().alias(keys[0]), F.coalesce(doc.cast("string"), F.lit("")).alias(keys[1]), mark.alias(keys[2])]
    found = saved(_matches(docs, benchmark, t, in_plan).select(*say(F.col("doc_id"), F.col("mark"))).distinct())
    return docs.select("*", *say(F.col("doc_id"), _mark())).join(bounded(found), keys, "left_anti").select(*names)


def _mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _matches(docs: DataFrame, benchmark: DataFrame, t: float, in_plan: int) -> DataFrame:
    """(doc_id, mark, item_id, similarity, start, n): the best window of each row and item; mark is a hash of the row's text."""
    items = prepared(benchmark, t)
    sizes = sorted(r.k for r in items.select("k").distinct().collect())
    if not sizes:
        return docs.where(F.lit(False)).select(
            "doc_id", _mark().alias("mark"), F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
            F.lit(0.0).alias("similarity"), F.lit(0).alias("start"), F.lit(0).alias("n"),
        )
    grams = items.select("at", "w", "k", "pivots", F.posexplode("hashes").alias("j", "h"))
    counts = saved(grams.groupBy("at", "h").agg(F.count("*").cast("int").alias("c")))
    anchors = grams.where(F.exists("pivots", lambda p: F.col("j").between(p - F.col("k") + 1, p)))
    anchors = saved(anchors.select("k", "h", "w").distinct())
    known = saved(grams.select("k", "h").distinct())
    rows = docs.select("doc_id", _mark().alias("mark"), words_of(F.col("text")).alias("words"))
    held = saved(_held_in_plan(rows, items, known, sizes) if known.count() <= in_plan else _held_by_join(rows, known, sizes))

    near = _candidates(held, items, anchors, t / (1 + t))
    return _verified(held, near, items, counts, t)


def _held_in_plan(rows: DataFrame, items: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """(row, doc_id, mark, k, size, hits, hashes) of rows that hold an item's shingle: how many words, where such
    shingles of k words start, and the hashes of all its shingles. The shingles and pivot words stand in the plan."""
    told = [r.p for r in items.select(F.explode(F.transform("pivots", lambda p: F.get("words", p))).alias("p")).distinct().collect()]
    sets: dict[int, list[int]] = {k: [] for k in sizes}
    for r in known.collect():
        sets[r.k].append(r.h)

    # All in one expression per row, each step a lambda's variable: a filter after it would be pushed down and work out everything twice.
    def part(k: int) -> str:
        words = ", ".join(f"get(words, i + {j})" for j in range(k))
        hashes = f"transform(IF(size(words) >= {k}, sequence(0, size(words) - {k}), cast(array() AS array<int>)), i -> xxhash64({words}))"
        known_at = f"filter(transform(held, (h, i) -> struct(i, h)), x -> x.h IN ({','.join(map(_long, sorted(sets[k])))}))"
        return f"transform(array({hashes}), held -> struct({k} AS k, {known_at} AS hits, held AS hashes))"

    each = F.expr(f"filter(concat({', '.join(map(part, sizes))}), x -> size(x.hits) > 0)")
    with_pivot = F.when(F.exists("words", lambda w: w.isin(told)), each)
    found = rows.select("doc_id", "mark", F.size("words").alias("size"), F.explode(with_pivot).alias("x"))
    return found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "mark", "x.k", "size", "x.hits", "x.hashes")


def _long(h: int) -> str:
    return f"{h}L" if h > -(2**63) else "(-9223372036854775807L - 1L)"


def _held_by_join(rows: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """The same for a benchmark too large to stand in the plan: shingles are joined by their hashes, and the texts of rows with any read again."""
    each = None
    for k in sizes:
        hashes = shingles(F.col("words"), k)
        part = rows.select("doc_id", "mark", F.posexplode(hashes).alias("i", "h"))
        part = part.join(bounded(known.where(F.col("k") == k).select("h")), "h", "left_semi").select(*_key(), F.lit(k).alias("k"), "i", "h")
        whole = rows.select("doc_id", "mark", F.lit(k).alias("k"), F.size("words").alias("size"), hashes.alias("hashes")).select("*", *_key())
        part = part.groupBy("nul", "id", "mark", "k").agg(F.array_sort(F.collect_set(F.struct("i", "h"))).alias("hits"))
        part = whole.join(part, ["nul", "id", "mark", "k"]).select("doc_id", "mark", "k", "size", "hits", "hashes")
        each = part if each is None else each.unionByName(part)
    return each.select(F.monotonically_increasing_id().alias("row"), "doc_id", "mark", "k", "size", "hits", "hashes")


def _key() -> list[Column]:
    """Columns without null that say which row it is."""
    return [F.col("doc_id").isNull().alias("nul"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("mark")]


def _candidates(held: DataFrame, items: DataFrame, anchors: DataFrame, share: float) -> DataFrame:
    """(row, at): rows and items with windows whose fingerprints lie within the radius."""
    # The lengths of windows of a row: those of the items of which an anchor stands there.
    tried = held.select("row", "k", F.explode(F.array_distinct(F.transform("hits", lambda x: x["h"]))).alias("h"))
    lengths = tried.join(bounded(anchors), ["k", "h"]).select("row", "w").distinct()
    sized = held.join(lengths, "row").select(
        "row", "k", "w", "size", "hashes", F.least("size", "w").alias("n"), F.transform("hits", lambda x: x["i"]).alias("p")
    )
    both = F.col("n") - F.col("k") + 1 + F.col("w") - F.col("k") + 1
    sized = sized.where("n >= k").withColumn("need", F.greatest(F.lit(1), F.ceil(F.lit(share) * both - 1e-9).cast("int")))
    # Windows with enough hits, each told once, by its first hit.
    starts = F.expr(
        """flatten(transform(
             IF(size(p) >= need, sequence(0, size(p) - need), cast(array() as array<int>)),
             a -> IF(greatest(p[a + need - 1] + k - n, IF(a > 0, p[a - 1] + 1, 0), 0) <= least(p[a], size - n),
                     sequence(greatest(p[a + need - 1] + k - n, IF(a > 0, p[a - 1] + 1, 0), 0), least(p[a], size - n)),
                     cast(array() as array<int>))))"""
    )
    # Windows of the same shingles have one fingerprint: of those of a row and length that agree in two sums of hashes one is taken.
    windows = sized.select(
        "row", "k", "w", (F.col("n") - F.col("k") + 1).alias("many"), "hashes",
        F.sort_array(F.transform(starts, lambda s: F.struct(_sums(F.slice("hashes", s + 1, F.col("n") - F.col("k") + 1)).alias("key"), s.alias("start")))).alias("x"),
    )
    windows = windows.select("row", "k", "w", "many", "hashes", F.explode(F.expr("filter(x, (y, i) -> i = 0 OR y.key != x[i - 1].key)")).alias("x"))
    windows = windows.select("row", "k", "w", fingerprint(F.slice("hashes", F.col("x.start") + 1, F.col("many"))).alias("fp")).distinct()
    # Index: every way in which a block of an item's fingerprint can differ, by item size.
    blocks = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    index = items.select("at", "k", "w", F.col("fp").alias("item_fp"), F.explode(blocks).alias("b")).withColumn(
        "mask", F.explode(F.array(*(F.lit(m).cast("long") for m in _MASKS)))
    )
    index = index.select("at", "k", "w", "item_fp", "b", _block(F.col("item_fp"), F.col("b")).bitwiseXOR(F.col("mask")).alias("v"))
    probes = windows.withColumn("b", F.explode(blocks)).withColumn("v", _block(F.col("fp"), F.col("b")))
    small = F.broadcast if items.count() * len(_MASKS) * BLOCKS <= BROADCAST_ROWS else (lambda x: x)
    near = probes.join(small(index), ["k", "w", "b", "v"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    return near.select("row", "at").distinct()


def _verified(held: DataFrame, near: DataFrame, items: DataFrame, counts: DataFrame, t: float) -> DataFrame:
    """The best window of each candidate, if it reaches the threshold; exact.

    The j-th position p of a shingle that the item has c times counts for the windows that begin
    at most n - k before p, and after the position c before it; so it adds one at the first
    such begin and takes it away after the last. Between these changes nothing changes.
    """
    told = bounded(saved(items.select("at", "item_id", "w", "k")))
    pairs = saved(near.join(told, "at"))
    found = held.select("row", "size", F.explode("hits").alias("x")).select("row", "size", "x.i", "x.h")
    found = found.join(pairs.select("row", "at", "w", "k"), "row").join(bounded(counts), ["at", "h"])
    places = found.groupBy("row", "at", "h").agg(
        F.first("c").alias("c"), F.first("k").alias("k"), F.first("w").alias("w"), F.first("size").alias("size"), F.array_sort(F.collect_list("i")).alias("p")
    )
    places = places.select("row", "at", "c", "k", "w", F.least("size", "w").alias("n"), "size", "p")
    spans = places.select(
        "row", "at", "k", "w", "n", "size",
        F.explode(F.expr("transform(p, (x, j) -> struct(greatest(x - n + k, IF(j >= c, p[j - c] + 1, 0), 0) AS a, x AS b))")).alias("s"),
    ).where("s.a <= s.b and s.a <= size - n")
    changes = spans.select("row", "at", "k", "w", "n", "size", F.explode(F.expr("array(struct(s.a AS start, 1 AS d), struct(s.b + 1 AS start, -1 AS d))")).alias("x"))
    steps = changes.where("x.start <= size - n").groupBy("row", "at", "k", "w", "n", F.col("x.start").alias("start")).agg(F.sum("x.d").alias("d"))
    alike = F.expr("sum(d) OVER (PARTITION BY row, at ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    scored = steps.select("row", "at", "start", "n", alike.alias("alike"), ((F.col("n") - F.col("k") + 1) + (F.col("w") - F.col("k") + 1)).alias("both"))
    scored = scored.withColumn("similarity", F.col("alike") / (F.col("both") - F.col("alike"))).where(F.col("similarity") >= t)
    best = scored.groupBy("row", "at").agg(F.max("similarity").alias("similarity"), F.max_by(F.struct("start", "n"), F.struct(F.col("similarity"), -F.col("start"))).alias("x"))
    named = best.join(bounded(pairs.select("row", "at", "item_id")), ["row", "at"]).join(held.select("row", "doc_id", "mark"), "row")
    return named.select("doc_id", "mark", "item_id", "similarity", F.col("x.start").alias("start"), F.col("x.n").alias("n"))
