import random

import public_tokenizers

from tallygrid.llm import tokens
from tallygrid.llm.packing import Sizes, _best_fit, pack, pack_documents
from tallygrid.llm.queries import VOCABULARY, lengths_for_packing

SIZES = Sizes((16, 64, 256), 4, 2048)


def cost(bins, sizes=SIZES):
    return sum(sizes.cost(c) for c, _ in bins)


def test_bins_hold_what_they_should():
    draw = random.Random(1)
    items = [(i, 0, draw.randint(1, 256)) for i in range(400)]
    bins = pack(items, SIZES)
    assert sorted(x for _, b in bins for x in b) == sorted(items)
    for length, b in bins:
        used = sum(x[2] for x in b)
        assert used <= length and length == min(c for c in SIZES.lengths if c >= used)
    assert sum(c for c, _ in bins) < 1.1 * sum(x[2] for x in items)


def test_order_of_input_does_not_matter():
    items = [(i, 0, 1 + i * 37 % 250) for i in range(100)]
    assert pack(items, SIZES) == pack(items[::-1], SIZES)


def test_last_bin_is_cheap():
    assert pack([(1, 0, 10)], SIZES) == [(16, [(1, 0, 10)])]
    assert pack([], SIZES) == []


def least_cost(lengths, sizes):
    """The optimum, by all ways to put the items into bins."""
    best = [float("inf")]

    def go(i, bins):
        if i == len(lengths):
            best[0] = min(best[0], sum(sizes.cost(sizes.fitting(b)) for b in bins))
            return
        for j, b in enumerate(bins):
            if b + lengths[i] <= sizes.lengths[-1] and b not in bins[:j]:
                go(i + 1, [*bins[:j], b + lengths[i], *bins[j + 1 :]])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best[0]


def test_against_the_optimum_of_small_inputs():
    draw, ratios = random.Random(3), []
    for _ in range(150):
        sizes = Sizes((8, 16, 32), draw.choice((0, 2, 6)), draw.choice((32, 128, 1024)))
        lengths = [draw.randint(1, 32) for _ in range(draw.randint(1, 8))]
        got = cost(pack([(i, 0, n) for i, n in enumerate(lengths)], sizes), sizes)
        ratios.append(got / least_cost(lengths, sizes))
    assert min(ratios) > 1 - 1e-9 and max(ratios) < 1.3 and sum(ratios) / len(ratios) < 1.03


def test_choice_of_lengths_acts_on_the_test_table(spark, data):
    sizes = Sizes()
    items = [(r.doc_id, s, min(8192, r.length - s)) for r in lengths_for_packing(spark.read.parquet(f"{data}/documents.parquet")).collect() for s in range(0, r.length, 8192)]
    chosen = pack(items, sizes)
    order = sorted(items, key=lambda x: (-x[2], x[0], x[1]))
    alone = _best_fit(order, sizes, sizes.lengths[-1:])
    assert len({c for c, _ in chosen}) >= 3 and len({c for c, b in chosen if len(b) > 1}) >= 3
    assert cost(chosen, sizes) < 0.98 * cost(alone, sizes)
    assert sum(c for c, _ in chosen) <= 1.01 * sum(c for c, _ in alone)
    assert all(cost(chosen, sizes) <= cost(_best_fit(order, sizes, sizes.lengths[i:]), sizes) for i in range(5))


def rows_of(frame):
    return [(i.doc_id, i.start, i.length) for r in frame.collect() for i in r["items"]]


def test_whole_documents_are_covered(spark):
    lengths = [(1, 700, "a"), (2, 256, "b"), (3, 0, None), (4, None, ""), (5, 1, ""), (5, 1, ""), (None, 7, ""), (None, 7, ""), (6, 257, "")]
    out = pack_documents(spark.createDataFrame(lengths, "doc_id long, length long, bin_id string"), SIZES)
    got = rows_of(out)
    total = {}
    for d, _, n in got:
        total[d] = total.get(d, 0) + n
    assert total == {1: 700, 2: 256, 5: 2, None: 14, 6: 257}
    assert sorted((s, n) for d, s, n in got if d == 1) == [(0, 256), (256, 256), (512, 188)]
    assert all(r.used <= r.capacity for r in out.collect())


def test_lengths_are_those_of_the_records(spark):
    texts = ["", None, "plain words", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x <|endoftext|>  y  \n\n<|endoftext|", "  <|endoftext|>\n", "word " * 40_000, "z" * 30_000, "größe 日本 ''re't"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int")
    encoder = tokens.PieceEncoder(VOCABULARY)
    want = {i: len(encoder.encode([t or ""])[0]) // 4 + 1 for i, t in enumerate(texts)}
    assert {r.doc_id: r.length for r in lengths_for_packing(docs).collect()} == want
    assert want[4] == 3 and public_tokenizers.PATTERN


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, length long, items int"), SIZES).collect() == []
