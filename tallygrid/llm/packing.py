"""Best-fit packing of token sequences into several permitted sequence lengths."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Pieces that one packing holds in memory; a partition of more is packed in several such parts.
PART = 50_000


Item = tuple[int | None, int, int]


@dataclass(frozen=True)
class Sizes:
    """Permitted sequence lengths, and what a sequence costs, in tokens of a short one.

    A sequence costs its length, something for being one, and the attention between its
    tokens: at a length of `attention` as much again as the length. So long sequences cost
    more for a token than short ones, and very short ones do too.
    """

    lengths: tuple[int, ...] = (512, 1024, 2048, 4096, 8192)
    overhead: int = 32
    attention: int = 65_536

    def cost(self, length: int) -> float:
        return self.overhead + length + length * length / self.attention

    def fitting(self, used: int) -> int:
        """The smallest permitted length that holds `used`."""
        return self.lengths[bisect_left(self.lengths, used)]


def _best_fit(order: list[Item], sizes: Sizes, opened: tuple[int, ...]) -> list[tuple[int, list[Item]]]:
    """Items, the longest first, to (length, items) by order of opening, with new bins of the lengths `opened` only."""
    ascending = [x[2] for x in reversed(order)]
    left, room_left = sum(ascending), 0
    rooms: list[int] = []  # the different free rooms, ascending
    open_bins: dict[int, list[int]] = {}
    bins: list[list[Item]] = []

    def filled(length: int, need: int, n: int) -> int:
        """What a new bin is going to hold: the longest of the n items still to come that has room, again and again.

        It gets no more than those items leave when all open bins are full.
        """
        room, spare = length - need, max(0, left - need - room_left)
        while n and room:
            n = bisect_right(ascending, room, 0, n) - 1
            if n < 0:
                break
            room -= ascending[n]
        return need + min(length - need - room, spare)

    for at, item in enumerate(order):
        need = item[2]
        i = bisect_left(rooms, need)
        if i < len(rooms):
            room = rooms[i]
            stack = open_bins[room]
            b = stack.pop()
            if not stack:
                del open_bins[room], rooms[i]
            bins[b].append(item)
            room_left -= room
        else:
            to_come = len(order) - at - 1
            fits = [(filled(c, need, to_come), c) for c in opened if c >= need]
            # A bin that is not going to be full is as dear as the length to which it shrinks.
            room = min((sizes.cost(sizes.fitting(n)) / n, c) for n, c in fits)[1]
            b = len(bins)
            bins.append([item])
        left -= need
        if room := room - need:
            if room not in open_bins:
                insort(rooms, room)
                open_bins[room] = []
            open_bins[room].append(b)
            room_left += room
    return [(sizes.fitting(sum(x[2] for x in b)), b) for b in bins]


def pack(items: list[Item], sizes: Sizes) -> list[tuple[int, list[Item]]]:
    """Pack (id, start, length) with lengths from 1 to the greatest permitted one.

    Longest first (ties: id, null first, then start), each item goes to the open bin that it leaves fullest.
    If none has room, the bin size of least cost for each token that it is going to hold
    opens, the smaller of equals. In the end each bin shrinks to the smallest permitted length
    of its contents. This is done with all lengths, without the smallest, and so on to the
    greatest alone, and the packing of least cost is taken. Returns (length, items) by order
    of opening.
    """
    order = sorted(items, key=lambda x: (-x[2], x[0] is not None, x[0] or 0, x[1]))
    tried = (_best_fit(order, sizes, sizes.lengths[i:]) for i in range(len(sizes.lengths)))
    return min(tried, key=lambda bins: sum(sizes.cost(c) for c, _ in bins))


_ITEMS = "array<struct<doc_id:bigint,start:bigint,length:bigint>>"


def pack_documents(lengths: DataFrame, sizes: Sizes = Sizes(), rows_per_part: int = 20_000) -> DataFrame:
    """Rows (doc_id, length) to one row per packed sequence.

    Returns bin_id, capacity, used, n_items, items array<struct<doc_id, start, length>>. A
    sequence longer than the greatest permitted length is split into pieces of that length
    and a rest; `start` says where in its document a piece begins, and the pieces of all
    sequences cover every token once. Null, zero and negative lengths take no room and are
    not packed; repeated rows are packed once each; null doc_ids are packed like others; other columns are ignored; an empty table gives an empty
    result. Rows are dealt out by a hash of doc_id and length, those without doc_id by their
    place, so that a rerun of a lost task packs the same rows in the same way; each partition
    is packed in parts of bounded size. Which bins come out depends on the parts, and so on the
    size of the table; packing by part costs at most the unfilled bins of each part.
    """
    # The lengths are worked out once, for the count and for the packing.
    rows = saved(lengths.select(F.col("doc_id").cast("long"), F.col("length").cast("long")))
    parts = max(1, -(-rows.count() // rows_per_part))
    longest = sizes.lengths[-1]

    def run(batches):
        from pyspark import TaskContext

        task, number, held = TaskContext.get().partitionId(), 0, []

        def flush():
            nonlocal number
            packed = pack(held, sizes)
            held.clear()
            for at in range(0, len(packed), 1000):
                part = packed[at : at + 1000]
                names = ("doc_id", "start", "length")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(task << 40) + number + i for i in range(len(part))], pa.int64()),
                        pa.array([c for c, _ in part], pa.int64()),
                        pa.array([sum(x[2] for x in b) for _, b in part], pa.int64()),
                        pa.array([len(b) for _, b in part], pa.int64()),
                        pa.array(
                            [[dict(zip(names, x)) for x in b] for _, b in part],
                            pa.list_(pa.struct([(n, pa.int64()) for n in names])),
                        ),
                    ],
                    names=["bin_id", "capacity", "used", "n_items", "items"],
                )
                number += len(part)

        for batch in batches:
            for doc, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start in range(0, n, longest):
                    held.append((doc, start, min(longest, n - start)))
                    if len(held) >= PART:
                        yield from flush()
        yield from flush()

    dealt = (
        rows.where("length > 0")
        .repartition(parts, F.xxhash64("doc_id", "length", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())))
        .sortWithinPartitions("doc_id", "length")
    )
    return dealt.mapInArrow(run, f"bin_id long, capacity long, used long, n_items long, items {_ITEMS}")
