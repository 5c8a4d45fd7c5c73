"""Document fingerprints: bottom-k sketches of shingle hashes."""

from __future__ import annotations

import base64
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST, n_ranges, place, range_heads, shingle_hashes, small_batches, text_or_empty, word_hashes

WORDS = 5
K = 128


@dataclass(frozen=True)
class Sketch:
    """The k least different shingle hashes of a set, ascending. Fewer than k are the whole set."""

    k: int
    hashes: np.ndarray

    @classmethod
    def of(cls, text: str, k: int = K, words: int = WORDS) -> "Sketch":
        """From runs of `words` words; from the whole sequence if there are fewer; empty for none."""
        h = shingle_hashes(word_hashes(text), words)
        if len(h) > 4 * k:
            # The k least different ones are among the least few, unless these repeat.
            for most in (2 * k, len(h)):
                least = np.unique(np.partition(h, most - 1)[:most])
                if len(least) >= k:
                    break
        else:
            least = np.unique(h)
        return cls(k, least[:k])

    def merge(self, other: "Sketch") -> "Sketch":
        """The sketch of the union of both sets."""
        k = min(self.k, other.k)
        return Sketch(k, np.union1d(self.hashes, other.hashes)[:k])

    def distinct(self) -> float:
        """Different shingles: exact below k, else (k - 1) over the k-th least hash as a share of all."""
        n = len(self.hashes)
        return float(n) if n < self.k else (self.k - 1) / ((float(self.hashes[-1]) + 1) / 2.0**64)

    def resemblance(self, other: "Sketch") -> float:
        """Estimated Jaccard index: the share of the union's sketch that both hold. Two empty sets: 1."""
        union = self.merge(other).hashes
        if not len(union):
            return 1.0
        both = np.intersect1d(self.hashes, other.hashes, assume_unique=True)
        return float(np.isin(union, both, assume_unique=True).sum()) / len(union)

    def containment(self, other: "Sketch") -> float:
        """Estimated share of this set that the other holds. Of an empty set: 1."""
        if not len(self.hashes):
            return 1.0
        j, union = self.resemblance(other), self.merge(other).distinct()
        return min(1.0, j * union / max(1.0, self.distinct()))

    def dump(self) -> str:
        """k, then the hashes as little-endian 64-bit integers in base64."""
        return f"{self.k}:" + base64.b64encode(self.hashes.astype("<u8").tobytes()).decode("ascii")

    @classmethod
    def load(cls, said: str) -> "Sketch":
        k, _, body = said.partition(":")
        return cls(int(k), np.frombuffer(base64.b64decode(body), "<u8"))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_distinct and fingerprint of every text. A null text is empty; repeated rows count each."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            made = [Sketch.of(t or "", k) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.distinct() for s in made], pa.float64()), pa.array([s.dump() for s in made], pa.string())],
                names=["doc_id", "n_distinct", "fingerprint"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_distinct double, fingerprint string"
    )


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones (or all) of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edits(docs: DataFrame, k: int = K, rows_per_range: int = 4000) -> DataFrame:
    """Every text's fingerprint beside those of its edited text and of the next document.

    Next is by ascending doc_id, and after the last comes the first. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_distinct,
    kept_share (containment of the edited text's shingles in the text). A null text is empty,
    and the fingerprint of an empty one holds no hash. Rows of equal doc_id come in order of
    their texts, null doc_ids first; a single row is its own next. Other columns are ignored;
    an empty table gives an empty result.

    Texts are dealt out once, by consecutive ranges of doc_id, a task for each, and read in order
    within it; the first row of a range is sent to the range before as well. No task holds more
    than a batch and one document of the stream. Rows of one doc_id that begin alike, by 64 code points, are in one range.
    """
    small_batches(docs.sparkSession)
    heads = range_heads(docs, n_ranges(docs, rows_per_range)) or [(LOWEST, "")]
    shared, n = docs.sparkSession.sparkContext.broadcast(heads), len(heads)

    def deal(batches):
        heads = shared.value
        for batch in batches:
            spots = list(zip(batch.column("key").to_pylist(), batch.column("mark").to_pylist()))
            at = [bisect_right(heads, x) - 1 for x in spots]
            # A row before the first head cannot be, unless it came after the heads were taken.
            at = [max(0, i) for i in at]
            first = [i for i, x in enumerate(spots) if heads[at[i]] == x]
            rows = pa.array([*range(len(spots)), *first])
            places = pa.array([*at, *((at[i] - 1) % n for i in first)], pa.int32())
            ahead = pa.array([0] * len(spots) + [1] * len(first), pa.int32())
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns), places, ahead], names=["doc_id", "text", "key", "mark", "at", "ahead"])

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), *place())
    dealt = (
        rows.mapInArrow(deal, "doc_id long, text string, key long, mark string, at int, ahead int")
        .repartitionById(n, F.col("at"))
        .sortWithinPartitions("at", "ahead", "key", "mark", "text")
        .select("doc_id", "text", "at", "ahead")
    )

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_distinct", "kept_share"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.float64()]

    def run(batches):
        import hashlib

        last = None  # (doc_id, text, sketch, range) that awaits its next
        done = None  # the range whose next row ahead has been taken
        for batch in batches:
            out = []
            for doc, text, at, ahead in zip(*(c.to_pylist() for c in batch.columns)):
                if ahead and (done == at or last is None or last[3] != at):
                    continue
                sketch = Sketch.of(text, k)
                if last is not None and last[3] == at:
                    changed = edited(last[1], text)
                    other = Sketch.of(changed, k)
                    out.append(
                        (
                            last[0], len(last[1]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            last[2].dump(), other.dump(), last[2].resemblance(other), last[2].resemblance(sketch),
                            last[2].distinct(), other.containment(last[2]),
                        )
                    )
                last = (doc, text, sketch, at)
                if ahead:
                    last, done = None, at
            for i in range(0, len(out), 500):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out[i : i + 500]), kinds)], names=names
                )

    return dealt.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, n_distinct double, kept_share double",
    )
