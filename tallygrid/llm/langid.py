"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

#: N-grams in a profile, and the penalty for one that a profile lacks.
TOP = 300
#: Different words that a task counts before it passes on their n-grams.
FLUSH = 100_000
_LETTERS: list[np.ndarray] = []
_BASE = 1 << 21


def _codes(text: str) -> np.ndarray:
    """Code points in lower case; 0 for all that is no letter, at both ends too."""
    if not _LETTERS:
        table = np.zeros(0x110000, dtype=bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTERS.append(table)
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return np.where(_LETTERS[0][c], c, 0)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1-, 2- and 3-grams of a text's words, each word between blanks.

    A code is the number with the code points as digits to the base 2^21, a blank being 0; the
    blank alone and grams with a blank inside or with two are none.
    """
    c = _codes(text)
    a, b, d = c[:-2], c[1:-1], c[2:]
    one = c[c > 0]
    two = (c[:-1] * _BASE + c[1:])[(c[:-1] > 0) | (c[1:] > 0)]
    three = ((a * _BASE + b) * _BASE + d)[(b > 0) & ((a > 0) | (d > 0))]
    # Codes of the three kinds are kept apart by a tag in the lowest bits; 63 bits hold them by wrapping.
    with np.errstate(over="ignore"):
        return np.unique(np.concatenate([one * 4 + 1, two * 4 + 2, three * 4 + 3]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The `top` most frequent codes, most frequent first, the lesser code first of equals."""
    if len(codes) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:top]


def out_of_place(profile: np.ndarray, known: tuple[np.ndarray, np.ndarray], top: int = TOP) -> int:
    """Sum over a document's grams of how far each is from its place in a language's profile."""
    codes, ranks = known
    if not len(codes):
        return top * len(profile)
    at = np.minimum(np.searchsorted(codes, profile), len(codes) - 1)
    return int(np.where(codes[at] == profile, np.abs(ranks[at] - np.arange(len(profile))), top).sum())


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, code, n) over rows (lang, text): n-grams of all words of all texts.

    A task counts words first and n-grams of the different ones, so that it passes on few rows.
    """
    small_batches(rows.sparkSession)

    def run(batches):
        words: dict[str, Counter] = {}

        def flush():
            for lang, counted in words.items():
                total: Counter = Counter()
                items = list(counted.items())
                # Words of one count share one call.
                by_count: dict[int, list[str]] = {}
                for w, n in items:
                    by_count.setdefault(n, []).append(w)
                for n, ws in by_count.items():
                    codes, counts = grams(" ".join(ws))
                    for code, k in zip(codes.tolist(), (counts * n).tolist()):
                        total[code] += k
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(total), pa.string()), pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
                    names=["lang", "code", "n"],
                )
            words.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, words.values())) > FLUSH:
                yield from flush()
        yield from flush()

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def learn_profiles(rows: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """Ranked codes per language from rows (lang, text). At most `top` rows a language come to the driver."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = gram_counts(rows).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    out: dict[str, list[tuple[int, int]]] = {}
    for r in best.select("lang", "code", "rank").collect():
        out.setdefault(r.lang, []).append((r.rank, r.code))
    return {lang: np.array([c for _, c in sorted(x)], dtype=np.int64) for lang, x in out.items()}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = TOP) -> DataFrame:
    """doc_id, lang_pred and score of every text.

    The language of least out-of-place distance, the first by name of equals; `und` with score 0
    if the text is null or has no letter, or no language was learned. The score is d2 / (d1 + d2)
    of the two least distances, 1 if only one language is known.
    """
    small_batches(docs.sparkSession)
    names = sorted(profiles)
    known = [(np.sort(profiles[x]), np.argsort(profiles[x], kind="stable")) for x in names]

    def answer(text: str | None) -> tuple[str, float]:
        if not text or not names:
            return "und", 0.0
        codes, counts = grams(text)
        if not len(codes):
            return "und", 0.0
        profile = ranked(codes, counts, top)
        far = [out_of_place(profile, k, top) for k in known]
        order = sorted(range(len(far)), key=lambda i: (far[i], i))
        if len(order) == 1:
            return names[0], 1.0
        d1, d2 = far[order[0]], far[order[1]]
        return names[order[0]], d2 / (d1 + d2) if d1 + d2 else 0.5

    def run(batches):
        for batch in batches:
            said = [answer(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def predict_languages(docs: DataFrame, top: int = TOP) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from rows whose crc32(doc_id as text) mod 5 is not 0.

    Rows with null lang, text or doc_id teach nothing; a null doc_id is not held out. Repeated
    rows are counted and answered each; other columns are ignored; an empty table gives an
    empty result.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    teach = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~out)
    profiles = learn_profiles(teach.select("lang", "text"), top)
    return identify(docs, profiles, top).select("doc_id", out.alias("held_out"), "lang_pred", "score")
