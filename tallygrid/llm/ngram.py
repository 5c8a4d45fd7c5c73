"""An interpolated modified Kneser-Ney bigram model, counted in Spark and kept as sorted arrays.

Words are told apart by 64-bit hashes. The vocabulary is a sorted array of these, cut into files by
the leading bits; a word's place in it is its number. A pair of words is a 64-bit key: the number of the
first, then that of the second. Pairs lie in files that hold about equally many tokens of the corpus each, in
order of the first word; those of a frequent first word are spread over several by the second. Which file a
pair belongs to follows from the vocabulary's counts alone. So tasks send each file's
pairs as sorted runs, one task merges those of a file, and what it learns about single words
(pairs they begin, by count; different words before them) goes in runs to one task for each file of the vocabulary.
Workers map all files into memory to score.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import get, mixed, places, put
from .common import new_folder, saved, small_batches, text_or_empty, word_hashes

#: The token that ends a text; no word has its bytes.
END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))
#: Tokens that a task counts at once.
TOKENS = 4_000_000
#: Most words of a vocabulary file, and tokens of the corpus that a file of pairs stands for, about.
WORDS_PER_FILE, TOKENS_PER_FILE = 1_000_000, 2_000_000
#: Tokens of the corpus for which there is another vocabulary file, so that what is told of its words doesn't grow.
TOKENS_PER_VOCABULARY_FILE = 4_000_000
_LOW = np.uint64(0xFFFFFFFF)
_COLUMNS = ("cont", "total", "n1", "n2", "n3")


class Model(NamedTuple):
    """Where a model's files are, and its totals."""

    folder: str
    #: Words of each vocabulary file, and tokens of all files before it.
    sizes: tuple[int, ...]
    before: tuple[int, ...]
    tokens: int
    texts: int
    pair_files: int
    #: What pairs that begin a text come to: total, with count 1, with 2, with 3 or more.
    begin: tuple[int, int, int, int]
    discounts: tuple[float, float, float]
    #: Of the numbers of different words before a word: their sum, discounts, and words with 1, 2, 3 or more.
    contexts: int
    low_discounts: tuple[float, float, float]
    low_counts: tuple[int, int, int]

    @property
    def words(self) -> int:
        return sum(self.sizes)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2, and 3 or more, from how many counts are 1, 2, 3 and 4.

    Each lies between 0.01 and the count itself. Where one of the numbers is zero, as in tiny corpora: 0.5, 1, 1.5.
    """
    if not (n1 and n2 and n3 and n4):
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(k - (k + 1) * y * b / a, 0.01), float(k)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def token_hashes(text: str) -> np.ndarray:
    """Hashes of the words, A-Z in lower case, and of the end."""
    return np.append(word_hashes(text), END)


def _blocks(batches):
    """Token hashes of many texts in a row, and where each text begins, about TOKENS at once."""
    held, n = [], 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.append(token_hashes(text))
            n += len(held[-1])
            if n >= TOKENS:
                yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])
                held, n = [], 0
    if held:
        yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])


class Vocabulary:
    """Numbers and columns of words, from the files of a folder."""

    def __init__(self, folder: str, sizes, before, tokens: int, texts: int):
        self._folder, self._files, self.words = folder, len(sizes), int(sum(sizes))
        self._from, self._before, self._tokens, self._texts = np.cumsum([0, *sizes]), before, tokens, texts

    def file_of(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(48)) * np.uint64(self._files)) >> np.uint64(16)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each of ascending hashes, -1 if it is not there."""
        out = np.full(len(h), -1, dtype=np.int64)
        for k, part in self._parts(np.searchsorted(self.file_of(h), np.arange(self._files + 1))):
            if (file := get(self._folder, f"words-{k}")) is not None:
                at = places(file["h"], h[part])
                out[part] = np.where(at < 0, -1, at + self._from[k])
        return out

    def column(self, kind: str, name: str, numbers: np.ndarray) -> np.ndarray:
        """A column's values for ascending numbers of words; 0 for numbers that are none."""
        out = np.zeros(len(numbers), dtype=np.int64)
        for k, part in self._parts(np.searchsorted(numbers, self._from)):
            if (file := get(self._folder, f"{kind}-{k}")) is not None:
                out[part] = file[name][numbers[part] - self._from[k]]
        return out

    def _parts(self, cuts):
        return ((k, slice(cuts[k], cuts[k + 1])) for k in range(self._files) if cuts[k] < cuts[k + 1])

    def split(self, numbers: np.ndarray):
        """(file, slice) of ascending numbers."""
        return self._parts(np.searchsorted(numbers, self._from))

    def pair_file(self, keys: np.ndarray, files: int) -> np.ndarray:
        """Which of so many files each of ascending keys belongs to; the number behind the last word begins texts."""
        first, inverse = np.unique(keys >> np.uint64(32), return_inverse=True)
        first = first.astype(np.int64)
        inside = first < self.words
        n, at = np.full(len(first), self._texts, dtype=np.float64), np.full(len(first), self._tokens, dtype=np.float64)
        n[inside] = self.column("words", "n", first[inside])
        at[inside] = self.column("words", "before", first[inside]) + np.asarray(self._before)[np.searchsorted(self._from, first[inside], side="right") - 1]
        spread = mixed(keys & _LOW) / 2.0**64
        place = (at[inverse] + n[inverse] * spread) / max(1, self._tokens + self._texts)
        return np.minimum((place * files).astype(np.int64), files - 1)


def _vocabulary(model: Model) -> Vocabulary:
    return Vocabulary(model.folder, model.sizes, model.before, model.tokens, model.texts)


def _pair_keys(vocabulary: Vocabulary, h: np.ndarray, begins: np.ndarray):
    """Keys of the pairs that end in each token, the different words, and which of them each token is."""
    words, inverse = np.unique(h, return_inverse=True)
    numbers = vocabulary.find(words)
    mine = numbers[inverse]
    first = np.concatenate([mine[:1], mine[:-1]])
    first[begins] = vocabulary.words
    keys = (first.astype(np.uint64) << np.uint64(32)) | (mine.astype(np.uint64) & _LOW)
    return keys, mine, first, numbers, inverse


def _summed(keys: np.ndarray, counts: np.ndarray):
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


_RUNS = "kind string, file int, keys binary, counts binary"


def _runs(rows):
    """A batch of (kind, file, keys, counts)."""
    kind, file, keys, counts = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kind), pa.array(file, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=["kind", "file", "keys", "counts"]
    )


def _gathered(batches):
    """{file: [(kind, keys, counts)]} of a partition."""
    found: dict[int, list] = {}
    for batch in batches:
        for kind, file, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            found.setdefault(file, []).append((kind, keys, counts))
    return found


def train(texts: DataFrame, folder: str | None = None) -> Model:
    """Count a model over the column `text` of all rows; its files are written below `folder`.

    Null texts are empty and teach that a text can end at once. Repeated rows count each time. An
    empty table gives the model in which every token is unknown. There may be 2^32 - 2 different words.
    """
    spark = texts.sparkSession
    small_batches(spark)
    folder = folder or new_folder(spark, "ngram")
    texts = texts.select(text_or_empty().alias("text"))

    def words(batches):
        for h, _ in _blocks(batches):
            found, n = np.unique(h, return_counts=True)
            for i in range(0, len(found), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000])], names=["h", "n"])

    counts = saved(texts.mapInArrow(words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    whole = counts.agg(F.count("*").alias("words"), F.sum("n").alias("tokens"), F.sum(F.when(F.col("h") == int(END.astype(np.int64)), F.col("n"))).alias("texts")).first()
    if whole.words >= 2**32 - 1:
        raise ValueError("more different words than numbers of 32 bits")
    n_words, n_tokens, n_texts = whole.words, whole.tokens or 0, whole.texts or 0
    files = max(1, min(65_536, max(-(-n_words // WORDS_PER_FILE), n_tokens // TOKENS_PER_VOCABULARY_FILE)))

    def write_words(batches):
        found: dict[int, list] = {}
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            n = batch.column(1).to_numpy()
            f = ((h >> np.uint64(48)) * np.uint64(files)) >> np.uint64(16)
            for k in np.unique(f):
                found.setdefault(int(k), []).append((h[f == k], n[f == k]))
        for k, parts in found.items():
            h, n = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h)
            put(folder, f"words-{k}", {"h": h[order], "n": n[order], "before": np.cumsum(n[order]) - n[order]})
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(h)], pa.int64()), pa.array([int(n.sum())], pa.int64())], names=["file", "words", "tokens"])

    file = F.shiftright(F.shiftrightunsigned("h", 48) * files, 16).cast("int")
    made = {r.file: r for r in counts.repartitionById(files, file).mapInArrow(write_words, "file int, words long, tokens long").collect()}
    sizes = tuple(made[k].words if k in made else 0 for k in range(files))
    before = tuple(int(x) for x in np.cumsum([0, *(made[k].tokens if k in made else 0 for k in range(files))])[:-1])
    named = (folder, sizes, before, n_tokens, n_texts)
    pair_files = max(1, -(-(n_tokens + n_texts) // TOKENS_PER_FILE))

    def pairs(batches):
        vocabulary = Vocabulary(*named)
        for h, begins in _blocks(batches):
            keys, n = np.unique(_pair_keys(vocabulary, h, begins)[0], return_counts=True)
            at = vocabulary.pair_file(keys, pair_files)
            order = np.argsort(at, kind="stable")
            keys, n, at = keys[order], n[order].astype("<u4"), at[order]
            heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            cuts = [*heads, len(at)]
            for i in range(0, len(heads), 100):
                yield _runs([("pairs", int(at[a]), keys[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(cuts[i : i + 100], cuts[i + 1 : i + 101])])

    def merge(batches):
        vocabulary = Vocabulary(*named)
        for k, runs in _gathered(batches).items():
            keys, n = _summed(np.concatenate([np.frombuffer(x, "<u8") for _, x, _ in runs]), np.concatenate([np.frombuffer(x, "<u4") for *_, x in runs]).astype(np.int64))
            put(folder, f"pairs-{k}", {"key": keys, "n": n.astype("<u4") if n.max() < 2**32 else n})
            ones = np.stack([n, n == 1, n == 2, n >= 3])
            yield _runs([("counts", -1, b"", np.array([np.sum(n == i) for i in (1, 2, 3, 4)], "<i8").tobytes())])
            first = (keys >> np.uint64(32)).astype(np.int64)
            heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            sums, first = np.add.reduceat(ones, heads, axis=1), first[heads]
            if first[-1] == vocabulary.words:
                yield _runs([("begin", -1, b"", sums[:, -1].astype("<i8").tobytes())])
            for v, part in vocabulary.split(first):
                yield _runs([("first", v, first[part].astype("<i8").tobytes(), sums[:, part].astype("<i8").tobytes())])
            last, n_before = np.unique((keys & _LOW).astype(np.int64), return_counts=True)
            for v, part in vocabulary.split(last):
                yield _runs([("last", v, last[part].astype("<i8").tobytes(), n_before[part].astype("<i8").tobytes())])

    def tell(batches):
        starts = np.cumsum([0, *sizes])
        made: dict[int, dict] = {}
        for batch in batches:
            for kind, v, numbers, values in zip(*(c.to_pylist() for c in batch.columns)):
                out = made.setdefault(v, {c: np.zeros(sizes[v], np.int64) for c in _COLUMNS})
                at = np.frombuffer(numbers, "<i8") - starts[v]
                for c, x in zip(("cont",) if kind == "last" else _COLUMNS[1:], np.frombuffer(values, "<i8").reshape(-1, len(at))):
                    out[c][at] += x
        for v, out in made.items():
            put(folder, f"stats-{v}", out)
            yield _runs([("low", v, b"", np.array([out["cont"].sum(), *(np.sum(out["cont"] == i) for i in (1, 2, 3, 4)), np.sum(out["cont"] >= 3)], "<i8").tobytes())])

    learned = saved(texts.mapInArrow(pairs, _RUNS).repartitionById(pair_files, F.col("file")).mapInArrow(merge, _RUNS))

    def total(rows, kind, size):
        return [int(x) for x in sum((np.frombuffer(r.counts, "<i8") for r in rows if r.kind == kind), np.zeros(size, np.int64))]

    few = learned.where("file < 0").select("kind", "counts").collect()
    low = total(learned.where("file >= 0").repartitionById(files, F.col("file")).mapInArrow(tell, _RUNS).select("kind", "counts").collect(), "low", 6)
    return Model(*named, pair_files, tuple(total(few, "begin", 4)), discounts(*total(few, "counts", 4)), low[0], discounts(*low[1:5]), (low[1], low[2], low[5]))


class Scorer:
    """Scores blocks of tokens by a model, from its mapped files."""

    def __init__(self, model: Model):
        self._model, self._vocabulary = model, _vocabulary(model)

    def _pair_counts(self, keys: np.ndarray, known: np.ndarray) -> np.ndarray:
        found, inverse = np.unique(keys[known], return_inverse=True)
        at = self._vocabulary.pair_file(found, self._model.pair_files)
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], at[order][1:] != at[order][:-1], [True]])) if len(at) else []
        n = np.zeros(len(found), np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = order[a:b]
            if (file := get(self._model.folder, f"pairs-{at[part[0]]}")) is not None:
                place = places(file["key"], found[part])
                n[part] = np.where(place < 0, 0, file["n"][place] if len(file["n"]) else 0)
        out = np.zeros(len(keys), np.int64)
        out[known] = n[inverse]
        return out

    def score(self, h: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: whether it is known, its plain log10 probability, and the model's."""
        m, v = self._model, self._vocabulary
        keys, mine, first, numbers, inverse = _pair_keys(v, h, begins)
        at = numbers[numbers >= 0]
        columns = {}
        for kind, names in (("words", ("n",)), ("stats", _COLUMNS)):
            for name in names:
                column = np.zeros(len(numbers), np.int64)
                column[numbers >= 0] = v.column(kind, name, at)
                columns[name] = column[inverse]
        base = np.log10((columns["n"] + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
        # By the words before it, if any pair tells: what is left of the pair's count, and the rest by the word alone.
        off = np.array([0.0, *m.low_discounts])
        low = np.maximum(columns["cont"] - off[np.minimum(columns["cont"], 3)], 0.0)
        rest = sum(d * n for d, n in zip(m.low_discounts, m.low_counts))
        alone = (low + rest / (m.words + 1)) / m.contexts if m.contexts else np.full(len(h), 1 / (m.words + 1))
        sums = {c: np.concatenate([columns[c][:1], columns[c][:-1]]) for c in _COLUMNS[1:]}
        for c, x in zip(_COLUMNS[1:], m.begin):
            sums[c][begins] = x
        counts = self._pair_counts(keys, (mine >= 0) & (first >= 0))
        off = np.array([0.0, *m.discounts])
        spared = sum(d * sums[c] for d, c in zip(m.discounts, _COLUMNS[2:]))
        told = np.maximum(counts - off[np.minimum(counts, 3)], 0.0) + spared * alone
        seen = sums["total"] > 0
        return mine >= 0, base, np.log10(np.where(seen, told / np.where(seen, sums["total"], 1), alone))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, perplexity of every whole text by a model.

    Scores are log10 probabilities, summed over the words and the end; base_score is that of single tokens with 0.1 added
    to each count. A null text is empty: its end alone. Rows are answered one by one; other columns are ignored; an empty
    table gives an empty result.
    """
    small_batches(docs.sparkSession)
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"]

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [token_hashes(t) for t in batch.column(1).to_pylist()]
            begins = np.cumsum([0, *map(len, held[:-1])])
            known, base, score = scorer.score(np.concatenate(held), begins)
            n, score = np.diff([*begins, len(known)]), np.add.reduceat(score, begins)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (n, np.add.reduceat(known.astype(np.int64), begins), np.add.reduceat(base, begins), score, 10.0 ** np.minimum(-score / n, 300.0)))], names=names
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double")


def held_out() -> Column:
    """Whether a row takes no part in learning: crc32 of doc_id as text, mod 10, is 0. Null doc_ids take part."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 10 == 0, F.lit(False))


def score_corpus(docs: DataFrame) -> DataFrame:
    """`score_texts` of all documents by a model of those that are not held out, with held_out and train_tokens."""
    model = train(docs.where(~held_out()))
    return score_texts(docs, model).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"
    )
