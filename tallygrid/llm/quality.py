"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches

FEATURES = (
    "log_chars",
    "log_words",
    "word_length",
    "word_length_spread",
    "upper",
    "digit",
    "space",
    "high",
    "stops",
    "bangs",
    "marks",
    "pipes",
    "other_punctuation",
    "distinct_words",
    "adjacent_repeats",
    "distinct_lines",
    "line_length",
    "short_words",
)
D = len(FEATURES)
#: From this score on a document is predicted to be good.
THRESHOLD = 0.7
#: Labelled documents that the classifier learns from at the most.
TEACHING = 200_000
#: Parts of the learned rows by which the weights are chosen, and the pairs (shrink, ridge) tried, the strongest first.
FOLDS = 5
WEIGHTS = tuple((shrink, ridge) for shrink in (0.8, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02) for ridge in (0.3, 0.1, 0.03, 0.01))

_UPPER = np.array([chr(b).isupper() and b < 128 for b in range(256)])
_DIGIT = np.array([48 <= b < 58 for b in range(256)])
_SPACE = np.array([b in b" \t\n\r\v\f" for b in range(256)])
_HIGH = np.arange(256) > 127
_STOPS, _BANGS, _PIPES = ([b in s for b in range(256)] for s in (b".,", b"!?", b"|\\~_<>{}[]"))
_MARKS = [b in b"%&*#$@^+=" for b in range(256)]
_OTHER = [chr(b) in "\"'()-/:;`" for b in range(256)]
_CLASSES = np.array([_UPPER, _DIGIT, _SPACE, _HIGH, _STOPS, _BANGS, _MARKS, _PIPES, _OTHER], dtype=float)


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text; shares as the square root, counts as log(1 + n)."""
    data = text.encode("utf-8", "surrogatepass")
    counts = _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = np.sqrt(counts / max(1, len(data)))
    words = data.split()
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    lines = [x for x in data.split(b"\n") if x]
    upper, digit, space, high, stops, bangs, marks, pipes, other = shares.tolist()
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(sizes.mean()),
        np.log1p(sizes.std()),
        upper,
        digit,
        space,
        high,
        stops,
        bangs,
        marks,
        pipes,
        other,
        np.log1p(len(set(words))) / np.log1p(n),
        np.sqrt(sum(map(bytes.__eq__, words, words[1:])) / n),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(data) / max(1, len(lines))),
        np.sqrt(float((sizes <= 3).mean())),
    ]


def document_statistics(docs: DataFrame, label: str | None = None) -> DataFrame:
    """doc_id, x array<double> and the label column, if one is named; a row per row of `docs`. A null text is empty."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows = [statistics(t or "") for t in batch.column(1).to_pylist()]
            arrays = [batch.column(0), pa.array(rows, pa.list_(pa.float64())), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "x", "label"][: len(arrays)])

    more = [F.col(label).cast("int").alias("label")] if label else []
    schema = "doc_id long, x array<double>" + ", label int" * len(more)
    return docs.select(F.col("doc_id").cast("long"), "text", *more).mapInArrow(run, schema)


@dataclass
class Discriminant:
    """Per class: log prior, mean, lower Cholesky factor of the covariance, log determinant."""

    classes: dict[int, tuple[float, np.ndarray, np.ndarray, float]]

    @classmethod
    def from_sums(cls, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float, ridge: float):
        """From (n, sum, sum of outer products) per class.

        Each class covariance is drawn by `shrink` toward the pooled one, and that by
        `ridge` toward its diagonal, with a floor on the variances.
        """
        total = sum(n for n, _, _ in sums.values())
        covs, pooled = {}, np.zeros((D, D))
        for c, (n, s, ss) in sums.items():
            mean = s / n
            scatter = ss - n * np.outer(mean, mean)
            pooled += scatter
            covs[c] = (n, mean, scatter / max(1.0, n - 1.0))
        pooled /= max(1.0, total - len(sums))
        pooled = (1 - ridge) * pooled + ridge * np.diag(np.diag(pooled)) + 1e-4 * np.eye(D)
        classes = {}
        for c, (n, mean, cov) in covs.items():
            weight = max(shrink, D / (D + n))
            mixed = (1 - weight) * cov + weight * pooled
            factor = np.linalg.cholesky(mixed)
            classes[c] = (np.log(n / total), mean, factor, 2 * float(np.log(np.diag(factor)).sum()))
        return cls(classes)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, priors included, by rows of x; needs both classes."""
        logs = {}
        for c, (prior, mean, factor, logdet) in self.classes.items():
            z = np.linalg.solve(factor, (x - mean).T)
            logs[c] = prior - 0.5 * ((z * z).sum(axis=0) + logdet)
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 by rows of x. With one class learned it is that class; with none, 0.5."""
        if len(self.classes) < 2:
            return np.full(len(x), {(): 0.5, (0,): 0.0, (1,): 1.0}[tuple(self.classes)])
        return 1 / (1 + np.exp(np.clip(-self.margin(x), -700, 700)))


Sums = dict[int, tuple[float, np.ndarray, np.ndarray]]


def class_sums(labelled: DataFrame) -> dict[int, Sums]:
    """By fold and label (n, sum, sum of outer products) of x, over rows (x, label, fold). One matrix each comes to the driver."""

    def run(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), dtype=float).reshape(-1, D)
            x = np.hstack([np.ones((len(x), 1)), x])
            keys = np.array([batch.column(2).to_pylist(), batch.column(1).to_pylist()], dtype=int).T
            for key in {*map(tuple, keys.tolist())}:
                rows = x[(keys == key).all(axis=1)]
                held[key] = held.get(key, 0) + rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f for f, _ in held], pa.int32()),
                pa.array([c for _, c in held], pa.int32()),
                pa.array([m.ravel().tolist() for m in held.values()], pa.list_(pa.float64())),
            ],
            names=["fold", "label", "m"],
        )

    parts = labelled.select("x", F.col("label").cast("int"), F.col("fold").cast("int")).mapInArrow(run, "fold int, label int, m array<double>")
    found = parts.select("fold", "label", F.posexplode("m").alias("i", "v")).groupBy("fold", "label", "i").agg(F.sum("v").alias("v")).collect()
    matrices: dict[tuple[int, int], np.ndarray] = {}
    for r in found:
        matrices.setdefault((r.fold, r.label), np.zeros((D + 1) ** 2))[r.i] = r.v
    out: dict[int, Sums] = {}
    for (fold, label), m in sorted(matrices.items()):
        m = m.reshape(D + 1, D + 1)
        out.setdefault(fold, {})[label] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return out


def together(sums: list[Sums]) -> Sums:
    """The sums of several sets of rows as one."""
    out: Sums = {}
    for part in sums:
        for c, x in part.items():
            out[c] = tuple(a + b for a, b in zip(out[c], x)) if c in out else x
    return dict(sorted(out.items()))


def losses(model: Discriminant, x: np.ndarray, label: np.ndarray) -> float:
    """Sum of -log of the probability of each row's label."""
    return float(np.logaddexp(0, model.margin(x) * np.where(label == 1, -1.0, 1.0)).sum())


def fit(labelled: DataFrame) -> Discriminant:
    """The discriminant of rows (x, label), its weights chosen by those rows alone.

    Rows fall into folds by a hash of x, so that copies of a text lie in one. Each pair of weights
    is tried on every fold with a model of the other folds; the least log loss over all rows
    wins, of equals the stronger weights. Per fold and class one matrix comes to the driver.
    """
    rows = saved(labelled.select("x", "label", F.pmod(F.xxhash64("x"), F.lit(FOLDS)).cast("int").alias("fold")))
    by_fold = class_sums(rows)
    everything = together([*by_fold.values()])
    models = []
    for fold in by_fold:
        others = together([s for f, s in by_fold.items() if f != fold])
        if len(others) == 2:
            models += [(fold, i, Discriminant.from_sums(others, *w)) for i, w in enumerate(WEIGHTS)]
    if not models:
        return Discriminant.from_sums(everything, *WEIGHTS[0])

    def run(batches):
        total = np.zeros(len(WEIGHTS))
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), dtype=float).reshape(-1, D)
            label, at = (np.array(batch.column(i).to_pylist(), dtype=int) for i in (1, 2))
            for fold, i, model in models:
                if (mine := at == fold).any():
                    total[i] += losses(model, x[mine], label[mine])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "loss"])

    told = rows.mapInArrow(run, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
    best = min(told, key=lambda r: (float(f"{r.loss:.9g}"), r.i)).i
    return Discriminant.from_sums(everything, *WEIGHTS[best])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def teaching_labels(labels: DataFrame, most: int = TEACHING) -> DataFrame:
    """(doc_id, label) of the documents to learn from, each once, none of them held out.

    Null labels and labels other than 0 and 1 are passed over; a repeated label counts once, and
    a document whose labels contradict each other teaches nothing. Beyond `most` documents
    those stay whose hashed id lies below the share that leaves about so many.
    """
    named = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
    known = named.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit((most << 30) // n))
    return known


def score_quality(docs: DataFrame, labels: DataFrame, most: int = TEACHING) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Learned from labelled documents that are not held out (crc32 of doc_id as text, mod 4, is
    2), `most` of them at the most; see `teaching_labels` for what counts as labelled and `fit`
    for the choice of the weights. Statistics of every text are computed once and kept in the
    shared folder. A null or empty text is scored like any other; a null doc_id is never held
    out nor labelled; repeated rows are scored one by one, and each teaches; other columns are
    ignored. Without labels of both classes the score is that of the one class, or 0.5.
    """
    stats = saved(document_statistics(docs))
    model = fit(stats.join(F.broadcast(teaching_labels(labels, most)), "doc_id"))

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, D)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"]
            )

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, most: int = TEACHING) -> DataFrame:
    """The documents predicted to be good, with all their columns.

    Learned as `score_quality` does. Only the texts of labelled documents are looked at for
    learning; after that all texts are read once and scored.
    """
    labelled = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(teaching_labels(labels, most)), "doc_id")
    model = fit(document_statistics(labelled, "label"))
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            x = np.array([statistics(t or "") for t in texts], dtype=float).reshape(-1, D)
            yield batch.filter(pa.array(model.score(x) >= THRESHOLD, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
