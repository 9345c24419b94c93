"""A quality classifier: naive Bayes features in a linear support vector machine.

A document's features say which n-grams occur in it, not how often: byte 3-grams, and runs of one to
three word shapes (which kinds of characters a word has, and whether it repeats the word before). Each
indicator is scaled by the logarithm of the ratio of its smoothed shares in the two classes, each
document to length 1, and a linear machine with hinge loss is fitted by dual coordinate
descent: one document's multiplier at a time is moved to its optimum within its box. A logistic curve,
fitted to margins of documents that their machine had not seen, turns margins into scores.

The machine learns from a bounded sample, at most ``SAMPLE`` documents per class, those with the
smallest hash of their id. The sample is drawn from the labels alone; its ids, of which there are
at most ``2 * SAMPLE``, are sent to the documents, so no text is shuffled but the sample's. Each whole text
is scored; indicators of a text are found with one table of its n-grams' last places.

Defined results: a null or empty text has no features, and the score of the machine's bias; an id with
several labels has the largest, one with several documents is learned from by its smallest text; without
labels all scores are 0.5, with labels of one class they are that class; a null id is never learned
from; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.storage import small_batches
from weekloom.llm.words import NOT_SPACE, Words, mix, slices

#: Documents per class that the machine learns from, at most.
SAMPLE = 1500
#: Bits of the tables of byte 3-grams and of runs of word shapes.
BYTE_BITS, SHAPE_BITS = 15, 14
FEATURES = (1 << BYTE_BITS) + (1 << SHAPE_BITS)
RUN = 3
SMOOTHING, COST, ROUNDS, FOLDS = 1.0, 1.0, 20, 3


def _shapes(words: Words) -> np.ndarray:
    """A number from 0 to 255 for the shape of each word."""
    x = words.data
    upper, lower = (x >= 0x41) & (x <= 0x5A), ((x >= 0x61) & (x <= 0x7A)) | (x >= 0x80)
    digit = (x >= 0x30) & (x <= 0x39)
    other = words.inside & ~(upper | lower | digit)

    def count(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind)])
        return total[words.ends] - total[words.starts]

    hashes, owners = words.hashes(), words.owners
    repeats = np.zeros(len(words), bool)
    repeats[1:] = (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])
    kinds = (count(upper) > 1, count(lower) > 0, count(digit) > 0, upper[words.starts], repeats)
    shape = np.minimum(count(other), 3)
    for kind in kinds:
        shape = shape << 1 | kind
    return shape.astype(np.uint64)


def _runs(values: np.ndarray, length: int, bits: int) -> np.ndarray:
    """Hashed runs of ``length`` bytes or shapes."""
    n = len(values) - length + 1
    run = values[:n]
    for k in range(1, length):
        run = run << np.uint64(8) | values[k : k + n]
    return (mix(run + np.uint64(length << 40)) >> np.uint64(64 - bits)).astype(np.int32)


def indicators(column: pa.Array):
    """The distinct features of each text in turn."""
    last = np.zeros(FEATURES, np.int32)
    for _, _, data, offsets in slices(column):
        words = Words(data, offsets, NOT_SPACE)
        shapes, wide = _shapes(words), data.astype(np.uint64)
        for i in range(len(offsets) - 1):
            text, shape = wide[offsets[i] : offsets[i + 1]], shapes[words.bounds[i] : words.bounds[i + 1]]
            found = [_runs(text, 3, BYTE_BITS)] if len(text) >= 3 else []
            found += [_runs(shape, k, SHAPE_BITS) + (1 << BYTE_BITS) for k in range(1, RUN + 1) if len(shape) >= k]
            if not found:
                yield np.zeros(0, np.int32)
                continue
            found = np.concatenate(found)
            places = np.arange(len(found), dtype=np.int32)
            last[found] = places
            yield found[last[found] == places]


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the machine for ``y`` in {-1, 1}, by dual coordinate descent on the hinge loss."""
    rng = np.random.default_rng(12)
    w, b, alpha = np.zeros(size), 0.0, np.zeros(len(y))
    curvature = np.array([v @ v + 1 for v in values])  # the bias is a feature of value 1
    for _ in range(ROUNDS):
        moved = 0.0
        for i in rng.permutation(len(y)):
            at, v = rows[i], values[i]
            gradient = y[i] * (w[at] @ v + b) - 1
            new = min(max(alpha[i] - gradient / curvature[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * v
                b += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, b


def log_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Logarithm of each feature's smoothed share among the documents of class 1 over that of class 0."""
    shares = []
    for label in (1, 0):
        total = np.full(FEATURES, SMOOTHING)
        for row, of in zip(rows, y):
            if of == label:
                total[row] += 1
        shares.append(np.log(total / total.sum()))
    return shares[0] - shares[1]


def logistic(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the labels best, with targets kept off 0 and 1."""
    ones, zeros = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    found = np.array([1.0, 0.0])

    def loss(c: np.ndarray) -> float:
        z = x @ c
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 1e-6 * c @ c)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -500, 500)))
        gradient = x.T @ (weight * (p - target)) + 2e-6 * found
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 2e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while loss(found - size * step) > loss(found) and size > 1e-6:
            size /= 2
        found = found - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(found[0]), float(found[1])


@dataclass(frozen=True)
class QualityModel:
    """Score of a text: logistic curve of ``sum(push) / sqrt(sum(square)) + bias`` over its features."""

    push: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, row: np.ndarray) -> float:
        return float(self.push[row].sum() / max(np.sqrt(self.square[row].sum()), 1e-12)) + self.bias

    def score(self, row: np.ndarray) -> float:
        z = self.slope * self.margin(row) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _machine(rows: list[np.ndarray], y: np.ndarray) -> QualityModel:
    ratio = log_ratios(rows, y)
    values = [ratio[row] / max(np.linalg.norm(ratio[row]), 1e-12) for row in rows]
    # Both classes weigh the same, however rare one of them is.
    cost = COST * len(y) / 2 / np.maximum(np.where(y == 1, (y == 1).sum(), (y == 0).sum()), 1)
    w, b = descend(rows, values, np.where(y == 1, 1.0, -1.0), cost, FEATURES)
    return QualityModel(w * ratio, ratio**2, b, 1.0, 0.0)


def _constant(score: float) -> QualityModel:
    shift = {0.0: -500.0, 1.0: 500.0}.get(score, 0.0)
    return QualityModel(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0, shift)


def fit(rows: list[np.ndarray], y: np.ndarray, class_rows: dict[int, int]) -> QualityModel:
    """Machine of all ``rows``; its logistic curve comes from folds, weighted as frequent as the classes
    are among all labels (``class_rows``)."""
    if len(set(y.tolist())) < 2:
        return _constant(float(y[0])) if len(y) else _constant(0.5)
    margins = np.zeros(len(y))
    fold = np.arange(len(y)) % FOLDS
    for k in range(FOLDS):
        seen = np.flatnonzero(fold != k)
        machine = _machine([rows[i] for i in seen], y[seen])
        for i in np.flatnonzero(fold == k):
            margins[i] = machine.margin(rows[i])
    weight = np.array([class_rows[label] / max(1, (y == label).sum()) for label in y.tolist()])
    slope, shift = logistic(margins, y, weight / weight.mean())
    whole = _machine(rows, y)
    return QualityModel(whole.push, whole.square, whole.bias, slope, shift)


def _sampled(batches):
    for batch in batches:
        rows = [np.sort(row).astype("<u2").tobytes() for row in indicators(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("order"), batch.column("label"), pa.array(rows, pa.binary())], ["order", "label", "features"]
        )


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> QualityModel:
    """Train on documents whose label is 0 or 1 and for which ``learn``, a condition on ``doc_id``, holds."""
    small_batches(docs)
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    known = known.where(learn & F.col("label").isin(0, 1)).withColumn("order", F.xxhash64("doc_id"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    # Thin by the hash first, so that the ranking sees a few thousand ids however many labels there are.
    steps = 1 << 20
    share = F.coalesce(*[F.when(F.col("label") == k, F.lit(min(steps, 1 + 4 * SAMPLE * steps // max(1, n)))) for k, n in sizes.items()], F.lit(0))
    thin = known.where(F.pmod("order", F.lit(steps)) < share).groupBy("doc_id", "order").agg(F.max("label").alias("label"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("order", "doc_id"))
    chosen = thin.withColumn("rank", rank).where(F.col("rank") <= SAMPLE).drop("rank")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # At most 2 * SAMPLE ids are broadcast, and as many texts shuffled.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "order", "label").agg(F.min("text").alias("text"))
    found = sample.select("order", "label", "text").mapInArrow(_sampled, "order long, label int, features binary").collect()
    found.sort(key=lambda r: r["order"])
    rows = [np.frombuffer(r["features"], "<u2").astype(np.int32) for r in found]
    return fit(rows, np.array([r["label"] for r in found], np.int64), sizes)


def _score(model: QualityModel):
    def run(batches):
        for batch in batches:
            scores = np.array([model.score(row) for row in indicators(batch.column("text"))], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return run


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (that of label 1) and ``predicted`` of every row."""
    small_batches(docs)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, score double, predicted int")


def held_out(id_col: str = "doc_id") -> Column:
    """A third of the documents, by the checksum of the id's digits, that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
