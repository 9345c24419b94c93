"""Language identification by hierarchical discrimination.

First the language family is predicted, then a language within it. Both steps are linear support
vector machines, one for each pair of classes, whose votes decide; ties go to the larger sum of
margins. Features are the shares of hashed byte 2- and 3-grams of the lower-cased text.

The machines are trained on a bounded sample of labelled documents, at most ``SAMPLE`` per language,
those with the smallest hash of their id, so that the sample depends on neither order nor partitions.
Prediction reads every whole text: it sums the weights of its n-grams, without building histograms.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is everything if
there are no labels to learn from; with one label, it is that one with score 1; rows of a null
language are predicted but not learned from; repeated rows get the same prediction; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.storage import small_batches
from weekloom.llm.words import _LOWER, slices

#: Fixed families; a language outside them is a family by itself.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
SAMPLE = 300
BITS = 13
FEATURES = 2 << BITS
PENALTY, ROUNDS = 1e-4, 30


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.split("-")[0].lower(), lang)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of the 2- and 3-gram at each byte; -1 where it would cross into the next text."""
    x = _LOWER[data].astype(np.uint32)
    # Line ends and tabs are blanks, digits are one digit.
    x[(x >= 9) & (x <= 13)] = 32
    x[(x >= 48) & (x <= 57)] = 48
    two, three = np.full(len(x), -1, np.int32), np.full(len(x), -1, np.int32)
    if len(x) > 1:
        pair = x[:-1] << 8 | x[1:]
        two[:-1] = (pair * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        two[last] = -1
        if len(x) > 2:
            triple = pair[:-1] << 8 | x[2:]
            three[:-2] = ((triple * np.uint32(2246822519)) >> np.uint32(32 - BITS)) + (1 << BITS)
            three[last] = -1
            before = last - 1
            three[before[before >= 0]] = -1
    return two, three


def _histograms(batches):
    """Features and their shares, for the non-zero ones of each whole text."""
    for batch in batches:
        features, shares = [], []
        for _, _, data, offsets in slices(batch.column("text")):
            two, three = _grams(data, offsets)
            for low, high in zip(offsets[:-1], offsets[1:]):
                found = np.concatenate([two[low:high], three[low:high]])
                counts = np.bincount(found[found >= 0], minlength=FEATURES)
                at = np.flatnonzero(counts)
                features.append(at.astype(np.uint16).tobytes())
                shares.append((counts[at] / max(1, counts.sum())).astype(np.float32).tobytes())
        arrays = [batch.column("label"), pa.array(features, pa.binary()), pa.array(shares, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["label", "features", "shares"])


def train_pair(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine for ``y`` in {-1, 1}: averaged stochastic subgradients of the hinge loss."""
    rng = np.random.default_rng(5)
    w, b, mean_w, mean_b, step = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1]), 0.0, 0
    for _ in range(ROUNDS):
        order = rng.permutation(len(y))
        for part in np.array_split(order, max(1, len(order) // 32)):
            step += 1
            rate = 1 / (PENALTY * (step + 100))
            margin = y[part] * (x[part] @ w + b)
            active = part[margin < 1]
            w *= 1 - rate * PENALTY
            if len(active):
                w += rate * (y[active] @ x[active]) / len(part)
                b += 0.01 * rate * PENALTY * y[active].sum() / len(part)
        mean_w += w
        mean_b += b
    return (mean_w / ROUNDS).astype(np.float32), mean_b / ROUNDS


class Machines:
    """One machine for each pair of classes."""

    def __init__(self, x: np.ndarray, labels: list[str]) -> None:
        self.classes = sorted(set(labels))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        of = np.array([self.classes.index(label) for label in labels])
        trained = [train_pair(x[(of == a) | (of == b)], np.where(of[(of == a) | (of == b)] == a, 1.0, -1.0)) for a, b in self.pairs]
        self.weights = np.array([w for w, _ in trained], np.float32).reshape(len(self.pairs), FEATURES)
        self.biases = np.array([b for _, b in trained])

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each row of pairwise margins, and a score from 0 to 1: the mean share of its
        duels that it wins, with margins through a logistic."""
        n, k = len(margins), len(self.classes)
        votes, sums, shares = np.zeros((n, k)), np.zeros((n, k)), np.zeros((n, k))
        for p, (a, b) in enumerate(self.pairs):
            m = margins[:, p]
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            sums[:, a] += m
            sums[:, b] -= m
            share = 1 / (1 + np.exp(-np.clip(3 * m, -30, 30)))
            shares[:, a] += share
            shares[:, b] += 1 - share
        best = (votes + 1e-3 * np.tanh(sums)).argmax(1)
        score = shares[np.arange(n), best] / max(1, k - 1)
        return best, score if k > 1 else np.ones(n)


class Model:
    def __init__(self, x: np.ndarray, labels: list[str]) -> None:
        # Shares are small numbers; one scale for all keeps margins near 1.
        self.scale = float(1 / np.sqrt(np.mean((x**2).sum(1))))
        x = x * np.float32(self.scale)
        families = [family_of(label) for label in labels]
        self.family = Machines(x, families)
        self.within = []
        for family in self.family.classes:
            of = np.array([f == family for f in families])
            self.within.append(Machines(x[of], [label for label, f in zip(labels, families) if f == family]))

    def margins(self, machines: Machines, grams, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, len(machines.pairs)))
        for p in range(len(machines.pairs)):
            table = np.append(machines.weights[p], 0).astype(np.float64)
            total = np.concatenate([[0.0], np.cumsum(table[grams[0]] + table[grams[1]])])
            out[:, p] = np.diff(total[offsets]) * self.scale / np.maximum(counts, 1) + machines.biases[p]
        return out

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        grams = _grams(data, offsets)
        valid = np.concatenate([[0], np.cumsum((grams[0] >= 0).astype(np.int64) + (grams[1] >= 0))])
        counts = np.diff(valid[offsets])
        family, family_score = self.family.decide(self.margins(self.family, grams, offsets, counts))
        names, scores = [""] * len(family), np.zeros(len(family))
        for f, machines in enumerate(self.within):
            of = np.flatnonzero(family == f)
            if not len(of):
                continue
            best, score = machines.decide(self.margins(machines, grams, offsets, counts)[of])
            scores[of] = score * family_score[of]
            for i, k in zip(of, best):
                names[i] = machines.classes[k]
        return names, np.clip(scores, 0.0, 1.0)


def train(docs: DataFrame, label_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> Model | None:
    """Train on at most ``SAMPLE`` labelled documents per language, whole texts of them."""
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"),
        F.xxhash64(id_col).alias("order"),
        F.col(text_col).cast("string").alias("text"),
    )
    counts = labelled.groupBy("label").agg(F.count("*").alias("n"))
    # Thin a frequent language by its hash in the scan, so that the shuffle below sees few texts. There is a machine
    # for each pair of languages, so there are few of them to broadcast. An id is learned from once.
    share = F.least(F.lit(1.0), F.lit(4.0 * SAMPLE) / F.col("n"))
    thin = labelled.join(F.broadcast(counts), "label").where(F.pmod("order", F.lit(1 << 20)) < share * (1 << 20))
    thin = thin.groupBy("label", "order").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("order", "text"))
    sample = thin.withColumn("rank", rank).where(F.col("rank") <= SAMPLE).select("label", "text")
    sample = sample.mapInArrow(_histograms, "label string, features binary, shares binary").collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r["label"], bytes(r["features"]), bytes(r["shares"])))
    x = np.zeros((len(sample), FEATURES), np.float32)
    for row, r in zip(x, sample):
        row[np.frombuffer(r["features"], np.uint16)] = np.frombuffer(r["shares"], np.float32)
    return Model(x, [r["label"] for r in sample])


def _predict(model: Model | None):
    def run(batches):
        for batch in batches:
            names, scores = [], []
            for first, last, data, offsets in slices(batch.column("text")):
                if model is None:
                    found, score = ["und"] * (last - first), np.zeros(last - first)
                else:
                    found, score = model.predict(data, offsets)
                names += found
                scores.append(score)
            letters = batch.column("has_letter").to_pylist()
            names = [n if h else "und" for n, h in zip(names, letters)]
            score = np.concatenate(scores) if scores else np.zeros(0)
            score[[n == "und" for n in names]] = 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def held_out(id_col: str = "doc_id"):
    """A fifth of the documents, by the checksum of the id's digits, that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    small_batches(docs)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        held_out(id_col).alias("held_out"),
        text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
    )
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
