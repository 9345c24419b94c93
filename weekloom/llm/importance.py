"""Importance resampling towards a target corpus, over hashed runs of one to three words.

The texts of a batch are joined with a separator between them, and one pass of a regular expression
finds all their words and the separators. A search of the words' places among the separators' tells
whose they are; a run of words is a feature if its first and last word belong to one document. All three lengths go
into one count of buckets. A batch is handled in blocks of words that hand their last two words on, so
memory is bounded by a text, not by its number of features.

The bucket of a feature is the CRC-32 of its bytes. CRC-32 is linear, so the sum of a run follows
from those of its words by table look-ups, and no run is ever spelled out.

A first pass counts the buckets of the documents and of the target, and adds them up over the tasks. The
logarithms of the smoothed ratios, one number per bucket, go back to the tasks; a second pass adds
them up per document, and noise from the id makes the largest scores a draw without replacement.

Defined results: a null or empty text has no features and weight 0; a null id draws its noise from
the seed alone; rows that agree in id and score are ranked in the order of the stored rows; without
target texts, the gains rest on the smoothing alone; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.numbering import positions
from weekloom.llm.storage import landed, small_batches

BUCKETS = 10_000
#: Words of a run at most.
RUN = 3
#: Bytes joined at once (a single longer text is joined with none), and about how many are handled at once.
JOINED_BYTES, BLOCK_BYTES = 4 << 20, 1 << 20
SEPARATOR = b"\xff"
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text, or a separator, a byte UTF-8 never has: no class
#: splits a character.
WORD, GAP = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff"), re.compile(rb"[^0-9a-z\x80-\xfe]")


def _crc_table() -> np.ndarray:
    """CRC-32 step of each byte value (reflected polynomial 0xEDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


_STEP = _crc_table()
#: Longest shift, in bytes, with a table of its own; longer ones go by doubling.
_SHORT = 64


def _apply(tables: np.ndarray, at: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    flat, base = tables.reshape(-1), np.int64(1024) * at
    out = flat[base + (crc & 255)]
    for k in (1, 2, 3):
        out ^= flat[base + 256 * k + ((crc >> np.uint32(8 * k)) & 255)]
    return out


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """``[length, byte of the sum, its value]`` of the operator that appends ``length`` bytes; and the same
    for lengths that are powers of two."""
    by_length = np.zeros((_SHORT + 1, 4, 256), np.uint32)
    by_length[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for length in range(_SHORT):
        last = by_length[length]
        by_length[length + 1] = _STEP[last & 255] ^ (last >> 8)
    by_power = np.zeros((40, 4, 256), np.uint32)
    by_power[0] = by_length[1]
    for k in range(39):
        by_power[k + 1] = _apply(by_power, k, by_power[k])
    return by_length, by_power


_BY_LENGTH, _BY_POWER = _shift_tables()


def _shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What ``crc`` contributes to the sum of a text that goes on for ``length`` more bytes."""
    out = _apply(_BY_LENGTH, np.minimum(length, _SHORT), crc)
    far = np.flatnonzero(length > _SHORT)
    if len(far):
        value, rest = crc[far], length[far]
        for k in range(int(rest.max()).bit_length()):
            value = np.where(rest >> k & 1, _apply(_BY_POWER, k, value), value)
        out[far] = value
    return out


_BLANK = np.uint32(zlib.crc32(b" "))
_SEPARATOR_SUM = zlib.crc32(SEPARATOR)


def _words(joined: bytes) -> Iterator[list[bytes]]:
    """All words and separators in order, a block at a time; blocks end between words."""
    at = 0
    while at < len(joined):
        gap = GAP.search(joined, at + BLOCK_BYTES)
        end = gap.start() if gap else len(joined)
        yield WORD.findall(joined, at, end)
        at = end


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Document and bucket of every feature of ``texts``, in blocks. The features of a block are the
    runs that end at one of its words."""
    docs_before = 0
    # The words handed on: document, CRC-32, the same with a blank before, length with the blank.
    handed = [np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.int64)]
    for found in _words(SEPARATOR.join(texts).lower()):
        crc = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
        length = np.fromiter(map(len, found), np.int64, len(found))
        separator = (length == 1) & (crc == _SEPARATOR_SUM)
        # A text's words lie between the separators at its two offsets.
        offsets, word = np.flatnonzero(separator), np.flatnonzero(~separator)
        doc = np.searchsorted(offsets, word) + docs_before
        docs_before += len(offsets)
        crc, length = crc[word], length[word]
        new = [doc, crc, _shifted(np.full(len(crc), _BLANK), length) ^ crc, length + 1]
        old = len(handed[0])
        doc, crc, spaced, length = (np.concatenate(pair) for pair in zip(handed, new))
        docs, sums, run = [doc[old:]], [crc[old:]], crc
        for words in range(2, min(RUN, len(doc)) + 1):
            # Sum of the run of ``words`` that ends at each word but the first few.
            run = _shifted(run[:-1], length[words - 1 :]) ^ spaced[words - 1 :]
            ends_at = np.arange(words - 1, len(doc))
            whole = (doc[: len(doc) - words + 1] == doc[words - 1 :]) & (ends_at >= old)
            docs.append(doc[words - 1 :][whole])
            sums.append(run[whole])
        yield np.concatenate(docs), (np.concatenate(sums) % BUCKETS).astype(np.int64)
        handed = [part[-(RUN - 1) :] for part in (doc, crc, spaced, length)]


def _groups(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts of groups of at most ``JOINED_BYTES``; a null text is empty."""
    first, group, size = 0, [], 0
    for i, text in enumerate(column.cast(pa.binary())):
        text = text.as_py() or b""
        if group and size + len(text) > JOINED_BYTES:
            yield first, group
            first, group, size = i, [], 0
        group.append(text)
        size += len(text)
    if group:
        yield first, group


def _count(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, texts in _groups(batch.column("text")):
            for _, bucket in features(texts):
                total += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    small_batches(texts)
    counted = texts.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(_count, "bucket long, n long")
    total = np.zeros(BUCKETS, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the source."""
    all_s, all_t = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((t + 1.0) * all_s / ((s + 1.0) * all_t) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate that the id and the seed decide."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def _score(gain: np.ndarray, seed: int):
    def run(batches):
        for batch in batches:
            weight, n = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for first, texts in _groups(batch.column("text")):
                last = first + len(texts)
                for doc, bucket in features(texts):
                    n[first:last] += np.bincount(doc, minlength=len(texts))
                    # Sums of whole numbers far below 2**53 are exact in doubles.
                    weight[first:last] += np.bincount(doc, gain[bucket], len(texts)).astype(np.int64)
            score = weight + np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            arrays = [batch.column("doc_id"), pa.array(n), pa.array(weight), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_features", "weight", "score"])

    return run


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = 20,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row; the rank, from 1, of the drawn ones.

    Drawn are the largest scores, ``percent`` of the documents with at least ``min_words`` words, ties
    to the smaller id.
    """
    small_batches(docs)
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scored = rows.mapInArrow(_score(gain, seed), "doc_id long, n_features long, weight long, score long")
    scored = landed(scored.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    # Each of the first words ends one run less than RUN, each later one ends RUN runs.
    enough = F.col("n_features") >= sum(min(k + 1, RUN) for k in range(min_words))
    drawn = scored.where(enough).count() * percent // 100
    ordered = positions(
        scored.withColumn("out", ~enough),
        [F.col("out"), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row")],
        "importance-order",
    )
    rank = F.when(~F.col("out") & (F.col("position") < drawn), F.col("position") + 1)
    return ordered.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
