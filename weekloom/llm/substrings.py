"""Exact removal of repeated passages, found by difference-cover anchors.

A window is ``window`` consecutive words of one document. It is a repeat if its word sequence also
starts earlier: in a document of smaller id, or in the same document before it. Every word that a
repeat covers is removed.

Hashing every window and shuffling it would be the plain way. Here only the positions of a
difference cover are hashed: residues D modulo a period v such that any two residues differ by a
difference of D. For any two equal windows, at i and j, some d < v puts both i + d and j + d on
cover positions, so both hold an equal *anchor* of ``window - v + 1`` words there. Anchors found
once in the corpus are dropped, which rules out nearly all text; around the others the anchor is
extended to whole windows, which are compared by 96-bit hashes.

Hot passages: equal anchors, and equal windows, are first brought together within each batch. Only
the first of them keeps the common hash as its shuffle key; the others are already known to repeat
and travel under keys of their own. So a passage that is in every document sends one row per batch
to one task, not one row per document.

Defined results: a null text has no words; an empty text stays empty; rows of a null id count as
last; rows that share an id are ordered by a hash of their texts, and of fully repeated rows all but one lose
their windows; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.words import Words, compressed, mix, packed_slices, windows
from weekloom.llm.storage import landed, small_batches

#: Perfect difference sets by period.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of two fifths of the window at least."""
    fitting = [v for v in COVERS if window - v + 1 >= max(1, 0.4 * window)]
    return (max(fitting), COVERS[max(fitting)]) if fitting else (1, (0,))


def _known(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which entries have an equal key earlier in ``order``."""
    ranked = key[order]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:]] = ranked[1:] == ranked[:-1]
    return repeated


def _anchors(window: int):
    period, cover = cover_for(window)
    length = window - period + 1
    on_cover = np.isin(np.arange(period), cover)

    def run(batches):
        for batch in batches:
            rows = batch.column("row").to_numpy()
            keys, owners, places = [], [], []
            for first, _, data, offsets in packed_slices(batch.column("packed")):
                words = Words(data, offsets)
                at = words.places(length)
                owner = words.owners[at]
                place = at - words.bounds[owner]
                # A text shorter than a window has no window to repeat.
                keep = on_cover[place % period] & (words.counts[owner] >= window)
                keys.append(windows(words.hashes(), length)[at[keep]])
                owners.append(rows[owner[keep] + first])
                places.append(place[keep])
            if not keys:
                continue
            key, owner, place = np.concatenate(keys), np.concatenate(owners), np.concatenate(places)
            order = np.argsort(key, kind="stable")
            known = _known(key, order)
            # The first of several is known to repeat too, and must still meet other batches.
            leads = np.zeros(len(key), bool)
            leads[order[:-1]] = known[order[1:]]
            signed = np.where(known | leads, -1 - place, place)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(known, mix(owner.astype(np.uint64)), key).view(np.int64)),
                    pa.array(owner),
                    pa.array(signed.astype(np.int32)),
                ],
                ["key", "row", "place"],
            )

    return run


def _read_all(batches, names):
    parts = [[batch.column(n).to_numpy() for n in names] for batch in batches]
    return [np.concatenate([p[i] for p in parts]) for i in range(len(names))] if parts else None


def _repeated_anchors(batches):
    """All anchors of a key are in one partition; keep those that are not alone."""
    read = _read_all(batches, ["key", "row", "place"])
    if read is None:
        return
    key, row, place = read
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    repeated = place < 0
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    place = np.where(place < 0, -1 - place, place).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(row[repeated]), pa.array(place[repeated])], ["row", "place"])


def _windows(window: int):
    period, _ = cover_for(window)

    def run(batches):
        for batch in batches:
            rows = batch.column("row").to_numpy()
            places = batch.column("places")
            at_offsets = places.offsets.to_numpy() - places.offsets[0].as_py()
            at_values = places.flatten().to_numpy()
            out = []
            for first, last, data, offsets in packed_slices(batch.column("packed")):
                words = Words(data, offsets)
                n = len(words)
                base = np.repeat(words.bounds[:-1], np.diff(at_offsets[first : last + 1]))
                anchors = base + at_values[at_offsets[first] : at_offsets[last]]
                # Windows that begin up to v - 1 words before an anchor hold it.
                change = np.zeros(n + period + 1, np.int32)
                np.add.at(change, np.maximum(anchors - period + 1, 0), 1)
                np.add.at(change, anchors + 1, -1)
                wanted = np.cumsum(change)[:n] > 0
                at = words.places(window)
                at = at[wanted[at]]
                owner = words.owners[at]
                hashes = words.hashes()
                out.append(
                    (
                        windows(hashes, window)[at],
                        (windows(hashes, window, 1)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32),
                        rows[owner + first],
                        at - words.bounds[owner],
                    )
                )
            if not out:
                continue
            key, check, row, place = (np.concatenate(c) for c in zip(*out))
            order = np.lexsort((place, row, check, key))
            repeat = _known(check, order) & _known(key, order)
            own = mix(row.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(repeat, own, key).view(np.int64)),
                    pa.array(np.where(repeat, 0, check).astype(np.int32)),
                    pa.array(row),
                    pa.array(np.where(repeat, -1 - place, place).astype(np.int32)),
                ],
                ["key", "check", "row", "place"],
            )

    return run


def _repeated_windows(batches):
    """All but the first window of each key; those known before are marked by their sign."""
    read = _read_all(batches, ["key", "check", "row", "place"])
    if read is None:
        return
    key, check, row, place = read
    marked = place < 0
    order = np.lexsort((place, row, check, key, marked))
    repeat = (_known(check, order) & _known(key, order)) | marked
    place = np.where(marked, -1 - place, place).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(row[repeat]), pa.array(place[repeat])], ["row", "place"])


def _kept(window: int):
    def run(batches):
        for batch in batches:
            unpack = zstandard.ZstdDecompressor().decompress
            totals, removed, kept = [], [], []
            for packed, at in zip(batch.column("packed"), batch.column("places")):
                words = unpack(packed.as_py()).split() if packed.is_valid else []
                totals.append(len(words))
                gone = 0
                if at.is_valid:
                    change = np.zeros(len(words) + 1, np.int32)
                    starts = at.values.to_numpy()
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + window, -1)
                    keep = np.cumsum(change)[:-1] == 0
                    gone = len(words) - int(keep.sum())
                    words = compress(words, keep.tolist())
                removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(totals, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def _gathered(places: DataFrame) -> DataFrame:
    """At most as many places per row as its text has words."""
    return places.groupBy("row").agg(F.collect_list("place").alias("places"))


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``, the words that
    no repeated window covers, joined by single spaces."""
    small_batches(docs)
    # Rows numbered in the order of their ids: what has the smaller number starts earlier.
    sent = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), compressed(F.col(f"`{text_col}`")).alias("packed"))
    in_order = (F.col("doc_id").asc_nulls_last(), F.col("digest"))
    sent = sent.withColumn("digest", F.xxhash64("packed"))
    sent = sent.repartitionByRange(*in_order).sortWithinPartitions(*in_order, "packed").drop("digest")
    rows = landed(sent.withColumn("row", F.monotonically_increasing_id()), "substring-rows")
    around = landed(_gathered(_repeats_of_anchors(rows, window)), "substring-anchors")
    repeats = landed(_gathered(_repeats_of_windows(rows, around, window)), "substring-windows")
    return rows.join(repeats, "row", "left").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, kept_text string"
    )


def _repeats_of_anchors(rows: DataFrame, window: int) -> DataFrame:
    anchors = rows.select("row", "packed").mapInArrow(_anchors(window), "key long, row long, place int")
    return anchors.repartition("key").mapInArrow(_repeated_anchors, "row long, place int")


def _repeats_of_windows(rows: DataFrame, around: DataFrame, window: int) -> DataFrame:
    candidates = rows.select("row", "packed").join(around, "row")
    candidates = candidates.mapInArrow(_windows(window), "key long, check int, row long, place int")
    return candidates.repartition("key").mapInArrow(_repeated_windows, "row long, place int")
