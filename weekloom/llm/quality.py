"""Quality rules: base counts of a text, and its divergence from references of the language.

A document becomes two histograms: its characters by class, and its words by the common words of
a language (each common word a cell, all others one). The references are the same histograms of all
documents of a language. A document that lies further from every reference than a limit, by
Jensen-Shannon divergence (base 2, so 0 to 1), is not running text of any of the languages. Below
a minimum of words its histograms say little, so that only the base rules hold there.

References come from counts over all documents, made per batch and summed by Spark. A first pass
finds the words that are frequent in some stretch of text of a language, which each common word must
be, and a second one counts those chosen in all texts. A language with fewer than ``MIN_LANGUAGE``
words is no reference.

Base rules: fewer than 20 words, or more than 30 % of the words in windows of 8 words that occur
twice or more in the text.

Defined results: a null or empty text has no words and fails the base rules; rows of a null language
or of one below the minimum are judged, but are no part of a reference; repeated rows are judged
alike; an empty table gives an empty one; the input's columns come back under ``document``, so
that none can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from weekloom.llm.storage import landed, small_batches
from weekloom.llm.words import NOT_NEWLINE, NOT_SPACE, Words, slices, sums_between, windows

COMMON, MIN_LANGUAGE = 64, 2_000
MIN_WORDS = 50
LIMITS = {"classes": 0.10, "common": 0.25}
MIN_BASE, WINDOW, REPEATED_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"

_BYTES = np.arange(256)
#: Lower case, upper case, digit, white space, sentence marks, symbols, other ASCII, beyond ASCII.
_CLASS = np.full(256, 6)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[~NOT_SPACE] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[list(SYMBOLS)] = 5
_CLASS[0x80:] = 7
CLASSES = 8
_IS_SYMBOL = np.isin(_BYTES, list(SYMBOLS))
_STARTS_CHARACTER = (_BYTES & 0xC0) != 0x80


def _class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Characters of each class of each text."""
    kinds = np.where(_STARTS_CHARACTER[data], _CLASS[data], CLASSES)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    flat = np.bincount(owner * (CLASSES + 1) + kinds, minlength=(len(offsets) - 1) * (CLASSES + 1))
    return flat.reshape(-1, CLASSES + 1)[:, :CLASSES]


def _repeats(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether its text has it twice or more, and whether it had it before."""
    order = np.lexsort((keys, owners))
    same = (keys[order][1:] == keys[order][:-1]) & (owners[order][1:] == owners[order][:-1])
    twice, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    before[order[1:][same]] = True
    return twice, before


def _base(data: np.ndarray, offsets: np.ndarray, words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    n = len(words)
    inside = words.inside
    at = words.places(WINDOW)
    owner = words.owners
    twice, _ = _repeats(windows(hashes, WINDOW)[at], owner[at])
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + WINDOW, -1)
    covered = np.cumsum(change)[:-1] > 0
    lines = Words(data, offsets, NOT_NEWLINE)
    line_hashes = lines.hashes()
    with_word = np.add.reduceat(np.r_[inside, False].astype(np.int64), lines.starts) > 0 if len(lines) else np.zeros(0, bool)
    _, before = _repeats(line_hashes[with_word], lines.owners[with_word])
    return {
        "n_words": words.counts,
        "word_chars": sums_between(inside & _STARTS_CHARACTER[data], offsets),
        "n_symbols": sums_between(_IS_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(lines.owners[with_word][before], minlength=len(offsets) - 1),
        "n_repeat_words": np.bincount(owner[covered], minlength=len(offsets) - 1),
    }


def _reference_counts(batches):
    """Per batch and language: characters by class, and the words frequent in a slice of text."""
    for batch in batches:
        languages = batch.column("lang").to_pylist()
        out = []
        for first, last, data, offsets in slices(batch.column("text")):
            words = Words(data, offsets, lower=True)
            hashes, owners = words.hashes(), words.owners
            classes = _class_counts(data, offsets)
            named = languages[first:last]
            for lang in sorted({x for x in named if x is not None}):
                of = np.array([x == lang for x in named])
                out += [(lang, None, k, int(c)) for k, c in enumerate(classes[of].sum(0))]
                mine = np.flatnonzero(of[owners])
                _, where, counts = np.unique(hashes[mine], return_index=True, return_counts=True)
                out.append((lang, None, CLASSES, len(mine)))
                often = counts >= max(1, len(mine) // 5_000)
                out += [(lang, words.text(mine[w]), -1, int(c)) for w, c in zip(where[often], counts[often])]
        if out:
            lang, word, kind, count = zip(*out)
            text = [None if w is None else w.decode("utf-8", "replace") for w in word]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(text, pa.string()), pa.array(kind, pa.int32()), pa.array(count, pa.int64())],
                ["lang", "word", "kind", "n"],
            )


def _word_keys(words: list[str]) -> np.ndarray:
    texts = pa.array(words, pa.string())
    return np.concatenate([Words(d, o, lower=True).hashes() for _, _, d, o in slices(texts)] or [np.zeros(0, np.uint64)])


def _cells(hashes: np.ndarray, owners: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    """How often each of ``n`` texts has each of the words of ``keys``."""
    order = np.argsort(keys)
    ranked = keys[order]
    place = np.minimum(np.searchsorted(ranked, hashes), len(ranked) - 1)
    hit = ranked[place] == hashes
    width = len(ranked)
    return np.bincount(owners[hit] * width + order[place[hit]], minlength=n * width).reshape(n, width)


def _common_counts(chosen: dict[str, list[str]]):
    keys = {lang: _word_keys(words) for lang, words in chosen.items()}

    def run(batches):
        for batch in batches:
            named = np.array(batch.column("lang").to_pylist(), dtype=object)
            for first, last, data, offsets in slices(batch.column("text")):
                words = Words(data, offsets, lower=True)
                hashes, owners = words.hashes(), words.owners
                for lang, its_keys in keys.items():
                    cells = _cells(hashes, owners, last - first, its_keys)[named[first:last] == lang].sum(0)
                    langs = pa.array([lang] * len(cells), pa.string())
                    places = pa.array(np.arange(len(cells), dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([langs, places, pa.array(cells.astype(np.int64))], ["lang", "place", "n"])

    return run


def references(docs: DataFrame) -> dict[str, dict]:
    """By language: shares of the character classes, the common words and their shares."""
    counted = docs.select("lang", "text").mapInArrow(_reference_counts, "lang string, word string, kind int, n long")
    summed = landed(counted.groupBy("lang", "word", "kind").agg(F.sum("n").alias("n")), "quality-counts")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    # Few rows: nine counts and COMMON words of each language of enough words, however many names there are.
    large = summed.where((F.col("word").isNull()) & (F.col("kind") == CLASSES) & (F.col("n") >= MIN_LANGUAGE)).select("lang")
    summed = summed.join(large, "lang", "left_semi")
    classes = summed.where("word is null").collect()
    common = summed.where("word is not null").withColumn("rank", rank).where(F.col("rank") <= COMMON).collect()
    kinds, chosen = {}, {}
    for r in classes:
        kinds.setdefault(r["lang"], {})[r["kind"]] = r["n"]
    for lang in sorted(kinds):
        words = [r["word"] for r in sorted(common, key=lambda r: r["rank"]) if r["lang"] == lang]
        if kinds[lang].get(CLASSES, 0) >= MIN_LANGUAGE and words:
            chosen[lang] = words
    if not chosen:
        return {}
    exact = docs.select("lang", "text").mapInArrow(_common_counts(chosen), "lang string, place int, n long")
    exact = {(r["lang"], r["place"]): r["n"] for r in exact.groupBy("lang", "place").agg(F.sum("n").alias("n")).collect()}
    out = {}
    for lang, words in chosen.items():
        shares = np.array([kinds[lang].get(k, 0) for k in range(CLASSES)], float)
        cells = np.array([exact[lang, k] for k in range(len(words))], float) / kinds[lang][CLASSES]
        out[lang] = {
            "classes": shares / shares.sum(),
            "words": words,
            "common": np.append(cells, max(0.0, 1 - cells.sum())),
        }
    return out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence, in bits, of each row of ``p`` from ``q``."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum(1)
    return (left + right) / 2


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def _judge(reference: dict[str, dict], text_at: int):
    keys = {lang: _word_keys(r["words"]) for lang, r in reference.items()}

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_jsd", "common_jsd")}
            for _, _, data, offsets in slices(pc.struct_field(batch.column("document"), text_at).cast(pa.string())):
                words = Words(data, offsets)
                for name, values in _base(data, offsets, words, words.hashes()).items():
                    out[name].append(values)
                n = len(offsets) - 1
                lowered = Words(data, offsets, lower=True)
                hashes, owners, total = lowered.hashes(), lowered.owners, lowered.counts
                classes = _shares(_class_counts(data, offsets))
                nearest = {"class": np.full(n, np.inf), "common": np.full(n, np.inf)}
                for lang, r in reference.items():
                    cells = _cells(hashes, owners, n, keys[lang])
                    cells = np.column_stack([cells, total - cells.sum(1)])
                    # One language must be near in both, so the sum decides which is nearest.
                    by_class, by_common = divergence(classes, r["classes"]), divergence(_shares(cells), r["common"])
                    nearer = by_class + by_common < nearest["class"] + nearest["common"]
                    nearest["class"] = np.where(nearer, by_class, nearest["class"])
                    nearest["common"] = np.where(nearer, by_common, nearest["common"])
                out["class_jsd"].append(nearest["class"])
                out["common_jsd"].append(nearest["common"])
            if not out["n_words"]:
                continue
            columns = {k: np.concatenate(v) for k, v in out.items()}
            arrays = [pa.array(v.astype(float if k.endswith("jsd") else np.int64)) for k, v in columns.items()]
            yield pa.RecordBatch.from_arrays([batch.column("document"), *arrays], ["document", *columns])

    return run


def judge(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """All rows with ``document`` (the input's columns), ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``class_jsd``, ``common_jsd`` (infinite without references),
    ``base_failed`` and ``kept``."""
    small_batches(docs)
    # The text travels once, within the document.
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("document")
    )
    named = docs.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    reference = references(named)
    kind = whole.schema["document"].dataType.simpleString()
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    judged = whole.mapInArrow(
        _judge(reference, docs.columns.index(text_col)), f"document {kind}, {counts}, class_jsd double, common_jsd double"
    )
    failed = (F.col("n_words") < MIN_BASE) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    apart = (F.col("class_jsd") > LIMITS["classes"]) | (F.col("common_jsd") > LIMITS["common"])
    far = F.lit(bool(reference)) & (F.col("n_words") >= MIN_WORDS) & apart
    restored = F.struct(*[F.col(f"document.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    return judged.withColumn("base_failed", failed).select(
        restored.alias("document"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "class_jsd", "common_jsd", "base_failed", (~failed & ~far).alias("kept"),
    )
