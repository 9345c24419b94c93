"""Token ids in files of independent zstandard frames with a seek table.

One file per partition, in ascending order of the ids:

* one zstandard frame per document: its token ids as little-endian unsigned 32-bit integers;
* a skippable frame (magic 0x184D2A50) with the documents' ids, signed 64-bit;
* a skippable frame (magic 0x184D2A5E) with the seek table: for each document the compressed size, the
  size, and the low 32 bits of XXH64 of its bytes; then the number of frames, a descriptor byte
  (0x80: checksums are there) and the magic 0x8F92EAB1.

Any zstandard reader can decompress such a file as a whole; a reader of some documents reads the
table from the end, and then only their frames, and checks each against its checksum.

The word-level tokenizers here never join text across white space, so a text's ids are its
white-space separated pieces' ids in a row. Arrow splits a batch of texts, finds its distinct pieces and
puts their ids in the texts' order. Each Python worker remembers the ids of words and pieces met last. New
plain words go to the tokenizer's model alone, many in one call, other new pieces to the tokenizer.

A task writes to a file name of its own and returns it; only names that Spark committed to the
manifest count, so a repeated or lost task leaves at most an unlisted file. The folder must be
a path or URI that all executors reach (``spark.checkpoint.dir`` by default).

Defined results: a null or empty text is the end id alone; rows of a null id come first and are
written with the smallest 64-bit id; rows that share an id follow each other, ordered by their text;
an empty table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from weekloom.shared import shared_folder
from weekloom.llm.storage import landed, small_batches

IDS_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
NO_ID = -(1 << 63)
#: Plain words, and other pieces, remembered per Python worker, and the longest that are (bytes).
REMEMBERED, LONGEST = 500_000, 64
#: Strings encoded at once, and bytes up to which small batches are put together.
AT_ONCE, ENOUGH = 10_000, 8 << 20


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 characters for
    themselves, the other bytes in order from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


#: Those of printable bytes that have another letter.
_SPELLED = [(chr(b), letter) for b, letter in _byte_letters().items() if b > 32 and chr(b) != letter]


#: Letters of ASCII and of the Latin-1 supplement: of them and printable ASCII only the case is normalised.
_SMALL, _LARGE = "a-z\u00df-\u00f6\u00f8-\u00ff", "\u00c0-\u00d6\u00d8-\u00de"
_WORD, _PRINTABLE = f"^[{_SMALL}]+$", f"^[!-~{_SMALL}{_LARGE}]+$"
#: The runs into which the vocabulary's own pattern splits that; line feeds are between pieces.
_RUNS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_SMALL}]+|[0-9]|\n|[^{_SMALL}0-9\n]+").findall


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _joined(strings: pa.Array, by: str) -> str:
    whole = pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings)
    return pc.binary_join(whole, pa.scalar(by, strings.type))[0].as_buffer().to_pybytes().decode("utf-8", "replace")


def _binary(ends: np.ndarray, data: bytes) -> pa.Array:
    """The pieces of ``data`` that end at ``ends``."""
    at = np.concatenate([[0], ends]).astype("<i8")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(data)])


class Remembered:
    """Token bytes of the strings met last, a bounded number of them; ``encode`` is asked for others."""

    def __init__(self, encode: Callable[[pa.Array], pa.Array]) -> None:
        self.encode = encode
        self.known, self.tokens = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def of(self, strings: pa.Array) -> pa.Array:
        strings = strings.cast(pa.large_string()).dictionary_encode()
        distinct, at = strings.dictionary, strings.indices
        place = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(place.is_null())
        parts = [self.encode(new.slice(i, AT_ONCE)) for i in range(0, len(new), AT_ONCE)]
        place = place.to_numpy(zero_copy_only=False)
        if len(new):
            place = np.where(np.isnan(place), np.nancumsum(np.isnan(place)) - 1 + len(self.known), place)
        place = place.astype(np.int64)
        tokens = pa.concat_arrays([self.tokens, *parts]).take(pa.array(place))
        # Those met now come first; those unmet for longest are forgotten.
        unmet = np.ones(len(self.known), bool)
        unmet[place[place < len(self.known)]] = False
        short = pc.less_equal(pc.binary_length(distinct), LONGEST)
        for name, met in (("known", distinct), ("tokens", tokens)):
            kept = [met.filter(short), getattr(self, name).filter(pa.array(unmet))]
            setattr(self, name, pa.concat_arrays([pa.concat_arrays(kept).slice(0, REMEMBERED)]))
        return tokens.take(at)


class Pieces:
    """Token bytes of texts, by white-space separated piece."""

    def __init__(self, path: str) -> None:
        # A task has one core; more threads would take other tasks'.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        #: The same model for text that is normalised and split already.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.words, self.others = Remembered(self._words), Remembered(self._others)

    def _words(self, words: pa.Array) -> pa.Array:
        """Token bytes of words that are normalised and split; all of them are one text."""
        spelled = _joined(words, " ").encode().decode("latin-1")
        for byte, letter in _SPELLED:
            spelled = spelled.replace(byte, letter)
        [found] = self.model.encode_batch_fast([spelled], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(words):
            return _binary(4 * ends, ids.tobytes())
        # A vocabulary that doesn't mark where words end.
        each = self.model.encode_batch_fast(spelled.split(" "), add_special_tokens=False)
        return pa.array([_packed(e.ids) for e in each], pa.large_binary())

    def _others(self, pieces: pa.Array) -> pa.Array:
        each = self.tokenizer.encode_batch_fast(_joined(pieces, "\n").split("\n"), add_special_tokens=False)
        return pa.array([_packed(e.ids) for e in each], pa.large_binary())

    def _tokens(self, pieces: pa.Array) -> pa.Array:
        """Token bytes of distinct pieces."""
        word = pc.match_substring_regex(pieces, _WORD)
        runs = pc.and_not(pc.match_substring_regex(pieces, _PRINTABLE), word)
        other = pc.invert(pc.or_(word, runs))
        found = _RUNS(_joined(pieces.filter(runs), "\n").lower() + "\n") if runs.true_count else []
        words = [pieces.filter(word), pa.array([run for run in found if run != "\n"], pieces.type)]
        tokens = self.words.of(pa.concat_arrays(words))
        # A piece of several runs ends where its last run does.
        n = np.flatnonzero(np.array([run == "\n" for run in found], bool))
        ends = np.concatenate([np.arange(1, word.true_count + 1), word.true_count + n - np.arange(len(n))])
        parts = [_binary(np.frombuffer(tokens.buffers()[1], "<i8")[ends], tokens.buffers()[2] or b"")] if len(ends) else []
        if other.true_count:
            parts.append(self.others.of(pieces.filter(other)))
        order = np.concatenate([np.flatnonzero(kind) for kind in (word, runs, other)])
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return pa.concat_arrays(parts).take(pa.array(place))

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The token bytes of each text; a null has none."""
        # Special tokens are looked for before the case is; a text that may hold one is left whole.
        whole = pc.match_substring(texts, "<|").fill_null(False)
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(whole, "", texts)))
        n_pieces = pc.list_value_length(split).fill_null(0).to_numpy(zero_copy_only=False)
        pieces = split.flatten().dictionary_encode()
        at, data = np.zeros(1, "<i8"), b""
        if len(pieces):
            _, at, data = self._tokens(pieces.dictionary).take(pieces.indices).buffers()
            at, data = np.frombuffer(at, "<i8"), memoryview(data or b"")
        at = at[np.concatenate([[0], np.cumsum(n_pieces, dtype=np.int64)])].tolist()
        for text, special, start, end in zip(texts, whole.to_pylist(), at, at[1:]):
            if special:
                text = text.as_buffer().to_pybytes().decode("utf-8", "replace")
                yield _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
            else:
                yield bytes(data[start:end])


_pieces: dict[str, Pieces] = {}


def _pieces_of(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


class FrameWriter:
    """Writes one file; ``add`` a document at a time, then ``close``."""

    def __init__(self, sink) -> None:
        self.sink, self.table, self.ids = sink, [], []
        self.pack = zstandard.ZstdCompressor(level=3, write_checksum=False).compress

    def add(self, doc_id: int, data: bytes) -> None:
        frame = self.pack(data)
        self.sink.write(frame)
        self.ids.append(doc_id)
        self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        ids = np.array(self.ids, "<i8").tobytes()
        self.sink.write(struct.pack("<II", IDS_MAGIC, len(ids)) + ids)
        table = np.array(self.table, "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.table), CHECKSUMS, FOOTER_MAGIC)
        self.sink.write(struct.pack("<II", TABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.sink.close()


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source) -> None:
        self.source = source
        end = source.size()
        n, descriptor, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != FOOTER_MAGIC or descriptor != CHECKSUMS:
            raise ValueError("not a file of frames with a seek table")
        at = end - 9 - 12 * n
        self.table = np.frombuffer(self._read(at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.ids = np.frombuffer(self._read(at - 8 - 8 * n, 8 * n), "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.unpack = zstandard.ZstdDecompressor().decompress

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(size)
        if len(data) != size:
            raise ValueError("the file is cut short")
        return data

    def __len__(self) -> int:
        return len(self.ids)

    def document(self, i: int) -> bytes:
        """The ids' bytes of the ``i``-th document; only its frame is read."""
        data = self.unpack(self._read(int(self.starts[i]), int(self.table[i, 0])))
        if len(data) != self.table[i, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"frame {i} does not match its checksum")
        return data


def _together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of up to ``ENOUGH`` bytes: the fewer, the fewer words are met in several."""
    some, size = [], 0
    for batch in batches:
        if some and size + batch.nbytes > ENOUGH:
            yield pa.concat_batches(some)
            some, size = [], 0
        some.append(batch)
        size += batch.nbytes
    if some:
        yield pa.concat_batches(some)


def _write(folder: str, tokenizer: str, end_id: int):
    end = struct.pack("<I", end_id)

    def run(batches):
        pieces, writer, n_tokens = _pieces_of(tokenizer), None, 0
        where, base = fs.FileSystem.from_uri(folder)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zst"
        for batch in _together(batches):
            ids = batch.column("doc_id").fill_null(NO_ID)
            for doc_id, tokens in zip(ids.to_pylist(), pieces.encode(batch.column("text"))):
                data = tokens + end
                if writer is None:
                    writer = FrameWriter(where.open_output_stream(f"{base}/{name}", compression=None))
                writer.add(doc_id, data)
                n_tokens += len(data) // 4
        if writer is not None:
            writer.close()
            row = [[TaskContext.get().partitionId()], [f"{folder}/{name}"], [len(writer.ids)], [n_tokens]]
            types = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(v, t) for v, t in zip(row, types)]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "path", "n_docs", "n_tokens"])

    return run


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the files and return their manifest: ``part``, ``path``, ``n_docs``, ``n_tokens`` and
    ``start``, the number of ids in all files before. ``tokenizer`` is the path of a tokenizer file that drops
    white space and is found on every executor."""
    small_batches(docs)
    spark = docs.sparkSession
    folder = (folder or shared_folder(spark, "token-files")).rstrip("/")
    where, base = fs.FileSystem.from_uri(folder)
    where.create_dir(base, recursive=True)
    order = (F.col("doc_id").asc_nulls_first(), F.col("text"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # The row number spreads rows that agree in all of these over several files.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "row").sortWithinPartitions(*order)
    manifest = landed(
        rows.select("doc_id", "text").mapInArrow(
            _write(folder, tokenizer, end_id), "part int, path string, n_docs long, n_tokens long"
        ),
        "token-manifest",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _documents(wanted: Sequence[int] | None):
    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                where, inner = fs.FileSystem.from_uri(path)
                with where.open_input_file(inner) as source:
                    reader = FrameReader(source)
                    sizes = reader.table[:, 1] // 4
                    starts = start + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                    at = np.arange(len(reader)) if wanted is None else np.flatnonzero(np.isin(reader.ids, wanted))
                    for first in range(0, len(at), 256):
                        some = at[first : first + 256]
                        ids = pa.array(reader.ids[some], pa.int64(), mask=reader.ids[some] == NO_ID)
                        data = pa.array([reader.document(i) for i in some], pa.binary())
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array(starts[some]), pa.array(sizes[some]), data],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    return run


def read_token_files(manifest: DataFrame, wanted: Sequence[int] | None = None) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` (little-endian bytes) of all documents, or of those
    ``wanted``, of which alone frames are then read."""
    files = manifest.select("path", "start")
    # By number: a repartitioning without one is coalesced to a single task, as the manifest is small.
    files = files.repartition(max(1, files.count()), "path")
    return files.mapInArrow(_documents(wanted), "doc_id long, start long, n_tokens long, ids binary")
