"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct word shingles. Its sketch holds, per register, the minimum of
an exponential hash over the set, spaced exponentially with base ``b`` and truncated: registers are
mergeable by their maximum, and two are equal about as often as the sets are similar. Bands of
registers give buckets; the likelihood of the registers' order relations, given both set sizes,
gives a joint estimate of the Jaccard similarity; what may reach the threshold is confirmed on the
full sets.

Equal sets are one node from the start, so copies cost one row. A bucket of k nodes yields k - 1
pairs, of each node with the bucket's first. Their confirmed links give components. Only where a
bucket then still holds several components do the nodes outside its largest component meet the rest
of it, in groups of bounded size; pairs across components that the estimate doesn't rule out are
confirmed within the group, and only links leave it. Pairs within a component can't change it; so no
link that matters is lost, and no bucket is expanded into all its pairs.

Defined results: a document of fewer words than a shingle is one shingle, its whole sequence; one
without words, or a null text, is empty and linked with nothing; rows that share an id keep their own
rows and count with their own texts; a null id never names a component that has other ids; an empty
table gives an empty one. All columns of the input are kept under ``document``, so that none can
clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from weekloom.llm.components import connected_components
from weekloom.llm.words import Words, decompressed, mix, packed_slices, slices, windows
from weekloom.llm.storage import landed, small_batches

REGISTERS = 100
BASE, RATE, TOP = 1.02, 20.0, (1 << 16) - 2
#: Nodes of a bucket that meet as many others in one go.
BLOCK = 256
_random = np.random.default_rng(11)
_FACTORS = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_SECOND = np.uint64(0x5851F42D4C957F2D)


def rows_per_band(threshold: float) -> int:
    """The most registers per band with which a pair at the threshold is missed in all bands at
    most once in 100,000."""
    for rows in range(10, 1, -1):
        if (1 - threshold**rows) ** (REGISTERS // rows) <= 1e-5:
            return rows
    return 1


def _shingles(words: Words, length: int):
    """Hash and owner of the distinct shingles, grouped by owner."""
    hashes, at = words.hashes(), words.places(length)
    owner = words.owners
    keys, owners = [windows(hashes, length)[at]], [owner[at]]
    for short in range(1, length):
        texts = np.flatnonzero(words.counts == short)
        if len(texts):
            # Salted by the length, so as not to equal a shingle by chance of construction.
            keys.append(windows(hashes, short)[words.bounds[texts]] ^ np.uint64(short))
            owners.append(texts)
    key, who = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((key, who))
    key, who = key[order], who[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
    return key[new], who[new]


def _registers(minima: np.ndarray) -> np.ndarray:
    uniform = (minima.astype(np.float64) + 0.5) / 2.0**64
    level = np.floor(1 - np.log(-np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE) / math.log(BASE))
    return np.clip(level, 0, TOP + 1).astype(np.uint16)


def _sketches(shingle: int):
    def run(batches):
        # Packed here rather than by an expression before: each kind of Python work in a stage has a worker of its own.
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            rows = batch.column("row").to_numpy()
            n = len(rows)
            sizes = np.zeros(n, np.int64)
            digest = np.zeros((n, 2), np.uint64)
            registers = np.zeros((n, REGISTERS), np.uint16)
            # Texts without shingles get a key of their own, which keeps joins on it even.
            digest[:, 0] = mix(rows.astype(np.uint64))
            for first, _, data, offsets in slices(batch.column("text")):
                key, who = _shingles(Words(data, offsets, lower=True), shingle)
                if not len(key):
                    continue
                starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                to = first + who[starts]
                sizes[to] = np.diff(np.r_[starts, len(key)])
                digest[to, 0] = np.add.reduceat(mix(key), starts)
                digest[to, 1] = np.add.reduceat(mix(key ^ _SECOND), starts)
                for j in range(REGISTERS):
                    minima = np.minimum.reduceat(key * _FACTORS[j] + _SHIFTS[j], starts)
                    registers[to, j] = _registers(minima)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("others"),
                    pa.array([pack(t.as_py()) if t.is_valid else None for t in batch.column("text").cast(pa.binary())], pa.binary()),
                    pa.array(sizes),
                    pa.array([d.tobytes() for d in digest], pa.binary()),
                    pa.array([r.tobytes() for r in registers], pa.binary()),
                ],
                ["row", "doc_id", "others", "packed", "n_shingles", "node", "registers"],
            )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _bands(rows: int):
    def run(batches):
        for batch in batches:
            registers, nodes = _matrix(batch.column("registers")).astype(np.uint64), batch.column("node")
            for band in range(REGISTERS // rows):
                key = np.full(len(nodes), band + 1, np.uint64)
                for j in range(band * rows, (band + 1) * rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, j] + np.uint64(1))
                bands = pa.array(np.full(len(nodes), band, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), bands, nodes], ["key", "band", "node"])

    return run


_GRID = np.linspace(0.0, 1.0, 101)


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of register rows with known set sizes."""
    above = (left > right).sum(1)
    below = (left < right).sum(1)
    equal = left.shape[1] - above - below
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))

    def share(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    p, q = share(u - v * j), share(v - u * j)
    tiny = 1e-12
    likelihood = (
        above[:, None] * np.log(p + tiny)
        + below[:, None] * np.log(q + tiny)
        + equal[:, None] * np.log(np.maximum(1 - p - q, 0) + tiny)
    )
    return j[np.arange(len(j)), likelihood.argmax(1)]


def _possible(left, right, n_left, n_right, threshold: float) -> np.ndarray:
    """False only where the sizes rule the link out, or the estimate lies more than four standard
    errors below the threshold."""
    slack = 4 * math.sqrt(threshold * (1 - threshold) / REGISTERS)
    out = np.minimum(n_left, n_right) >= threshold * np.maximum(n_left, n_right) - 1e-9
    at = np.flatnonzero(out)
    for part in np.array_split(at, max(1, len(at) // 4096 + 1)):
        if len(part):
            found = estimate(left[part], right[part], n_left[part], n_right[part])
            out[part] = found >= threshold - slack
    return out


def _estimated(threshold: float):
    def run(batches):
        for batch in batches:
            keep = _possible(
                _matrix(batch.column("registers_a")),
                _matrix(batch.column("registers_b")),
                batch.column("n_a").to_numpy(),
                batch.column("n_b").to_numpy(),
                threshold,
            )
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _pair_places(starts: np.ndarray, ends: np.ndarray, most: int = 1 << 16):
    """Index pairs within each of the ranges, some at a time."""
    ends_of = np.repeat(ends, ends - starts)
    rows = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)]) if len(starts) else starts
    partners = ends_of - rows - 1
    cuts = np.concatenate([[0], np.cumsum(partners)])
    first = 0
    while first < len(rows):
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + most, "right")) - 1)
        count = partners[first:last]
        left = np.repeat(rows[first:last], count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        yield left, left + 1 + step
        first = last


def _first_band(left: np.ndarray, right: np.ndarray, rows: int) -> np.ndarray:
    """The first band in which two register rows agree; both share a bucket, so there is one."""
    bands = left.shape[1] // rows
    same = (left == right)[:, : bands * rows].reshape(len(left), bands, rows).all(2)
    return same.argmax(1)


def _across(shingle: int, threshold: float):
    """Confirmed links between components in each (key, block, chunk): between its rows of side 0 and
    those of side 1. The rows come sorted by these. A pair is looked at in its first common bucket."""
    rows_in_band = rows_per_band(threshold)

    def links(table: pa.Table):
        table = table.combine_chunks()
        parts = [table.column(n).to_numpy() for n in ("key", "block", "chunk")]
        change = np.ones(len(table), bool)
        change[1:] = np.any([p[1:] != p[:-1] for p in parts], axis=0)
        starts = np.flatnonzero(change)
        ends = np.r_[starts[1:], len(table)]
        side, band = table.column("side").to_numpy(), table.column("band").to_numpy()
        nodes = table.column("node").combine_chunks()
        names = np.array(table.column("root").to_pylist(), dtype=object)
        _, root = np.unique(names, return_inverse=True)
        registers, sizes = _matrix(table.column("registers").combine_chunks()), table.column("n_shingles").to_numpy()
        packed = table.column("packed").combine_chunks().dictionary_encode()
        text_of = packed.indices.to_numpy()
        sets: list[np.ndarray] | None = None
        joined: set[tuple[int, int]] = set()
        for left, right in _pair_places(starts, ends):
            wanted = (side[left] != side[right]) & (root[left] != root[right])
            left, right = left[wanted], right[wanted]
            wanted = _first_band(registers[left], registers[right], rows_in_band) == band[left]
            left, right = left[wanted], right[wanted]
            keep = _possible(registers[left], registers[right], sizes[left], sizes[right], threshold)
            left, right = left[keep], right[keep]
            if not len(left):
                continue
            if sets is None:
                sets = _sets(packed.dictionary, shingle)
            heads = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
            for low, high in zip(heads, np.r_[heads[1:], len(left)]):
                a, others = left[low], right[low:high]
                own = sets[text_of[a]]
                theirs = [sets[text_of[b]] for b in others]
                bounds = np.cumsum([0, *map(len, theirs)])
                every = np.concatenate(theirs)
                place = np.minimum(np.searchsorted(own, every), len(own) - 1)
                common = np.add.reduceat((own[place] == every).astype(np.int64), bounds[:-1])
                for b in others[_reaches(common, len(own), np.diff(bounds), threshold)]:
                    pair = (root[a], root[b])
                    if pair not in joined:
                        joined.add(pair)
                        yield pa.RecordBatch.from_arrays([nodes.take(pa.array([a])), nodes.take(pa.array([b]))], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = [held.column(n).to_numpy() for n in ("key", "block", "chunk")]
            last = np.all([k == k[-1] for k in keys], axis=0)
            whole = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if whole:
                yield from links(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and len(held):
            yield from links(held)

    return run


def _reaches(common, size, other_size, threshold: float):
    """Whether the Jaccard similarity is ``threshold`` at least, in whole numbers."""
    return 10_000 * common >= round(threshold * 10_000) * (size + other_size - common)


def _sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each packed text."""
    out = []
    for _, _, data, offsets in packed_slices(column):
        key, who = _shingles(Words(data, offsets, lower=True), shingle)
        out += np.split(key, np.searchsorted(who, np.arange(1, len(offsets) - 1)))
    return out


def _confirmed(shingle: int, threshold: float):
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                # The same text is in many pairs of a batch: make its set once.
                left, right = part.column("packed_a").dictionary_encode(), part.column("packed_b").dictionary_encode()
                a, b = _sets(left.dictionary, shingle), _sets(right.dictionary, shingle)
                keep = []
                for x, y in zip(left.indices.to_pylist(), right.indices.to_pylist()):
                    common = len(np.intersect1d(a[x], b[y], assume_unique=True))
                    keep.append(bool(_reaches(common, len(a[x]), len(b[y]), threshold)))
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return run


@arrow_udf(StringType())
def _unpacked(column: pa.Array) -> pa.Array:
    texts = decompressed(column).cast(pa.string())
    return pa.array([None if z is None else t for z, t in zip(column.to_pylist(), texts.to_pylist())], pa.string())


def _texts(nodes: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """``node`` and ``packed``, one of its texts, of the given nodes."""
    at = sets.select("node", "row").join(nodes.distinct(), "node").select("row", "node")
    return landed(rows.select("row", "packed").join(at, "row").select("node", "packed"), "near-texts")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows with ``document`` (the input's columns), ``n_shingles``, ``component_id`` (smallest id
    of the component) and ``kept`` (true for one row of each component, the first of that id)."""
    small_batches(docs)
    kept_columns = [c for c in docs.columns if c != text_col]
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept_columns)])
    plain = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        others.alias("others"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    kind = plain.schema["others"].dataType.simpleString()
    rows = landed(
        plain.mapInArrow(
            _sketches(shingle),
            f"row long, doc_id long, others {kind}, packed binary, n_shingles long, node binary, registers binary",
        ),
        "near-rows",
    )
    first = F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "row"))
    sets = landed(
        rows.where("n_shingles > 0")
        .groupBy("node")
        .agg(
            first.alias("first"),
            F.any_value("row").alias("row"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("registers").alias("registers"),
        ),
        "near-sets",
    )
    buckets = sets.select("node", "registers").mapInArrow(_bands(rows_per_band(threshold)), "key long, band int, node binary")
    shared = buckets.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("members")).where("members > 1")
    members = landed(buckets.join(shared, "key"), "near-buckets")

    stars = members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    sketch = {
        s: sets.select(F.col("node").alias(s), F.col("registers").alias(f"registers_{s}"), F.col("n_shingles").alias(f"n_{s}"))
        for s in "ab"
    }
    likely = stars.join(sketch["a"], "a").join(sketch["b"], "b").mapInArrow(_estimated(threshold), "a binary, b binary")
    likely = landed(likely, "near-likely")
    texts = _texts(likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))), sets, rows)
    one, other = (texts.select(F.col("node").alias(s), F.col("packed").alias(f"packed_{s}")) for s in "ab")
    pairs = likely.join(one, "a").join(other, "b").select("a", "b", "packed_a", "packed_b")
    links = landed(pairs.mapInArrow(_confirmed(shingle, threshold), "a binary, b binary"), "near-links")
    roots = connected_components(links)

    # Buckets that still hold several components: each node outside a bucket's largest component
    # meets all others of the bucket, in groups of a block of all and a chunk of such nodes.
    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    shares = labelled.groupBy("key", "root").agg(F.count("*").alias("n"))
    open_keys = shares.groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("outside")
    ).where("outside > 0")
    minor = F.col("root") != F.col("main")
    blocks, chunks = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("members", "outside"))
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), chunks).cast("int")
    as_any = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.struct(block.alias("block"), c.alias("chunk"), F.lit(0).alias("side")))
    as_minor = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(b.alias("block"), chunk.alias("chunk"), F.lit(1).alias("side")))
    meeting = landed(labelled.join(open_keys, "key"), "near-open")
    texts = _texts(meeting.select("node"), sets, rows)
    crossing = (
        meeting.select("key", "band", "node", "root", F.explode(F.when(minor, F.concat(as_any, as_minor)).otherwise(as_any)).alias("at"))
        .select("key", "band", "node", "root", "at.*")
        .join(sets.select("node", "registers", "n_shingles").join(texts, "node"), "node")
        .repartition("key", "block", "chunk")
        .sortWithinPartitions("key", "block", "chunk", "side", "node")
        .select("key", "band", "block", "chunk", "side", "node", "root", "registers", "n_shingles", "packed")
    )
    more = crossing.mapInArrow(_across(shingle, threshold), "a binary, b binary").distinct()
    to_root = {
        s: roots.select(F.col("node").alias(s), F.col("root").alias(f"root_{s}")) for s in "ab"
    }
    joined = (
        more.join(to_root["a"], "a", "left")
        .join(to_root["b"], "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        .distinct()
    )
    merged = connected_components(landed(joined, "near-joined"))
    final = merged.select(F.col("node").alias("root"), F.col("root").alias("final"))
    component = (
        sets.select("node", "first")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(final, "root", "left")
        .select("node", "first", F.coalesce("final", "root").alias("component"))
    )
    heads = component.groupBy("component").agg(F.min("first").alias("head"))
    of_node = component.join(heads, "component").select("node", "head")

    restored = [
        (_unpacked("packed") if c == text_col else F.col(f"others.c{kept_columns.index(c)}")).alias(c) for c in docs.columns
    ]
    id_of = F.when(F.col("head.id") < (1 << 63) - 1, F.col("head.id"))
    return rows.join(of_node, "node", "left").select(
        F.struct(*restored).alias("document"),
        "n_shingles",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(id_of).alias("component_id"),
        (F.col("head").isNull() | (F.col("head.row") == F.col("row"))).alias("kept"),
    )
