"""The trie of all conversations' prefixes, as one row per node.

Conversations are rebuilt first: a conversation takes the first turns of the head of its family,
as many as a checksum of its id says, and then goes on with its own.

**Prefix digests.** A turn is reduced to 128 bits and its length when it is read; texts are never
shuffled. Turns are sorted in ranges of (conversation, turn), so that one long conversation is spread over
many tasks, and each range sums ``digest * base ** position`` as it streams by. Such sums can be continued
from an earlier range and moved to another position, so neither a conversation that spans ranges nor
a rebuilt one needs a second sort. The two 64-bit sums of a prefix are the key of its node; the root's are 0.

**Node table.** Nodes come from one grouped count. What adds up along the trie, leaves and tokens, concerns
only nodes that two or more conversations share, as below others there is a single path. Nodes with more than
``HEAVY`` members, or a share of 2 ** -20 of all turns if that is more, are heavy; there are at most
2 ** 20 of them, as each holds so many turns of its own. Below them hang light tries, which are dealt into
shards whole, in bands of ``BAND`` depths. In a shard a minimal perfect hash gives every digest a slot: seeds
are tried for buckets of digests until all lie apart, and the table is verified against the digests. Counts
are scattered into flat arrays by slot, and summed through the array of parents' slots, the deepest nodes
first. What reaches a shard's top is added to the parent, in the next band or among the heavy nodes, which make
up the last shard.

**Ends.** The ids of the conversations that end at a node are hashed in order as they stream by in sorted
ranges; only what meets the edge of a range, or is long, is handed on as packed pieces, to be hashed in a second step.
A SHA-256 is sequential, so the pieces of one node are read by one task, a piece at a time.

Defined results: turns of one conversation with equal ``turn``, nulls too, are ordered by the digest of role and
text; repeated rows are turns of their own; a null role or text is empty; rows without a conversation id are
left out; negative ids belong to the family of the next smaller multiple of 5; a table without conversations has no nodes;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.storage import landed, small_batches
from weekloom.llm.words import mix

FAMILY, MOST_HEAD = 5, 8
#: Members from which a node is heavy, at least; depths of a band; nodes of a shard, about; bytes of a piece of ids.
HEAVY, BAND, SHARD_NODES, PIECE_BYTES = 256, 4096, 100_000, 1 << 20
#: Fixed odd bases of the two sums. Both leave 3 when divided by 4, so that ``base - 1`` is divisible by 2 only once.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_MASK = (1 << 64) - 1


# ------------------------------------------------------------------ sums of prefixes


def _power_tables(base: int) -> list[np.ndarray]:
    tables = []
    for k in range(3):
        table = np.full(1 << 16, pow(base, 1 << (16 * k), 1 << 64), np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    return tables


_TABLES = [_power_tables(base) for base in BASES]
_INVERSE = [np.array([pow(base, -k, 1 << 64) for k in range(MOST_HEAD + 1)], np.uint64) for base in BASES]


def _powers(lane: int, exponents: np.ndarray) -> np.ndarray:
    out = _TABLES[lane][0][exponents & 0xFFFF]
    for k in (1, 2):
        if len(exponents) and exponents.max() >> (16 * k):
            out = out * _TABLES[lane][k][(exponents >> (16 * k)) & 0xFFFF]
    return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _record(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


_TURNS = "conv_id long, turn long, t1 long, t2 long, n_bytes long"


def _digests(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        digests = bytearray()
        for role, text in zip(batch.column("role").cast(pa.binary()).to_pylist(), texts):
            digests += hashlib.blake2b(len(role).to_bytes(8, "little") + role + text, digest_size=16).digest()
        t = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        yield _record(conv_id=batch.column("conv_id"), turn=batch.column("turn"), t1=t[:, 0].copy(), t2=t[:, 1].copy(), n_bytes=n)


_STORED = "conv_id long, part long, pos long, q1 long, q2 long, p1 long, p2 long, n_bytes long"


def _prefixes(batches):
    """Number the sorted turns of each conversation within the range, from 1, and sum them up: ``q`` with
    the turn itself, ``p`` without it."""
    conv, count, sums = None, 0, [0, 0]
    for batch in batches:
        if not len(batch):
            continue
        convs = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], convs[1:] != convs[:-1]]))
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(convs))))
        goes_on = conv is not None and convs[0] == conv
        pos = np.arange(len(convs)) - starts[of] + 1
        if goes_on:
            pos[of == 0] += count
        out = {}
        for lane, name in enumerate(("t1", "t2")):
            term = _unsigned(batch.column(name)) * _powers(lane, pos)
            total = np.cumsum(term, dtype=np.uint64)
            before = np.concatenate([np.zeros(1, np.uint64), total])[starts]
            if goes_on:
                before[0] -= np.uint64(sums[lane])
            out[f"q{lane + 1}"] = total - before[of]
            out[f"p{lane + 1}"] = out[f"q{lane + 1}"] - term
        conv, count, sums = convs[-1], int(pos[-1]), [int(out["q1"][-1]), int(out["q2"][-1])]
        part = np.full(len(convs), TaskContext.get().partitionId(), np.int64)
        yield _record(conv_id=convs, part=part, pos=pos, q1=out["q1"], q2=out["q2"], p1=out["p1"], p2=out["p2"], n_bytes=batch.column("n_bytes"))


def _carried(spanning: list) -> dict[tuple[int, int], tuple[int, int, int]]:
    """What the conversations that span ranges bring into each: number and sums of the turns before."""
    carry = {}
    for row in spanning:
        count, sums = 0, [0, 0]
        for part in sorted(row["parts"], key=lambda p: p["part"]):
            carry[row["conv_id"], part["part"]] = (count, *sums)
            sums = [(s + pow(b, count, 1 << 64) * part[q]) & _MASK for s, b, q in zip(sums, BASES, ("q1", "q2"))]
            count += part["n"]
    return carry


def _resolved(carry: dict[tuple[int, int], tuple[int, int, int]]):
    """Positions and sums from the start of the conversation instead of the range."""

    def run(batches):
        spanning = np.array(sorted({conv for conv, _ in carry}), np.int64)
        for batch in batches:
            convs, parts = batch.column("conv_id").to_numpy(), batch.column("part").to_numpy()
            at = np.flatnonzero(np.isin(convs, spanning)) if len(spanning) else []
            if not len(at):
                yield batch
                continue
            out = {name: batch.column(name).to_numpy(zero_copy_only=False).copy() for name in batch.schema.names}
            for conv, part in set(zip(convs[at].tolist(), parts[at].tolist())):
                rows = at[(convs[at] == conv) & (parts[at] == part)]
                count, *sums = carry[conv, part]
                out["pos"][rows] += count
                for lane, names in enumerate((("q1", "p1"), ("q2", "p2"))):
                    factor = np.uint64(pow(BASES[lane], count, 1 << 64))
                    for name in names:
                        moved = out[name][rows].view(np.uint64) * factor + np.uint64(sums[lane])
                        out[name][rows] = moved.view(np.int64)
            yield _record(**out)

    return run


_PATHS = "conv_id long, depth long, k1 long, k2 long, u1 long, u2 long, n_bytes long, last boolean"


def _paths(batches):
    """Key ``k`` and parent's key ``u`` of each rebuilt turn: the sums of the head, and those of the own
    turns after the first ``h``, moved from position ``h`` to ``b``."""
    for batch in batches:
        h, b = (batch.column(c).to_numpy() for c in ("h", "b"))
        out = {}
        for lane, n in enumerate("12"):
            factor = _INVERSE[lane][h - b]
            head, skipped = _unsigned(batch.column(f"head{n}")), _unsigned(batch.column(f"skipped{n}"))
            for name, of in (("k", "q"), ("u", "p")):
                out[name + n] = head + factor * (_unsigned(batch.column(of + n)) - skipped)
        depth = batch.column("pos").to_numpy() - h + b
        yield _record(
            conv_id=batch.column("conv_id"), depth=depth, k1=out["k1"], k2=out["k2"], u1=out["u1"], u2=out["u2"],
            n_bytes=batch.column("n_bytes"), last=batch.column("last"),
        )


def paths(turns: DataFrame) -> DataFrame:
    """One row per conversation and node it belongs to, the root first: ``conv_id``, ``depth``, the
    node's key, its parent's, the bytes of its last text, and whether the conversation ends there."""
    rows = turns.where(F.col("conv_id").isNotNull())
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    # The row number spreads rows that agree in everything over several ranges.
    rows = rows.mapInArrow(_digests, _TURNS).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "row").sortWithinPartitions(*order)
    stored = landed(rows.select("conv_id", "t1", "t2", "n_bytes").mapInArrow(_prefixes, _STORED), "trie-turns")
    part = F.struct("part", F.col("n"), F.col("end.q1").alias("q1"), F.col("end.q2").alias("q2"))
    convs = (
        stored.groupBy("conv_id", "part")
        .agg(F.max("pos").alias("n"), F.max_by(F.struct("q1", "q2"), "pos").alias("end"))
        .groupBy("conv_id")
        .agg(F.sum("n").alias("n"), F.collect_list(part).alias("parts"))
    )
    convs = landed(convs, "trie-conversations")
    # A range's first and last conversation may go on beyond it: at most two rows per range.
    carry = _carried(convs.where(F.size("parts") > 1).collect())
    resolved = stored.mapInArrow(_resolved(carry), _STORED)
    turn = F.struct("pos", "q1", "q2", "p1", "p2", "n_bytes")
    heads = resolved.where(F.col("pos") <= MOST_HEAD).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("first"))
    heads = landed(heads, "trie-heads")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_HEAD + 1))
    info = (
        convs.join(heads, "conv_id")
        .withColumns({"base": base, "h": h})
        .join(heads.select(F.col("conv_id").alias("base"), F.col("first").alias("of_base")), "base", "left")
        .withColumn("of_base", F.slice(F.coalesce("of_base", F.expr("array()")), F.lit(1), F.col("h").cast("int")))
        .withColumn("b", F.size("of_base").cast("long"))
    )
    info = landed(info.drop("base"), "trie-rebuilt")
    nought = F.lit(0).cast("long")

    def at(first: str, position: str, lane: str) -> Column:
        return F.coalesce(F.get(F.col(first), (F.col(position) - 1).cast("int"))[lane], nought)

    moves = {"head1": at("of_base", "b", "q1"), "head2": at("of_base", "b", "q2"), "skipped1": at("first", "h", "q1"), "skipped2": at("first", "h", "q2")}
    columns = ["conv_id", "pos", "q1", "q2", "p1", "p2", "n_bytes", "h", "b", *moves, "last"]
    # Joined by conversation and range, so that a long conversation's turns stay spread.
    of_part = info.select("conv_id", "n", "h", "b", F.explode("parts.part").alias("part"), *[c.alias(k) for k, c in moves.items()])
    own = resolved.join(of_part, ["conv_id", "part"]).where(F.col("pos") > F.col("h")).withColumn("last", F.col("pos") == F.col("n"))
    # The root, and the turns taken from the head: both are in their place already.
    root = F.struct(*[nought.alias(c) for c in ("pos", "q1", "q2", "p1", "p2", "n_bytes")])
    taken = info.select("conv_id", "n", "h", "b", F.inline(F.concat(F.array(root), "of_base")))
    taken = taken.withColumn("last", (F.col("n") <= F.col("h")) & (F.col("pos") == F.col("b")))
    taken = taken.withColumns({c: nought for c in ["h", "b", *moves]})
    return landed(own.select(*columns).unionByName(taken.select(*columns)).mapInArrow(_paths, _PATHS), "trie-paths")


# ------------------------------------------------------------------ node tables


class NodeTable:
    """Minimal perfect hash of distinct 128-bit digests: each has a slot below their number."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray) -> None:
        self.size = len(k1)
        self.buckets = max(1, self.size // 2)
        bucket = self._bucket(k1, k2)
        sizes = np.bincount(bucket, minlength=self.buckets)
        #: The seed of each bucket; of buckets of one digest, the slot itself, as a negative number.
        self.seeds = np.zeros(self.buckets, np.int64)
        order = np.lexsort((bucket, -sizes[bucket]))
        taken, slots = np.zeros(self.size, bool), np.full(self.size, -1, np.int64)
        for size in sorted(set(sizes[sizes > 1].tolist()), reverse=True):
            left = order[sizes[bucket[order]] == size]
            while len(left):
                slot = self._slot(k1[left], k2[left], self.seeds[bucket[left]])
                first = np.full(self.size, len(left), np.int64)
                np.minimum.at(first, slot, np.arange(len(left)))
                apart = ~taken[slot] & (first[slot] == np.arange(len(left)))
                placed = np.repeat(apart.reshape(-1, size).all(1), size)
                slots[left[placed]] = slot[placed]
                taken[slot[placed]] = True
                left = left[~placed]
                self.seeds[bucket[left[::size]]] += 1
                if len(left) and self.seeds[bucket[left]].max() > 1 << 20:
                    raise ValueError("digests are not distinct")
        single, free = np.flatnonzero(sizes[bucket] == 1), np.flatnonzero(~taken)
        slots[single] = free
        self.seeds[bucket[single]] = -1 - free
        self.k1, self.k2 = np.zeros(self.size, np.uint64), np.zeros(self.size, np.uint64)
        self.k1[slots], self.k2[slots] = k1, k2
        self.slots = slots
        if not np.array_equal(self.find(k1, k2), slots):
            raise ValueError("two digests share a slot")

    def _bucket(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        return (mix(k1 ^ mix(k2)) % np.uint64(self.buckets)).astype(np.int64)

    def _slot(self, k1: np.ndarray, k2: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        return (mix(k2 + mix(k1 + seeds.astype(np.uint64))) % np.uint64(self.size)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 of those that are not in the table."""
        seeds = self.seeds[self._bucket(k1, k2)]
        slot = np.where(seeds < 0, -1 - seeds, self._slot(k1, k2, np.maximum(seeds, 0)))
        return np.where((self.k1[slot] == k1) & (self.k2[slot] == k2), slot, -1)


_SUMS = "k1 long, k2 long, n_leaves long, saved long, top boolean, u1 long, u2 long, t1 long, t2 long"


def _accumulate(table: pa.Table) -> pa.Table:
    """Sum leaves and savings of a shard's nodes over their subtrees within the shard."""
    column = {n: table.column(n).combine_chunks() for n in table.schema.names}
    k1, k2, u1, u2 = (_unsigned(column[n]) for n in ("k1", "k2", "u1", "u2"))
    nodes = NodeTable(k1, k2)
    flat = {}
    for name in ("depth", "n_leaves", "saved"):
        flat[name] = np.zeros(nodes.size, np.int64)
        flat[name][nodes.slots] = column[name].to_numpy()
    parent = np.full(nodes.size, -1, np.int64)
    parent[nodes.slots] = np.where(column["depth"].to_numpy() > 0, nodes.find(u1, u2), -1)
    order = np.argsort(-flat["depth"], kind="stable")
    depths = flat["depth"][order]
    for level in np.split(order, np.flatnonzero(depths[1:] != depths[:-1]) + 1):
        inside = level[parent[level] >= 0]
        for name in ("n_leaves", "saved"):
            np.add.at(flat[name], parent[inside], flat[name][inside])
    out = _record(
        k1=k1, k2=k2, n_leaves=flat["n_leaves"][nodes.slots], saved=flat["saved"][nodes.slots],
        top=parent[nodes.slots] < 0, u1=u1, u2=u2, t1=column["t1"], t2=column["t2"],
    )
    return pa.Table.from_batches([out])


def _shard_sums(nodes: DataFrame, shards: int, carried: DataFrame | None, label: str) -> DataFrame:
    """Sums within the shards of ``nodes``, to whose own values is added what ``carried`` brings to them."""
    if carried is not None:
        brought = carried.where("top").groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2"))
        brought = brought.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        nodes = nodes.join(brought, ["k1", "k2"], "left").withColumns(
            {c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in (("n_leaves", "more_leaves"), ("saved", "more_saved"))}
        )
    shard = F.pmod(F.xxhash64("t1", "t2"), F.lit(shards)).alias("shard")
    wanted = nodes.select("k1", "k2", "u1", "u2", "depth", "n_leaves", "saved", "t1", "t2", shard)
    return landed(wanted.groupBy("shard").applyInArrow(_accumulate, _SUMS), label)


def _subtrees(nodes: DataFrame, rows: DataFrame, heavy_from: int) -> DataFrame:
    """``k1``, ``k2``, ``n_leaves`` and ``saved`` of the nodes that several conversations share, and of the root."""
    own = nodes.where("n_convs > 1 or depth = 0").select(
        "k1", "k2", "u1", "u2", "depth", "conv_id", "n_convs",
        (F.col("n_private") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )
    is_heavy = (F.col("n_convs") > heavy_from) | (F.col("depth") == 0)
    heavy_keys = F.broadcast(nodes.where(is_heavy).select("k1", "k2"))  # 2 ** 20 at most
    # The first light node on a conversation's path is the top of the light trie that its nodes belong to.
    tops = rows.join(heavy_keys, ["k1", "k2"], "left_anti").groupBy("conv_id")
    tops = tops.agg(F.min_by(F.struct("k1", "k2"), "depth").alias("t")).select("conv_id", F.col("t.k1").alias("t1"), F.col("t.k2").alias("t2"))
    light = landed(own.where(~is_heavy).join(tops, "conv_id"), "trie-light")
    size = light.agg(F.count("*").alias("n"), F.max(F.floor(F.col("depth") / BAND)).alias("band")).first()
    sums, carried = [], None
    for band in range(size["band"] if size["n"] else -1, -1, -1):
        of_band = light.where(F.floor(F.col("depth") / BAND) == band)
        carried = _shard_sums(of_band, 1 + size["n"] // SHARD_NODES, carried, "trie-sums")
        sums.append(carried)
    none = F.lit(0).cast("long")
    heavy = own.where(is_heavy).withColumns({"t1": none, "t2": none})
    # All light tops hang on heavy nodes, whatever their band.
    hanging = None
    for part in sums:
        hanging = part if hanging is None else hanging.unionByName(part)
    sums.append(_shard_sums(heavy, 1, hanging, "trie-sums"))
    out = sums[0]
    for part in sums[1:]:
        out = out.unionByName(part)
    return out.select("k1", "k2", "n_leaves", "saved")


# ------------------------------------------------------------------ ends


_ENDS = "k1 long, k2 long, sha string, first_id long, piece binary"


def _groups(batches) -> Iterator[tuple[tuple[int, int], list]]:
    """Runs of equal keys within a batch, and the values of the third column."""
    for batch in batches:
        if not len(batch):
            continue
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        edges = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
        values = batch.column(batch.num_columns - 1).to_pylist()
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(k1)]):
            yield (int(k1[low]), int(k2[low])), values[low:high]


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["k1", "k2", "sha", "first_id", "piece"])


def _hash_ids(batches):
    """SHA-256 of the ids of each key of a sorted range; pieces of them for the keys at its edges and long ones."""
    key, first, text, whole, rows = None, None, b"", True, []
    edge = True  # the range's first key may have begun in the range before

    def close(last: bool) -> tuple:
        if whole and not last and not edge:
            return (*key, hashlib.sha256(text).hexdigest(), None, None)
        return (*key, None, first, text)

    for found, ids in _groups(batches):
        if key is not None and found != key:
            rows.append(close(False))
            edge, key = False, None
        if key is None:
            key, first, text, whole = found, ids[0], b"", True
        elif text:
            text += b","
        for low in range(0, len(ids), 1 << 14):
            part = ids[low : low + (1 << 14)]
            if len(text) > PIECE_BYTES:
                rows.append((*key, None, first, text.rstrip(b",")))
                first, text, whole = part[0], b"", False
            elif low:
                text += b","
            text += b",".join(b"%d" % i for i in part)
        if len(rows) >= 4096 or sum(len(r[4] or b"") for r in rows[-8:]) > PIECE_BYTES:
            yield _ends_batch(rows)
            rows = []
    if key is not None:
        rows.append(close(True))
    if rows:
        yield _ends_batch(rows)


def _hash_pieces(batches):
    key, sha, rows = None, None, []
    for found, pieces in _groups(batches):
        if found != key:
            if key is not None:
                rows.append((*key, sha.hexdigest(), None, None))
            key, sha = found, hashlib.sha256()
            sha.update(pieces[0])
            pieces = pieces[1:]
        for piece in pieces:
            sha.update(b"," + piece)
        if len(rows) >= 4096:
            yield _ends_batch(rows)
            rows = []
    if key is not None:
        yield _ends_batch([*rows, (*key, sha.hexdigest(), None, None)])


def _ends(rows: DataFrame) -> DataFrame:
    """``k1``, ``k2`` and ``sha`` of the nodes at which conversations end."""
    ids = rows.where("last").select("k1", "k2", "conv_id")
    hashed = landed(ids.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(_hash_ids, _ENDS), "trie-ends")
    pieces = hashed.where(F.col("sha").isNull()).select("k1", "k2", "first_id", "piece")
    pieces = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first_id").mapInArrow(_hash_pieces, _ENDS)
    return hashed.where(F.col("sha").isNotNull()).unionByName(pieces).select("k1", "k2", "sha")


def prefix_trie(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    small_batches(conversations)
    empty = F.lit("")
    turns = conversations.select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), empty).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), empty).alias("text"),
    )
    rows = paths(turns)
    heavy_from = max(HEAVY, rows.count() >> 20)
    counted = rows.groupBy("k1", "k2").agg(
        F.min("depth").alias("depth"), F.min("u1").alias("u1"), F.min("u2").alias("u2"), F.min("n_bytes").alias("n_bytes"),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
    )
    counted = landed(counted, "trie-nodes")
    children = counted.where("depth > 0").groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2"))
    children = children.agg(F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_private"))
    none = F.lit(0).cast("long")
    nodes = counted.join(children, ["k1", "k2"], "left")
    nodes = landed(nodes.withColumns({c: F.coalesce(c, none) for c in ("n_children", "n_private")}), "trie-counts")
    sums = _subtrees(nodes, rows, heavy_from)
    # A node has no more children than members, so the heavy ones are the only hot parents.
    parent = F.col("conv_id").alias("parent_conv_id"), F.col("k1").alias("u1"), F.col("k2").alias("u2")
    is_heavy = (F.col("n_convs") > heavy_from) | (F.col("depth") == 0)
    below_heavy = nodes.where("depth > 0").join(F.broadcast(nodes.where(is_heavy).select(*parent)), ["u1", "u2"], "left")
    found = below_heavy.where(F.col("parent_conv_id").isNotNull())
    rest = below_heavy.where(F.col("parent_conv_id").isNull()).drop("parent_conv_id")
    rest = rest.join(nodes.where(~is_heavy).select(*parent), ["u1", "u2"])
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    linked = found.unionByName(rest).unionByName(top)
    return (
        linked.join(sums, ["k1", "k2"], "left")
        .join(_ends(rows), ["k1", "k2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            # Below a node of a single conversation there is one path, and nothing to save.
            F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
            F.coalesce("saved", none).alias("saved_tokens"),
            F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
