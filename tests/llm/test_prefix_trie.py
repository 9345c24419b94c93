import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.llm import prefix_trie as trie
from weekloom.llm.prefix_trie import NodeTable, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """All nodes by their full sequences."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))

    def digest(turn):
        role, text = turn[1].encode(), turn[2].encode()
        packed = hashlib.blake2b(len(role).to_bytes(8, "little") + role + text, digest_size=16).digest()
        return np.frombuffer(packed, np.int64).tolist()

    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(t)))
    whole = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        whole[conv] = [t[1:] for t in own.get(conv - conv % 5, [])[:h] + own[conv][h:]]
    members = defaultdict(list)
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[c] for c in children[key]) or 1
        last = len(key[-1][1].encode()) if key else 0
        saved[key] = sum(saved[c] for c in children[key]) + (len(members[key]) - 1) * last
    out = []
    for key, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        digest_ = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(key), parent, len(convs), len(children[key]), leaves[key], saved[key], digest_))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def got(table):
    return sorted([tuple(r) for r in prefix_trie(table).select(*COLUMNS).collect()], key=repr)


def made(seed, convs, turns, words, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), "t" * rng.randrange(1, words)))
    return rows


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(table) == brute(rows)


@pytest.mark.parametrize("heavy,band,piece", [(256, 4096, 1 << 20), (3, 4, 20), (0, 1, 1), (1000, 2, 8)])
def test_any_division_gives_the_same_nodes(spark, monkeypatch, heavy, band, piece):
    monkeypatch.setattr(trie, "HEAVY", heavy)
    monkeypatch.setattr(trie, "BAND", band)
    monkeypatch.setattr(trie, "PIECE_BYTES", piece)
    monkeypatch.setattr(trie, "SHARD_NODES", 7)
    rows = made(4, range(120), 8, 3) + [(c, t, "user", "same") for c in range(200, 240) for t in range(10)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_one_conversation_holds_a_third_of_all_turns(spark):
    rng = random.Random(8)
    rows = made(5, range(-12, 60), 8, 4) + [(33, t, "user", "x" * rng.randrange(3)) for t in range(400)]
    rows += [(30, t, "user", "x") for t in range(300)] + [(31, 7, "user", "again")] * 40
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [(1, None, None, "a"), (1, None, None, "a"), (1, 2, "user", None), (1, 2, "", ""), (2, 1, "u", "é"), (2, 1, "ué", "")]
    rows += [(None, 0, "user", "lost"), (5, 0, "user", "a"), (5, 1, "user", "b"), (7, 3, None, None), (10, -1, "user", ""), (10, None, "user", "")]
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("part", "pos", "h", "k1", "row", "last", "depth"):
        table = table.withColumn(name, F.lit("clash"))
    assert got(table) == brute(rows)


def test_no_conversations(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)) == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 50_000])
def test_table_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    k1, k2 = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64)
    table = NodeTable(k1, k2)
    assert sorted(table.slots.tolist()) == list(range(n))
    assert np.array_equal(table.find(k1, k2), table.slots)
    assert (table.find(k2, k1) == -1).all()


def test_equal_digests_are_refused():
    with pytest.raises(ValueError):
        NodeTable(np.ones(2, np.uint64), np.ones(2, np.uint64))


def test_hot_group_spreads_over_tasks(spark):
    """A conversation with a third of all turns, and a first turn that a third of them share."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, t, "user", str(t)) for t in range(2000)] + made(6, range(100, 400), 8, 3)
        stored = trie.paths(spark.createDataFrame(rows, SCHEMA).repartition(4))
        assert stored.where("conv_id = 1").select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
