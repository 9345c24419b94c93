"""Operators whose results a brute-force version states exactly."""

import collections
import itertools
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weekloom.llm import token_files
from weekloom.llm.licenses import NOTICES, PHRASES, WHOLE_TEXTS, Scanner, chained, scan_licenses
from weekloom.llm.mixing import mix
from weekloom.llm.near_duplicates import near_duplicates
from weekloom.llm.quality import judge
from weekloom.llm.sharding import best_fit_decreasing, fewest_capacity, pack
from weekloom.llm.substrings import COVERS, cover_for, remove_repeats

SPACE = rb"[^\x20\x09-\x0D]+"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def split(text):
    return re.findall(SPACE, (text or "").encode())


# ------------------------------------------------------------------ repeated passages


def brute_repeats(rows, window):
    first, out = set(), []
    for _, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words, gone = split(text), set()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in first:
                gone |= set(range(k, k + window))
            first.add(key)
        out.append((len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("window", [20, 9, 2])
def test_repeats_like_brute_force(docs, corpus, window):
    got = remove_repeats(docs, window)
    assert sorted(tuple(r)[1:] for r in got.collect()) == brute_repeats([r[:2] for r in corpus], window)


def test_repeated_rows_lose_their_windows_but_for_one(repeated):
    got = [r for r in remove_repeats(repeated).collect() if r["doc_id"] == 7]
    assert len(got) == 2 and sum(r["n_removed"] == r["n_words"] for r in got) >= 1


def test_covers_are_difference_covers():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert cover_for(20) == (13, (0, 1, 3, 9))


# ------------------------------------------------------------------ near-duplicates


def shingles(text, n):
    words = [w.translate(LOWER) for w in split(text)]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


@pytest.mark.parametrize("length, hundredths", [(3, 85), (5, 80)])
def test_near_duplicates_like_brute_force(docs, corpus, length, hundredths):
    rows = [(r[0], shingles(r[1], length)) for r in corpus]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= hundredths * len(a | b):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[find(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    want = collections.Counter((doc, len(s), least[find(i)]) for i, (doc, s) in enumerate(rows))
    found = near_duplicates(docs, length, hundredths / 100).select(
        "document.doc_id", "n_shingles", "component_id", "kept", F.col("document.row").alias("own"), "document.text"
    ).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == want
    assert sum(r["kept"] for r in found) == len(ids)
    assert {r["own"] for r in found} == {"clash"}
    assert collections.Counter(r["text"] for r in found) == collections.Counter(r[1] for r in corpus)


def test_bucket_of_several_components_is_looked_at_in_full(spark):
    """Two that don't match the bucket's first can still match each other."""
    words = [f"x{k}" for k in range(400)]
    rows = []
    for i in range(60):
        text = list(words)
        for k in range(i * 3, i * 3 + 9):
            text[(k * 7) % 400] = f"new{i}-{k}"
        rows.append((i, " ".join(text)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 0.85)
    sets = {i: shingles(t, 3) for i, t in rows}
    reach = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if reach[j] < reach[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    reach[i], changed = reach[j], True
    assert {r["document"]["doc_id"]: r["component_id"] for r in got.collect()} == reach


# ------------------------------------------------------------------ shards


def test_shards_hold_whole_groups_in_equal_bytes(docs, corpus):
    got = pack(docs, shards=4).collect()
    assert len(got) == len(corpus)
    of_text = collections.defaultdict(set)
    for r in got:
        of_text[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values())
    for shard in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, None if r[1] is None else zlib.crc32(r[1].encode())) for r in corpus)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_shards_of_a_fixed_capacity(docs):
    got = pack(docs, capacity=60_000).collect()
    total = collections.Counter()
    for r in got:
        total[r["shard"]] += r["size"]
    over = [s for s in total if total[s] > 60_000]
    assert all(len({r["text_crc32"] for r in got if r["shard"] == s}) == 1 for s in over)
    assert set(total) == set(range(len(total)))


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(1)
    sizes = sorted(rng.integers(1, 70, 3000).tolist(), reverse=True)
    bins, n = best_fit_decreasing(sizes, 100)
    room, plain = [], []
    for size in sizes:
        fitting = [(r, k) for k, r in enumerate(room) if r >= size]
        k = min(fitting)[1] if fitting else len(room)
        if not fitting:
            room.append(100)
        room[k] -= size
        plain.append(k)
    assert bins == plain and n == len(room)
    load = collections.Counter()
    for size, shard in zip(sizes, fewest_capacity(sizes, 16)):
        load[shard] += size
    assert max(load.values()) <= sum(sizes) / 16 + 2


# ------------------------------------------------------------------ mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = {}, share * sum(sizes.values())
    open_names = set(names)
    while open_names:
        level = left / sum(weight[s] for s in open_names)
        full = {s for s in open_names if level * weight[s] >= most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_names}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_names -= full
    return target


def test_mix_meets_its_targets_and_repeats(docs, corpus):
    got, again = mix(docs).collect(), mix(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes = collections.Counter()
    for r in corpus:
        sizes[r[3]] += len(split(r[1]))
    want = brute_targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == collections.Counter((r[0], len(split(r[1]))) for r in corpus)


def test_expected_copies_are_the_wish(spark):
    rows = [(i, "s", "w " * (1 + i % 9)) for i in range(40)] + [(i, "t", "w " * 7) for i in range(40, 90)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    counts = collections.Counter()
    for seed in range(12):
        for r in mix(table, seed=seed).collect():
            counts[r["source"]] += r["copies"]
            wish = r["target"] / r["source_size"]
            assert int(wish) <= r["copies"] <= int(wish) + 1
    assert counts["s"] / 480 == pytest.approx(2.0, abs=0.1)


# ------------------------------------------------------------------ token files


def test_token_files_round_trip(docs, corpus):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    manifest = token_files.write_token_files(docs, path, 2)
    got = token_files.read_token_files(manifest).collect()
    want, start = [], 0
    ranked = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for r in ranked:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], len(ids), struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    got.sort(key=lambda r: r["start"])
    assert [(r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in got if r["doc_id"] is not None] == [w for w in want if w[0] is not None]
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    some = token_files.read_token_files(manifest, [3, 167]).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in some} == {w[0]: w[2] for w in want if w[0] in (3, 167)}


def test_a_damaged_frame_is_noticed(tmp_path):
    import pyarrow as pa

    target = tmp_path / "a.zst"
    writer = token_files.FrameWriter(pa.OSFile(str(target), "wb"))
    for k in range(3):
        writer.add(k, struct.pack("<4I", k, 1, 2, 3))
    writer.close()
    data = bytearray(target.read_bytes())
    reader = token_files.FrameReader(pa.BufferReader(bytes(data)))
    assert reader.ids.tolist() == [0, 1, 2] and reader.document(1) == struct.pack("<4I", 1, 1, 2, 3)
    data[int(reader.starts[1]) + 8] ^= 255
    damaged = token_files.FrameReader(pa.BufferReader(bytes(data)))
    assert damaged.document(0) and damaged.document(2)
    with pytest.raises(Exception):
        damaged.document(1)


def test_new_words_of_a_batch_go_to_the_tokenizer_together(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, pieces, calls = Tokenizer.from_file(path), token_files.Pieces(path), []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return model.encode_batch_fast(texts, **options)

    model, pieces.model = pieces.model, Counted()
    odd = [
        None, "", " ", " \n\t a  b\r\n", "a\u00a0b\u3000c\x1cd\x85e", "It's don''t I'LL x'S 'tis", "a\x00b \x7f \x1f",
        "<|endoftext|> is A|B <|x", "Öl straße ÀÉÍ íàß\u00ad×÷ ŸŒ İstanbul K Å ﬁ", "e\u0301 \u0301x Ы ы русский, 漢字 한 3½ ١٢",
        "3.14, x=1e-5; [a](http://b.c/d?e=f&g) ###!!", "y" * 500 + " " + "é" * 500 + " Ж" * 3 + "Ж" * 200, "naïve,naïve. NAÏVE!", "😀😀 a😀b",
    ]
    words = [" ".join(f"{stem}{chr(97 + k % 26) * (k // 26 % 9 + 1)}é{k}." for stem in "abc") for k in range(2000)]
    texts = odd + words
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(pieces.encode(pa.array(texts, pa.string()))) == want
    assert calls == [1]
    # What is remembered changes no ids, however little that is.
    for name, value in (("REMEMBERED", 7), ("LONGEST", 5), ("AT_ONCE", 50)):
        monkeypatch.setattr(token_files, name, value)
    few = token_files.Pieces(path)
    for first in [*range(0, len(texts), 40), *range(0, 120, 3)]:
        assert list(few.encode(pa.array(texts[first : first + 40], pa.string()))) == want[first : first + 40]
        assert max(len(few.words.known), len(few.others.known)) <= 7
    assert list(few.encode(pa.array([], pa.string()))) == []
    assert list(few.encode(pa.array(odd, pa.large_string())[3:])) == want[3 : len(odd)]
    # Bytes that are no UTF-8 are replacement characters.
    broken = pa.array([b"a \xff\xc3 \xe9t\xe9, b", b"ok"]).view(pa.string())
    replaced = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("a \ufffd\ufffd \ufffdt\ufffd, b", "ok")]
    assert [np.frombuffer(t, "<u4").tolist() for t in few.encode(broken)] == replaced


def test_small_batches_are_put_together(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"doc_id": [k], "text": ["x" * k]}) for k in range(100)]
    monkeypatch.setattr(token_files, "ENOUGH", 500)
    together = list(token_files._together(batches))
    assert len(together) < 30 and all(b.nbytes <= 500 for b in together)
    assert pa.Table.from_batches(together).equals(pa.Table.from_batches(batches))


# ------------------------------------------------------------------ licenses


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def test_license_phrases_like_brute_force(spark, docs):
    texts = [
        "The MIT-License; mit license! Apache license",
        "GNU General Public\nLicense, MIT",
        "mit licensee, smit license",
        "Released under the MIT License. " * 300,
        "Licensed under CC BY-NC 4.0.",
        "x é license mit " * 3,
        "",
        None,
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    for r in scan_licenses(table.join(table.select("doc_id", F.col("text").alias("same")), "doc_id").where("text <=> same")).collect():
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        words = words_of(text)
        places = {
            label: [k for k in range(len(words)) if words[k : k + len(p.split())] == [w.encode() for w in p.split()]]
            for p, label in PHRASES.items()
        }
        all_places = sorted(k for v in places.values() for k in v)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(all_places))
        assert (r["first_word"], r["last_word"]) == ((all_places[0], all_places[-1]) if all_places else (None, None))
        assert r["base_labels"] == ",".join(sorted(k for k, v in places.items() if v))
    assert got[4]["labels"] == "cc-by-nc" and got[3]["labels"] == "mit" and got[6]["labels"] == ""


def test_matching_statistics_like_brute_force():
    templates = (("a", "x y z x y w"), ("b", "z x q r"), ("c", "y z x y"))
    scanner = Scanner(templates, {"x y": "a"})
    rng = np.random.default_rng(2)
    texts = [t.split() for _, t in templates]
    for _ in range(200):
        words = [["w", "x", "y", "z", "q", "r"][k] for k in rng.integers(0, 6, 30)]
        number = {w: int(np.flatnonzero(scanner.keys == k)[0]) for w, k in zip("qrwxyz", _keys("qrwxyz"))}
        found = list(scanner.automaton.matches([number[w] for w in words], 1))
        longest = [
            max(n for n in range(k + 2) if any(words[k + 1 - n : k + 1] == t[i : i + n] for t in texts for i in range(len(t)))) for k in range(len(words))
        ]
        ends = [k for k in range(len(words)) if k + 1 == len(words) or longest[k + 1] <= longest[k]]
        assert [(at, size) for at, size, _ in found] == [(k, longest[k]) for k in ends if longest[k] >= 1]
        for at, size, held in found:
            for t, end in held.items():
                assert texts[t][end + 1 - size : end + 1] == words[at + 1 - size : at + 1]


def _keys(letters):
    import pyarrow as pa

    from weekloom.llm.words import ALNUM, Words, slices

    return np.concatenate([Words(d, o, ALNUM).hashes() for _, _, d, o in slices(pa.array(list(letters)))])


# ------------------------------------------------------------------ quality


def test_quality_counts_like_brute_force(docs, corpus):
    extra = [(900, "a b c d e f g h " * 9, "en", "a", 1), (901, "same line\nsame line\n\n \nsame line\n#$ x|<>", "en", "a", 1)]
    table = docs.select("doc_id", "text", "lang", "kept").unionByName(
        docs.sparkSession.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("doc_id", "text", "lang", "'x' as kept")
    )
    want = collections.Counter()
    for doc, text, *_ in [*corpus, *extra]:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        gone = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(gone))
        want[(doc, *counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0])] += 1
    got = judge(table).select(
        "document.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("document.kept").alias("own")
    ).collect()
    assert collections.Counter(tuple(r)[:7] for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got) and {r["own"] for r in got} == {"clash", "x"}


# ------------------------------------------------------------------ empty tables


def test_empty_tables(empty):
    assert remove_repeats(empty).count() == 0
    assert near_duplicates(empty).count() == 0
    assert pack(empty, shards=3).count() == 0
    assert mix(empty).count() == 0
    assert scan_licenses(empty).count() == 0
    assert judge(empty).count() == 0
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_files.read_token_files(token_files.write_token_files(empty, path, 2)).count() == 0


def chains_of(spans):
    """All chains, as their covered words."""
    for size in range(1, len(spans) + 1):
        for chain in itertools.combinations(spans, size):
            rooms = [min(y[1] - x[1], y[0] - x[0]) for x, y in zip(chain, chain[1:])]
            if all(room > 0 for room in rooms):
                yield chain[0][2] + sum(min(y[2], room) for y, room in zip(chain[1:], rooms)), chain[-1][0]


def test_best_chain_like_all_chains():
    rng = random.Random(5)
    for _ in range(300):
        spans = sorted((rng.randrange(30), rng.randrange(20), rng.randrange(1, 7)) for _ in range(rng.randrange(1, 8)))
        gain, first, last = chained(spans)
        every = list(chains_of(spans))
        assert gain == max(g for g, _ in every) and (gain, last) in every and any(first == e - n + 1 for e, _, n in spans)


def test_license_labels_need_one_place(spark):
    apart = " ".join("w%d" % (k % 700) for k in range(3_000))
    isc = next(t for label, t in NOTICES if label == "isc").split()
    mit, bsd = (next(t for label, t in WHOLE_TEXTS if label == k) for k in ("mit", "bsd"))
    notice = "licensed under a Creative Commons Attribution%s 4.0 International license"
    texts = {
        f"This is free and easy {apart} unencumbered software {apart} released into the public domain": "",
        f" {apart} ".join(" ".join(isc[k : k + 8]) for k in range(0, len(isc), 8)): "",
        f"{apart} {apart} {' '.join(isc)} {apart}": "isc",
        f"Copyright (c) {mit} {apart}": "mit",
        bsd.replace("the copyright holder", "the regents"): "bsd",
        "SPDX-License-Identifier: MIT": "mit",
        "# SPDX-License-Identifier: Apache-2.0\n": "apache",
        "SPDX-License-Identifier: GPL-3.0-or-later": "gpl",
        "SPDX-License-Identifier: LGPL-2.1-only": "lgpl",
        "SPDX-License-Identifier: Unheard-3.0-or-later": "",
        "SPDX-License-Identifier:": "",
        notice % "-NonCommercial": "cc-by-nc",
        notice % "": "cc-by",
        notice % "" + f" {apart} " + notice % "-NonCommercial": "cc-by,cc-by-nc",
        "of the license " * 20_000: "",
    }
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == dict(enumerate(texts.values()))
    assert all(0 <= r["score"] <= 1 for r in got)
