"""License texts in documents, by matching statistics on a generalised suffix automaton.

The automaton holds all word sequences of the templates. A document's words stream through it: at
each word it knows the longest match that ends there and templates that hold it. Maximal matches
of some length, seen as pairs of document and template spans, are chained in order per template,
within overlapping stretches of the document, each four times as long as the template: what is scattered
farther apart is no license, and a chain of up to twice the template's length lies whole in some stretch.
A chain's covered share of the template is its score. A label is given from ``COVERED`` on, or if the whole
template is covered where that has fewer than ``WHOLE`` words; unless a template of another label
covers more words of the same place, as a notice of a variant of a license covers most of the plain one's.

Phrases are counted apart and exactly: each place where a phrase's words follow each other gives
the label of the phrase.

Only stretches of at least ``SHORTEST`` words that all occur in templates are streamed word by word;
finding them is array work over whole batches, so ordinary prose costs little. A document
is handled by itself: no shuffle, and memory grows with the longest text only.

Defined results: a null or empty text has no words and no labels; rows that share an id are rows of
their own; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.storage import small_batches
from weekloom.llm.words import ALNUM, Words, slices

#: Labels by phrase: every place counts.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices and openings of common licenses, by label.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version",
    ),
    (
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version",
    ),
    ("agpl", "licensed under the gnu affero general public license version 3"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
)

_WARRANTY = (
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or "
    "consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits "
    "or business interruption however caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility "
    "of such damage"
)
#: Whole texts of short licenses, by label, without their copyright lines.
WHOLE_TEXTS = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the software the software is "
        "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
        "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
        "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
        "arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
        "provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect "
        "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
        "of contract negligence or other tortious action arising out of or in connection with the use or performance of "
        "this software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
        "distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission this software is provided by "
        "the copyright holders and contributors as is and any express or implied warranties including but not limited to the "
        "implied warranties of merchantability and fitness for a particular purpose are disclaimed " + _WARRANTY,
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
        "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
        "purpose including commercial applications and to alter it and redistribute it freely subject to the following "
        "restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original "
        "software if you use this software in a product an acknowledgment in the product documentation would be appreciated "
        "but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being "
        "the original software 3 this notice may not be removed or altered from any source distribution",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
        "commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain",
    ),
)
#: SPDX identifiers, as words, by label.
SPDX = (
    ("mit", "mit"), ("apache", "apache 2 0"), ("isc", "isc"), ("zlib", "zlib"), ("unlicense", "unlicense"), ("mpl", "mpl 2 0"),
    ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("cc0", "cc0 1 0"),
    ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa 4 0"), ("cc-by-nc", "cc by nc 4 0"),
)
#: The GNU family's identifiers come with versions and endings.
_GNU = {"gpl": ("2 0", "3 0"), "lgpl": ("2 0", "2 1", "3 0"), "agpl": ("3 0",)}


def _spdx_forms() -> tuple[tuple[str, str], ...]:
    gnu = [(k, f"{k} {v}{end}") for k, versions in _GNU.items() for v in versions for end in ("", " only", " or later")]
    return tuple((label, f"spdx license identifier {words}") for label, words in (*SPDX, *gnu))


TEMPLATES = NOTICES + WHOLE_TEXTS + _spdx_forms()
#: Words of the shortest match that is chained, and the share of a template that gives its label.
SHORTEST, COVERED = 3, 0.8
#: A template of fewer words must be covered whole. A chain lies within two stretches of ``REACH`` template lengths.
WHOLE, REACH = 10, 2


class SuffixAutomaton:
    """Generalised suffix automaton: each state knows the templates that hold its sequences, and where
    one of them first ends in each."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                state = last
                while state > 0 and number not in self.ends[state]:
                    self.ends[state][number] = place
                    state = self.link[state]

    def _state(self, like: int | None, length: int) -> int:
        self.next.append({} if like is None else dict(self.next[like]))
        self.ends.append({} if like is None else dict(self.ends[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, parent: int, child: int, word: int) -> int:
        clone = self._state(child, self.length[parent] + 1)
        self.link[child] = clone
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            child = self.next[last][word]
            return child if self.length[child] == self.length[last] + 1 else self._split(last, child, word)
        new = self._state(None, self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state < 0:
            self.link[new] = 0
        else:
            child = self.next[state][word]
            fits = self.length[child] == self.length[state] + 1
            self.link[new] = child if fits else self._split(state, child, word)
        return new

    def matches(self, words: list[int], shortest: int):
        """Maximal matches: (last word, length, ends by template)."""
        state, size = 0, 0
        for at, word in enumerate(words):
            before = state, size
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            if size <= before[1] and before[1] >= shortest:
                yield at - 1, before[1], self.ends[before[0]]
        if size >= shortest:
            yield len(words) - 1, size, self.ends[state]


def chained(spans: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The chain of matches (document end, template end, length), sorted by document end, that covers most template
    words in order: their number, and the chain's first and last word in the document."""
    if len(spans) == 1:
        ((at, _, size),) = spans
        return size, at - size + 1, at
    ends_in_doc, ends, sizes = np.array(spans, np.int64).T
    gains, begins = sizes.copy(), ends_in_doc - sizes + 1
    for k in range(1, len(spans)):
        # Words that both cover, in the document or in the template, count once.
        room = np.minimum(ends[k] - ends[:k], ends_in_doc[k] - ends_in_doc[:k])
        gain = np.where(room > 0, gains[:k] + np.minimum(room, sizes[k]), 0)
        best = int(gain.argmax())
        if gain[best] > gains[k]:
            gains[k], begins[k] = gain[best], begins[best]
    best = int(gains.argmax())
    return int(gains[best]), int(begins[best]), int(ends_in_doc[best])


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES) -> None:
        self.templates = [(label, text.split()) for label, text in templates]
        vocabulary = sorted({w for _, words in self.templates for w in words} | {w for p in phrases for w in p.split()})
        texts = pa.array(vocabulary, pa.string())
        hashes = np.concatenate([Words(d, o, ALNUM).hashes() for _, _, d, o in slices(texts)])
        order = np.argsort(hashes)
        self.keys, number = hashes[order], {vocabulary[k]: i for i, k in enumerate(order)}
        self.automaton = SuffixAutomaton([[number[w] for w in words] for _, words in self.templates])
        self.phrases = [([number[w] for w in p.split()], label) for p, label in phrases.items()]
        # Words of templates; those of phrases alone would only lengthen stretches.
        self.known = np.isin(np.arange(len(vocabulary)), [number[w] for _, words in self.templates for w in words])

    def numbers(self, words: Words) -> np.ndarray:
        """Each word's place in the vocabulary, or -1."""
        hashes = words.hashes()
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[place] == hashes, place, -1)

    def covered(self, stretches: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int]]:
        """Best chains (template, covered words, first word, last word) of a document's stretches (first word, words)."""
        spans: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for first, words in stretches:
            for at, size, ends in self.automaton.matches(words, SHORTEST):
                for template, end in ends.items():
                    # Stretch k begins at k lengths and is two lengths long. A match is in one or two of them.
                    length = REACH * len(self.templates[template][1])
                    begun, ended = ((first + x) // length for x in (at - size + 1, at))
                    for k in range(max(0, ended - 1), begun + 1):
                        spans.setdefault((template, k), []).append((first + at, end, size))
        return [(template, *chained(found)) for (template, _), found in spans.items()]

    def labels(self, chains: list[tuple[int, int, int, int]]) -> set[str]:
        """Labels of the chains that cover enough, and at least as much as any of another label at their place."""
        enough = []
        for template, gain, first, last in chains:
            label, words = self.templates[template]
            if gain >= (COVERED * len(words) if len(words) >= WHOLE else len(words)):
                enough.append((first, last, gain, label))
        enough = sorted(set(enough))
        longest = max((last - first for first, last, _, _ in enough), default=0)
        out = set()
        for first, last, gain, label in enough:
            if label in out:
                continue
            near = enough[bisect_left(enough, (first - longest,)) : bisect_left(enough, (last + 1,))]
            if not any(
                more > gain and other != label and 2 * (min(last, b) - max(first, a) + 1) >= last - first + 1 for a, b, more, other in near
            ):
                out.add(label)
        return out


def _scan(templates, phrases):
    scanner: list[Scanner] = []

    def run(batches):
        if not scanner:
            scanner.append(Scanner(templates, phrases))
        it = scanner[0]
        for batch in batches:
            columns = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for _, _, data, offsets in slices(batch.column("text")):
                words = Words(data, offsets, ALNUM, lower=True)
                numbers, n = it.numbers(words), len(offsets) - 1
                owners = words.owners
                count = np.zeros(n, np.int64)
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                base = [set() for _ in range(n)]
                for sequence, label in it.phrases:
                    at = words.places(len(sequence))
                    for k, word in enumerate(sequence):
                        at = at[numbers[at + k] == word]
                    owner = owners[at]
                    place = at - words.bounds[owner]
                    count += np.bincount(owner, minlength=n)
                    np.minimum.at(first, owner, place)
                    np.maximum.at(last, owner, place)
                    for t in np.unique(owner):
                        base[t].add(label)
                labels, score = [set(b) for b in base], [0.0] * n
                # Stretches of known words, cut at the ends of texts.
                known = (numbers >= 0) & it.known[numbers]
                cut = np.ones(len(known) + 1, bool)
                cut[1:-1] = (known[1:] != known[:-1]) | (owners[1:] != owners[:-1])
                edges = np.flatnonzero(cut)
                low, high = edges[:-1], edges[1:]
                long = known[low] & (high - low >= SHORTEST) if len(known) else np.zeros(0, bool)
                stretches: dict[int, list[tuple[int, list[int]]]] = {}
                for a, b in zip(low[long], high[long]):
                    t = int(owners[a])
                    stretches.setdefault(t, []).append((int(a - words.bounds[t]), numbers[a:b].tolist()))
                for t, found in stretches.items():
                    chains = it.covered(found)
                    labels[t] |= it.labels(chains)
                    score[t] = max((gain / len(it.templates[template][1]) for template, gain, _, _ in chains), default=0.0)
                columns["n_words"].append(words.counts)
                columns["n_base"].append(count)
                columns["first_word"].append(np.where(count > 0, first, -1))
                columns["last_word"].append(last)
                columns["base_labels"] += [",".join(sorted(b)) for b in base]
                columns["labels"] += [",".join(sorted(x)) for x in labels]
                columns["score"] += [1.0 if b else s for b, s in zip(base, score)]
            if not columns["n_words"]:
                continue
            whole = {k: np.concatenate(columns[k]) for k in ("n_words", "n_base", "first_word", "last_word")}
            none = whole["n_base"] == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(whole["n_words"], pa.int64()),
                    pa.array(whole["n_base"], pa.int64()),
                    pa.array(whole["first_word"], pa.int64(), mask=none),
                    pa.array(whole["last_word"], pa.int64(), mask=none),
                    pa.array(columns["base_labels"], pa.string()),
                    pa.array(columns["labels"], pa.string()),
                    pa.array(columns["score"], pa.float64()),
                ],
                ["doc_id", *columns],
            )

    return run


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base`` (places of phrases), ``first_word`` and ``last_word`` (their smallest and
    largest start), ``base_labels``, ``labels`` and ``score`` (1 with a phrase, else the best covered share)."""
    small_batches(docs)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _scan(templates, phrases),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
