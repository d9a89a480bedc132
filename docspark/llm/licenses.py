"""License scans: an exact set-similarity join of text blocks with license templates.

A template is the set of words of a license text of any length. A block is any run
of as many words of a text as the template has, and as many more as it may miss;
every word of every text starts one, across line ends. A block belongs to a
template when it holds at least ``threshold`` of its words, and of its pairs of
neighbouring words all but two for every word that may be missing: words of a
license in another order are no license.

The words of all templates are ordered by how often they stand in all documents,
rare ones first. A block with too few template words, repeats counted, is left out
by its length. The others are counted word by word in the global order: a block
is left out as soon as the words still to come cannot bring it to the threshold,
so none outlives the template's prefix, its words up to the number that may be
missing and one more, without a match (prefix filter), or a first match that comes
too late in the order (position filter). What is left is counted exactly.

Of overlapping blocks of one template the one with the highest containment is
reported, at ties the first; it ends with its last template word.

Phrases are sequences of words that stand consecutively; all places are found.

A null text is empty and has no words. Repeated rows give repeated results; ties
cannot change a result; null ids pass through; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm import bytewords

#: Words are runs of ASCII letters and digits, and of bytes beyond ASCII.
WORDS = bytewords.byte_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# fixed values: statements and texts of public licenses
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    (
        "bsd-disclaimer",
        """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
        THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ),
)

SCHEMA = (
    "doc_id bigint, n_words bigint, places array<struct<label:string,start:bigint>>,"
    " matches array<struct<label:string,first:bigint,last:bigint,containment:double>>"
)


def words_of(text: str) -> list[str]:
    """The words of a template or phrase, as those of a text are found."""
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _hash(word: str) -> np.uint64:
    raw = np.frombuffer(word.encode(), np.uint8)
    return bytewords.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


@dataclass(frozen=True)
class Template:
    """Distinct words and pairs of neighbouring words, how many of each a block needs, and the words of a block."""

    label: str
    words: tuple
    pairs: tuple
    need: int
    need_pairs: int
    window: int

    @classmethod
    def build(cls, label: str, sequence: Sequence, threshold: float) -> Template:
        words, pairs = set(sequence), set(zip(sequence, sequence[1:]))
        need = int(np.ceil(len(words) * threshold - 1e-9))
        spare = len(words) - need
        return cls(label, tuple(sorted(words)), tuple(sorted(pairs)), need, max(0, len(pairs) - 2 * spare), len(sequence) + spare)


@dataclass
class Index:
    """Templates and phrases as numbers of their words; ``keys`` are the words' hashes in order."""

    keys: np.ndarray
    phrases: list[tuple[str, list[int]]]
    templates: list[Template]

    @classmethod
    def build(cls, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], threshold: float) -> Index:
        words = sorted({w for _, text in [*templates, *phrases] for w in words_of(text)}, key=_hash)
        number = {w: i for i, w in enumerate(words)}
        numbered = lambda text: [number[w] for w in words_of(text)]
        return cls(
            np.array([_hash(w) for w in words], np.uint64),
            [(label, numbered(text)) for label, text in phrases],
            [Template.build(label, numbered(text), threshold) for label, text in templates if words_of(text)],
        )

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def word_counts(docs: DataFrame, index: Index) -> np.ndarray:
    """How often each word of the index stands in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.keys), np.int64)
        for batch in batches:
            for block in bytewords.blocks(batch["text"]):
                _, s, e = bytewords.word_spans(block, WORDS)
                found = index.numbers(bytewords.span_hashes(block.data, s, e))
                total += np.bincount(found[found >= 0], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["word", "n"])

    counts = np.zeros(len(index.keys), np.int64)
    for row in docs.select("text").mapInArrow(run, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[row["word"]] = row["n"]
    return counts


def _phrase_places(index: Index, numbers: np.ndarray, rows: np.ndarray) -> list[tuple[np.ndarray, str]]:
    found = []
    for label, words in index.phrases:
        n = len(numbers) - len(words) + 1
        if n > 0:
            here = rows[:n] == rows[len(words) - 1 :]
            for j, w in enumerate(words):
                here = here & (numbers[j : j + n] == w)
            found.append((np.flatnonzero(here), label))
    return found


def _count(places: Sequence[np.ndarray], starts: np.ndarray, ends: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Which spans hold at least ``need`` of some items, and how many; ``places`` are the items' places, in global order.

    A span is given up as soon as the items to come are too few.
    """
    alive, held = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for n, at in enumerate(places, 1):
        if not len(alive):
            break
        if len(at):
            held += np.searchsorted(at, starts[alive]) < np.searchsorted(at, ends[alive])
        keep = held + (len(places) - n) >= need
        alive, held = alive[keep], held[keep]
    return alive, held


def _places(codes: np.ndarray, at: np.ndarray, wanted: Sequence[int]) -> list[np.ndarray]:
    """The places of each wanted code, ascending; ``codes`` are those of the places ``at``."""
    by = np.argsort(codes, kind="stable")
    ordered = codes[by]
    lo, hi = np.searchsorted(ordered, wanted, "left"), np.searchsorted(ordered, wanted, "right")
    return [at[by[a:b]] for a, b in zip(lo, hi)]


def _template_blocks(index: Index, order: np.ndarray, numbers: np.ndarray, rows: np.ndarray, bounds: np.ndarray):
    """Blocks that belong to a template: row, first word, last word, template, containment."""
    known = np.flatnonzero(numbers >= 0)
    of_known = numbers[known]
    n_words = len(index.keys)
    for t in index.templates:
        member = np.zeros(n_words, bool)
        member[list(t.words)] = True
        hits = known[member[of_known]]
        if len(hits) < t.need:
            continue
        stops = np.minimum(hits + t.window, bounds[rows[hits] + 1])
        after = np.searchsorted(hits, stops)
        some = np.flatnonzero(after - np.arange(len(hits)) >= t.need)
        if not len(some):
            continue
        starts, ends, lasts = hits[some], stops[some], hits[after[some] - 1]
        ordered = sorted(t.words, key=lambda w: (order[w], w))
        alive, held = _count(_places(numbers[hits], hits, ordered), starts, ends, t.need)
        starts, ends, lasts = starts[alive], ends[alive], lasts[alive]
        nearby = hits[:-1][np.diff(hits) == 1]
        pairs = sorted(t.pairs, key=lambda p: (min(order[p[0]], order[p[1]]), p))
        places = _places(numbers[nearby] * n_words + numbers[nearby + 1] if len(nearby) else nearby, nearby, [a * n_words + b for a, b in pairs])
        alive, _ = _count(places, starts, ends - 1, t.need_pairs)
        taken = np.zeros(len(numbers), bool)
        for i in alive[np.lexsort((starts[alive], -held[alive]))]:
            if not (taken[starts[i]] or taken[ends[i] - 1]):
                taken[starts[i] : ends[i]] = True
                yield rows[starts[i]], starts[i], lasts[i], t, held[i] / len(t.words)


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    threshold: float = 0.9,
) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: number of words, phrase places, and blocks that meet a template.

    ``first`` and ``last`` are the words of the block, counted from 0. The
    templates go to every task; they are an argument of the call, not a table.
    """
    index = Index.build(templates, phrases, threshold)
    order = word_counts(docs, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in bytewords.blocks(batch["text"]):
                rows, s, e = bytewords.word_spans(block, WORDS)
                numbers = index.numbers(bytewords.span_hashes(block.data, s, e))
                bounds = np.searchsorted(rows, np.arange(len(block) + 1))
                places: list[list] = [[] for _ in range(len(block))]
                for at, label in _phrase_places(index, numbers, rows):
                    for i in at:
                        places[rows[i]].append({"label": label, "start": int(i - bounds[rows[i]])})
                matches: list[list] = [[] for _ in range(len(block))]
                for row, first, last, t, share in _template_blocks(index, order, numbers, rows, bounds):
                    start = int(bounds[row])
                    matches[row].append({"label": t.label, "first": int(first) - start, "last": int(last) - start, "containment": float(share)})
                where = pa.struct([("label", pa.string()), ("start", pa.int64())])
                what = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("containment", pa.float64())])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(block.first, len(block)).cast(pa.int64()),
                        pa.array(np.diff(bounds)),
                        pa.array(places, pa.list_(where)),
                        pa.array(matches, pa.list_(what)),
                    ],
                    names=["doc_id", "n_words", "places", "matches"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place, and labels of each document."""
    starts, names = F.col("places.start"), F.col("places.label")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    found = F.coalesce(F.array_max("matches.containment"), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(names).alias("base_labels"),
        joined(F.concat(names, F.col("matches.label"))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(found).alias("score"),
    )
