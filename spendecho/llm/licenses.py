"""License scans with a positional index of rare template words.

Each template is a public notice or licence text with key phrases that must be there in
full. Words are weighted by inverse document frequency over all documents. The index
holds the places of template words. Of a document its rarest licence words are looked
up: for each template so many of the rarest that a match, which has to have half of the
template's weight in place, cannot do without all of them. Every place of such a word
gives an alignment (place in the document minus place in the template). These are
intersected with the alignments of the key phrase's rarest word, and what is left is
verified: the key phrase has to stand there word for word, and the words in place must
have half of the template's weight. Both are conditions of every match, so none is lost
and no number of look-ups is set.

NULL and empty texts have no words and match nothing. Texts are read whole, whatever
their length. Templates that tie, or stand several times in a text, all count; repeated
rows are scanned each; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import mapped
from .decontaminate import normalised

#: Phrases and labels of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label, notice and its key phrases (public wordings, normalised).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
     " general public license as published by the free software foundation", ("gnu general public license",)),
    ("gpl-notice", "this work is licensed under the gnu general public license", ("gnu general public license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
     " associated documentation files", ("permission is hereby granted free of charge",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license v 2 0",)),
]
#: Label, whole licence text (public wordings) and its key phrases.
TEXTS = [
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
     "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
     MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
     DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
     OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
     ("permission to use copy modify and or distribute this software for any purpose",)),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
     to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
     whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
     notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
     WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
     PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
     OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
     SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
     ("to deal in the software without restriction",)),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
     publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
     purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
     authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
     dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
     dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
     copyright law.""",
     ("free and unencumbered software released into the public domain",)),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
     liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
     purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
     restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
     software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
     not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
     original software. 3. This notice may not be removed or altered from any source distribution.""",
     ("the origin of this software must not be misrepresented",)),
]
TEMPLATES += [(label, b" ".join(normalised(text)).decode(), keys) for label, text, keys in TEXTS]
COVERAGE = 0.5


def vocabulary() -> frozenset[bytes]:
    return frozenset(w.encode() for _, text, _ in TEMPLATES for w in text.split())


@dataclass(frozen=True)
class Template:
    label: str
    words: list[bytes]
    total: float
    keys: list[list[bytes]]


class Index:
    """Places of template words: of those that no match can do without all of, and of the
    rarest word of each key phrase."""

    def __init__(self, documents: int, frequency: dict[bytes, int]):
        self.weight = {w: math.log((documents + 1) / (frequency.get(w, 0) + 0.5)) for w in vocabulary()}
        self.rare, self.keyed, self.templates = defaultdict(list), defaultdict(list), []
        for t, (label, text, phrases) in enumerate(TEMPLATES):
            words, keys = text.encode().split(), [phrase.encode().split() for phrase in phrases]
            total, spare = sum(self.weight[w] for w in words), 0.0
            # Without the rarest places, of more than the share a match may lack, too little is left.
            for i in sorted(range(len(words)), key=lambda i: -self.weight[words[i]]):
                self.rare[words[i]].append((t, i))
                spare += self.weight[words[i]]
                if spare > (1 - COVERAGE) * total + 1e-9:
                    break
            for key in keys:
                rarest = max(key, key=lambda w: (self.weight[w], w))
                for i in range(len(words)):
                    if words[i : i + len(key)] == key:
                        self.keyed[rarest].append((t, i + key.index(rarest)))
            self.templates.append(Template(label, words, total, keys))

    def scan(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, words, share of the weight found), verified."""
        if self.keyed.keys().isdisjoint(words):  # every key phrase has one of these words
            return []
        keyed, rare = set(), set()
        for at, w in enumerate(words):
            keyed.update((t, at - i) for t, i in self.keyed.get(w, ()))
        wanted = {t for t, _ in keyed}
        for at, w in enumerate(words):
            rare.update((t, at - i) for t, i in self.rare.get(w, ()) if t in wanted)
        found = []
        for t, start in keyed & rare:
            x = self.templates[t]
            if self._has_key(x, words, start):
                placed = sum(self.weight[w] for j, w in enumerate(x.words) if 0 <= start + j < len(words) and words[start + j] == w)
                if placed >= COVERAGE * x.total:
                    found.append((x.label, max(start, 0), len(x.words), placed / x.total))
        return sorted(found)

    @staticmethod
    def _has_key(x: Template, words: list[bytes], start: int) -> bool:
        """Whether a key phrase stands in full where the alignment puts it."""
        for key in x.keys:
            for i in range(len(x.words) - len(key) + 1):
                if x.words[i : i + len(key)] == key and start + i >= 0 and words[start + i : start + i + len(key)] == key:
                    return True
        return False


def places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    out, there = [], set(words)
    for phrase, label in BASE.items():
        key = phrase.encode().split()
        if there.issuperset(key):
            out += [(i, label) for i, w in enumerate(words) if w == key[0] and words[i : i + len(key)] == key]
    return sorted(out)


def frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Number of documents and, per template word, of documents with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen, n = vocabulary(), Counter(), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                seen.update(wanted.intersection(normalised(text.as_py())))
        seen[b""] = n
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen]), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = mapped(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r.word.encode(): r.n for r in rows}  # at most the template words
    return counts.pop(b"", 0), counts


PLACE = pa.struct([("word", pa.int64()), ("label", pa.string())])
MATCH = pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int64()), ("score", pa.float64())])
ADDED = ("n_words bigint, places array<struct<word:bigint,label:string>>, "
         "matches array<struct<label:string,word:bigint,words:bigint,score:double>>")


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with `n_words`, `places` (of base phrases) and
    `matches` (verified templates) of each whole text. NULL and empty texts have
    none; ties between templates all count; an empty table gives an empty one."""
    index = Index(*frequencies(docs))
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL(ADDED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, matches = [], [], []
            for text in batch.column(len(keep)):
                words = normalised(text.as_py())
                counts.append(len(words))
                base.append([{"word": i, "label": x} for i, x in places(words)])
                matches.append([dict(zip(("label", "word", "words", "score"), m)) for m in index.scan(words)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(base, pa.list_(PLACE)), pa.array(matches, pa.list_(MATCH))],
                [*keep, "n_words", "places", "matches"],
            )

    return mapped(docs.select(*keep, F.col("text").alias("_text")), run, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place, labels and a score (the best match; 1 for a base phrase)."""
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(base, F.transform("matches", lambda m: m["label"])))
    at = F.transform("places", lambda p: p["word"])
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0))
    return scanned.withColumns({
        "n_base": F.size("places").cast("long"), "first_word": F.array_min(at), "last_word": F.array_max(at),
        "base_labels": F.array_join(base, ","), "labels": F.array_join(every, ","),
        "score": F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))),
    }).drop("places", "matches")
