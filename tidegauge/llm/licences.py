"""License scans by a positional rare-token index.

The templates (short phrases, notices and whole licence texts) are indexed by word. One pass over the corpus counts in how
many documents each template word occurs (a table bounded by the templates' vocabulary). A phrase, and each mandatory key
phrase of a notice or text, is indexed by its two words of highest idf and their positions. A second pass takes each file's
licence words, looks them up from the highest idf down, intersects the postings of the two words of a pair by relative
position (file position - template position), and verifies each alignment that both agree on: phrases must stand word for
word, notices and texts need all their key phrases near by and enough of their idf mass. Since a key phrase has to stand
as it is, the two words of its pair always agree where it does, so the intersection loses nothing.

Cases: null or empty text has no words, no label and score 0; repeated rows and ties give equal rows; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import alnum_words, batches, rows_of

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Licence notices (label, text, phrases that must be there).
NOTICES = [
    ("gpl-notice", "this work is licensed under the gnu general public license version", ["gnu general public license"]),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["free software", "general public license"]),
    ("lgpl-notice", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ["lesser general public license"]),
    ("apache-notice", "licensed under the apache license version", ["apache license"]),
    ("apache-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ["apache license", "except in compliance"]),
    ("mit-notice", "released under the mit license", ["mit license"]),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted", "without restriction"]),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ["with or without fee", "hereby granted"]),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms", "conditions are met"]),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-notice", "licensed under cc by", ["cc by"]),
    ("cc-by-nc-notice", "licensed under cc by nc", ["cc by nc"]),
    ("cc-by-notice", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("unlicense-notice", "this is free and unencumbered software released into the public domain", ["public domain"]),
]

#: Whole licence texts (label, text, phrases that must be there).
TEXTS = [
    (
        "mit-text",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        ["permission is hereby granted free of charge", "substantial portions of the software"],
    ),
    (
        "isc-text",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
        THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        ["with or without fee is hereby granted", "disclaims all warranties"],
    ),
    (
        "bsd-2-clause-text",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
        TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
        USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
        ["redistributions of source code must retain", "redistributions in binary form must reproduce"],
    ),
    (
        "zlib-text",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
        software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,
        an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
        marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any
        source distribution.""",
        ["altered source versions must be plainly marked", "this notice may not be removed or altered"],
    ),
    (
        "boost-text",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software,
        and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject
        to the following: The copyright notices in the Software and this entire statement, including the above license grant, this
        restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative
        works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a
        source language processor.""",
        ["prepare derivative works of the software", "machine executable object code"],
    ),
    (
        "unlicense-text",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial,
        and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
        copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
        detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
        future rights to this software under copyright law.""",
        ["unencumbered software released into the public domain", "detriment of our heirs and successors"],
    ),
]

#: Templates of at least so many words are matched with room for words put in or left out.
LONG = 60

RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
    ]
)
DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:long,end:long,score:double>>"
)


@dataclass
class Template:
    label: str
    words: list[bytes]
    keys: list[list[bytes]]
    base: bool


@dataclass
class Index:
    """Templates with their idf mass. A posting stands under the rarer word of a pair: (template, position, the other
    word, its position); words alone have no other."""

    templates: list[Template]
    idf: dict[bytes, float]
    postings: dict[bytes, list[tuple]] = field(default_factory=dict)
    looked_up: frozenset = frozenset()
    mass: list[float] = field(default_factory=list)


def templates(phrases: dict[str, str] = PHRASES, notices=(*NOTICES, *TEXTS)) -> list[Template]:
    base = [Template(label, alnum_words(p), [], True) for p, label in phrases.items()]
    return base + [Template(n, alnum_words(t), [alnum_words(k) for k in keys], False) for n, t, keys in notices]


def notices_from(table: DataFrame, most: int = 10_000) -> list[tuple[str, str, list[str]]]:
    """Notices of one's own from a table (label, text, keys array<string>) of at most `most` rows, which is checked."""
    rows = table.select("label", "text", "keys").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} licence texts")
    return [(r.label, r.text, r["keys"]) for r in rows]


def build_index(known: list[Template], n_docs: int, df: dict[bytes, int]) -> Index:
    """What needs a word that is nowhere in the corpus has no postings: it cannot stand in any file."""
    vocabulary = {w for t in known for w in t.words}
    idf = {w: math.log1p((n_docs - df.get(w, 0) + 0.5) / (df.get(w, 0) + 0.5)) for w in vocabulary}
    index, postings = Index(known, idf), defaultdict(set)
    for k, t in enumerate(known):
        index.mass.append(sum(idf[w] for w in t.words))
        musts = [t.words] if t.base else t.keys
        if any(not df.get(w, 0) for m in musts for w in m):
            continue
        for m in musts:
            # The first place of each word, the two rarest words of the phrase.
            first = sorted({w: i for i, w in reversed(list(enumerate(m)))}.items(), key=lambda x: (-idf[x[0]], x[0]))[:2]
            for at in range(len(t.words) - len(m) + 1):
                if t.words[at : at + len(m)] == m:
                    (w, i), *other = first
                    postings[w].add((k, at + i, *((other[0][0], at + other[0][1]) if other else (None, 0))))
    index.postings = {w: sorted(found, key=repr) for w, found in postings.items()}
    index.looked_up = frozenset(postings) | {p[2] for found in postings.values() for p in found if p[2] is not None}
    return index


def _stands(words: list[bytes], at: int, phrase: list[bytes]) -> bool:
    return at >= 0 and words[at : at + len(phrase)] == phrase


def _coverage(index: Index, words: list[bytes], t: Template, start: int, room: int, drift: int = 2) -> float:
    """idf mass of the template's words that stand about where they should; anywhere in the stretch for long ones."""
    if len(t.words) >= LONG:
        there = Counter(words[max(0, start - room) : start + len(t.words) + room])
        return sum(index.idf[w] * min(n, there[w]) for w, n in Counter(t.words).items())
    got = 0.0
    for i, w in enumerate(t.words):
        at = start + i
        if any(0 <= at + d < len(words) and words[at + d] == w for d in range(-drift, drift + 1)):
            got += index.idf[w]
    return got


def aligned(index: Index, words: list[bytes]) -> set[tuple[int, int]]:
    """(template, start in the file) on which the words of a pair agree; the file's licence words go from high idf to low."""
    where: dict[bytes, list[int]] = defaultdict(list)
    for at, w in enumerate(words):
        if w in index.looked_up:
            where[w].append(at)
    found = set()
    for w in sorted(where, key=lambda w: (-index.idf[w], w)):
        for k, i, other, j in index.postings.get(w, ()):
            if other is None:
                found.update((k, at - i) for at in where[w])
            elif other in where:
                found.update((k, start) for start in {at - i for at in where[w]}.intersection(at - j for at in where[other]))
    return found


def scan_words(index: Index, words: list[bytes], enough: float = 0.7) -> tuple[list[int], list[tuple[str, int, int, float]]]:
    """Starts of the phrases, and (label, start, end, score) of all that was verified."""
    starts, spans = [], {}
    for k, start in sorted(aligned(index, words)):
        t = index.templates[k]
        if t.base:
            if _stands(words, start, t.words):
                starts.append(start)
                spans[t.label, start] = (start + len(t.words), 1.0)
            continue
        room = len(t.words) // 8 if len(t.words) >= LONG else 3
        low, high = max(0, start - room), start + len(t.words) + room
        window = words[low : max(low, high)]
        if not all(any(_stands(window, i, key) for i in range(len(window))) for key in t.keys):
            continue
        share = _coverage(index, words, t, start, room) / index.mass[k] if index.mass[k] else 0.0
        at = max(0, start)
        if share >= enough and share > spans.get((t.label, at), (0, 0.0))[1]:
            spans[t.label, at] = (min(len(words), start + len(t.words)), min(1.0, share))
    return starts, [(label, s, e, v) for (label, s), (e, v) in sorted(spans.items())]


def corpus_counts(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """In how many documents each word of the vocabulary occurs; at most one row for each word and task."""
    wanted = frozenset(vocabulary)

    def count(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, dict.fromkeys(wanted, 0)
        for (text,) in rows_of(batches_in):
            n += 1
            for w in wanted.intersection(alnum_words(text)):
                seen[w] += 1
        rows = [(w, c) for w, c in seen.items() if c] + [(b"", n)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.int64())], ["word", "n"])

    found = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    got = {bytes(r.word): r.n for r in found}
    return got.pop(b"", 0), got


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices=(*NOTICES, *TEXTS), enough: float = 0.7) -> DataFrame:
    """One row for each row of docs (doc_id, text): counts, labels, score and the verified spans."""
    known = templates(phrases, notices)
    n_docs, df = corpus_counts(docs, {w for t in known for w in t.words})
    index = build_index(known, n_docs, df)
    of_base = set(phrases.values())

    def rows(batches_in):
        for doc_id, text in rows_of(batches_in):
            words = alnum_words(text)
            starts, spans = scan_words(index, words, enough)
            labels = {s[0] for s in spans}
            yield (
                doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(labels & of_base)), ",".join(sorted(labels)), max((s[3] for s in spans), default=0.0),
                [{"label": a, "start": s, "end": e, "score": v} for a, s, e, v in spans],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda it: batches(rows(it), RESULT), DDL)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    from tidegauge.llm.common import documents

    return scan(documents(spark, sf_dir)).drop("spans")
