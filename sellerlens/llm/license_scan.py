"""Licence scan with a positional rare-token index.

Templates are licence texts and notices with one mandatory key phrase each.
Document frequencies over all documents give each licence word its IDF. A
template posts its rarest words with their positions, and the two rarest
places of its key phrase always. A file's licence words are looked up, rarest
first: where the two posted key words stand at their relative position, the
template is proposed, and its key phrase is verified there word by word. No
occurrence of the phrase can escape, as each holds both words. The template's
other posted words vote by relative position: the IDF share of those that stand
within ``SLACK`` words of their place is the score, so names and years that a
notice has gained, or a line that it lost, cost only the words concerned.

The frequency table has one row per template word at most, whatever the corpus.

Cases: null or empty text has no words, labels or places and score 0; a text
altered inside its key phrase has no place of that template, however much of the
rest stands there; overlapping places all count; words of equal frequency rank
by their position in the template; repeated rows are judged alike; an empty
table gives an empty result; columns besides (doc_id, text) are ignored; a
template without its key phrase is an error.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.llm.common import alnum_words, map_arrow


class Template(NamedTuple):
    label: str
    notice: str
    key: str
    base: bool = False


# Labels, the wording of common licence notices, and their mandatory phrases.
TEMPLATES = [
    Template("mit", "released under the mit license", "mit license", True),
    Template("apache", "licensed under the apache license version 2 0", "apache license", True),
    Template("gpl", "licensed under the gnu general public license version 3", "general public license", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    Template("apache", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it", "free software you can redistribute it"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("bsd", "licensed under the bsd license", "bsd license"),
    Template("mpl", "licensed under the mozilla public license version 2 0", "mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc0", "dedicated to the public domain under cc0 1 0", "public domain under cc0"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction including without limitation the rights to "
             "use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
             "software is furnished to do so", "use copy modify merge publish distribute sublicense and or sell copies"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
             "provided that the above copyright notice and this permission notice appear in all copies",
             "permission to use copy modify and or distribute this software"),
    Template("bsd-3-clause", "redistributions of source code must retain the above copyright notice this list of conditions and the "
             "following disclaimer neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission",
             "may be used to endorse or promote products derived from this software"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
             "liable for any damages arising from the use of this software permission is granted to anyone to use this software for any "
             "purpose including commercial applications and to alter it and redistribute it freely",
             "and to alter it and redistribute it freely"),
    Template("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
             "accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit "
             "the software", "use reproduce display distribute execute and transmit the software"),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
             "use compile sell or distribute this software either in source code form or as a compiled binary",
             "free and unencumbered software"),
    Template("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
             "on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
             "language governing permissions and limitations under the license", "language governing permissions and limitations"),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
             "eclipse public license"),
    Template("reserved", "all rights reserved", "all rights reserved"),
]

RARE = 12  # words that a template posts
SLACK = 8  # words by which a posted word may be out of its place

SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double, places array<struct<template:int,word:int,score:double>>")


def vocabulary(templates: list[Template]) -> list[bytes]:
    return list(dict.fromkeys(w for t in templates for w in f"{t.notice} {t.key}".encode().split()))


def document_frequency(docs: DataFrame, templates: list[Template]) -> dict[bytes, int]:
    """Documents that hold each template word; one row per word reaches the driver."""
    wanted = frozenset(vocabulary(templates))

    def run(batches):
        seen = Counter()
        for b in batches:
            for text in b.column(0).cast(pa.binary()).to_pylist():
                seen.update(wanted.intersection(alnum_words(text or b"")))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "df"])

    rows = map_arrow(docs.select("text"), run, "word binary, df long").groupBy("word").agg(F.sum("df").alias("df"))
    return {bytes(r.word): r.df for r in rows.collect()}


class Index:
    """Postings of rare words by position.

    ``anchors``: word -> [(template, key phrase, the word's place in it, other word, its distance)],
    rarest words first; ``posted``: per template (position seen from the key phrase, word, IDF)."""

    def __init__(self, templates: list[Template], df: dict[bytes, int], n_docs: int, rare: int = RARE, slack: int = SLACK):
        self.templates, self.slack = templates, slack
        words = vocabulary(templates)
        idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-9 for w in words}
        rank = {w: (df.get(w, 0), i) for i, w in enumerate(words)}
        anchors: dict[bytes, list] = {}
        self.posted = []
        for t, template in enumerate(templates):
            key, notice = template.key.encode().split(), template.notice.encode().split()
            at = next((i for i in range(len(notice)) if key and notice[i:i + len(key)] == key), None)
            if at is None:
                raise ValueError(f"the notice of {template.label} lacks its key phrase: {template.key}")

            def rarest(places, n):
                return sorted(places, key=lambda i: (df.get(notice[i], 0), i))[:n]

            in_key = rarest(range(at, at + len(key)), 2)
            first, other = in_key[0], in_key[-1]
            anchors.setdefault(notice[first], []).append((t, key, first - at, notice[other], other - first))
            self.posted.append([(i - at, notice[i], idf[notice[i]]) for i in sorted({*rarest(range(len(notice)), rare), *in_key})])
        self.anchors = dict(sorted(anchors.items(), key=lambda x: rank[x[0]]))
        self.words = frozenset(anchors)

    def places(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, first word of the key phrase, score) of every verified place."""
        present = self.words.intersection(words)
        if not present:
            return []
        found, n = [], len(words)
        for anchor in self.anchors:
            if anchor not in present:
                continue
            at = -1
            while True:
                try:
                    at = words.index(anchor, at + 1)
                except ValueError:
                    break
                for t, key, k, other, distance in self.anchors[anchor]:
                    start, beside = at - k, at + distance
                    if start >= 0 and 0 <= beside < n and words[beside] == other and words[start:start + len(key)] == key:
                        found.append((t, start, self.score(t, start, words)))
        return sorted(found, key=lambda x: (x[1], x[0]))

    def score(self, t: int, start: int, words: list[bytes]) -> float:
        total = hit = 0.0
        for i, w, idf in self.posted[t]:
            total += idf
            at = start + i
            if w in words[max(0, at - self.slack):max(0, at + self.slack + 1)]:
                hit += idf
        return min(1.0, hit / total)


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Per document: words, places of base phrases, labels, best score and all verified places."""
    d = docs.select("doc_id", "text")
    n_docs = d.count()
    index = Index(templates, document_frequency(d, templates), n_docs)

    def one(doc, text):
        words = alnum_words(text or b"")
        places = index.places(words)
        base = [p for p in places if templates[p[0]].base]
        label = lambda ps: sorted({templates[p[0]].label for p in ps})
        return (doc, len(words), len(base), min((p[1] for p in base), default=None), max((p[1] for p in base), default=None),
                label(base), label(places), max((p[2] for p in places), default=0.0),
                [{"template": t, "word": w, "score": s} for t, w, s in places])

    place = pa.list_(pa.struct([("template", pa.int32()), ("word", pa.int32()), ("score", pa.float64())]))
    types = [*[pa.int64()] * 5, pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), place]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]

    def run(batches):
        for b in batches:
            rows = [one(d, t) for d, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 9, types)], names=names)

    return map_arrow(d, run, SCAN)
