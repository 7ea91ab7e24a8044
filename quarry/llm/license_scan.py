"""Licence scan with a positional index of rare template words.

Every template (a base phrase or a notice) is indexed by its rarest words:
word to (template, position).  A file's words are looked up; each hit votes for
the place where its template would begin, and hits of one template that agree
on that place (a few words' drift allowed) are intersected to a candidate.  A
candidate counts once its template's mandatory key phrase stands in the text
near the place the vote expects.  The score is the share of the template's
indexed words that were found in place.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.text import pieces, plain_lower, texts


@dataclass(frozen=True)
class Template:
    """``key``: the phrase without which the template doesn't count (None: the whole text)."""

    label: str
    text: str
    key: str | None = None


# Base phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)
# Public licence notices, each with its key phrase.
NOTICES = (
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "under the terms of the gnu general public license"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    Template("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license version 2 0"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("mit-notice", "released under the mit license", "released under the mit license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "for any purpose with or without fee is hereby granted"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
)
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label: string, start: int, score: double>>"


@dataclass
class Index:
    """Postings of the templates' rarest words, with their phrases."""

    templates: tuple[Template, ...]
    n_base: int
    rare: int
    words: dict[bytes, int] = field(default_factory=dict)
    #: by word: (template, position)
    postings: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)
    keys: list[tuple[int, list[int]]] = field(default_factory=list)
    #: by template: the key phrase's rarest word, without which there is no match
    anchors: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        cut = [plain_lower(t.text.encode()) for t in self.templates]
        ids = [[self.words.setdefault(w, len(self.words)) for w in c] for c in cut]
        df = Counter(chain.from_iterable(set(x) for x in ids))
        idf = {w: math.log((1 + len(ids)) / n) for w, n in df.items()}
        for t, own in enumerate(ids):
            places = sorted(range(len(own)), key=lambda i, own=own: (-idf[own[i]], i))[: self.rare]
            self.sizes.append(len(places))
            for i in places:
                self.postings.setdefault(own[i], []).append((t, i))
            key = [self.words.get(w, -1) for w in plain_lower((self.templates[t].key or self.templates[t].text).encode())]
            at = next((i for i in range(len(own) - len(key) + 1) if own[i : i + len(key)] == key), None)
            if at is None:
                raise ValueError(f"the key phrase isn't part of the template: {self.templates[t]}")
            self.keys.append((at, key))
            self.anchors.append(max(key, key=lambda w: (idf[w], -w)))


def find(index: Index, at: np.ndarray, words: np.ndarray, drift: int, share: float) -> list[tuple[int, int, float]]:
    """(template, start, score) in one document; ``at``: places of the known
    words in it, ``words``: which they are.

    Every place of a template's key phrase gives a start; around it, within
    ``drift`` words, enough of the template's indexed words must vote for a
    start there (sorted votes, so a start looks at its neighbours only)."""
    votes: dict[int, list[tuple[int, int]]] = {}
    where: dict[int, list[int]] = {w: [] for w in set(index.anchors)}
    for place, word in zip(at.tolist(), words.tolist(), strict=True):
        if word in where:
            where[word].append(place)
    live = {t for t, w in enumerate(index.anchors) if where[w]}
    for place, word in zip(at.tolist(), words.tolist(), strict=True):
        for t, i in index.postings.get(word, ()):
            if t in live:
                votes.setdefault(t, []).append((place - i, i))
    known = dict(zip(at.tolist(), words.tolist(), strict=True))
    out = []
    for t, offsets in votes.items():
        key_at, key = index.keys[t]
        exact = t < index.n_base
        slack = 0 if exact else drift
        need = index.sizes[t] if exact else max(2, math.ceil(share * index.sizes[t]))
        if len(offsets) < need:
            continue
        offsets.sort()
        inside = [j for j, w in enumerate(key) if w == index.anchors[t]]
        for begin in sorted({place - j for place in where[index.anchors[t]] for j in inside}):
            start = begin - key_at
            near = offsets[bisect_left(offsets, (start - slack, -1)) : bisect_left(offsets, (start + slack + 1, -1))]
            found = len({i for _, i in near})
            if found >= need and all(known.get(begin + j) == w for j, w in enumerate(key)):
                out.append((t, start, found / index.sizes[t]))
    return out


def scan(documents: DataFrame, base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES, rare: int = 8, drift: int = 6, share: float = 0.6) -> DataFrame:
    """Licences of every whole text: doc_id, n_words, n_base (places of base
    phrases), first_word, last_word (smallest and largest of those places,
    else null), base_labels, labels (distinct, sorted, comma-joined; empty
    string for none), score (best match, 0 to 1) and matches (label, start,
    score; a start may lie before the text where a notice's beginning is cut).

    Null and empty texts have no words and score 0; repeated rows are scanned
    each; other columns play no part.  ``rare``: indexed words of a notice
    (base phrases are indexed whole); ``share``: of these, as many must agree
    on the place within ``drift`` words.  Notices may overlap or follow each
    other at any distance: every place of a key phrase is judged by itself, and
    ties in score are all kept.  An empty table has no rows."""
    index = Index((*base, *notices), len(base), max(rare, *(len(plain_lower(t.text.encode())) for t in base)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = index.words.get
        anchors = np.unique(index.anchors)
        for batch in pieces(batches):
            docs = [plain_lower(x) for x in texts(batch["text"])]
            lens = np.fromiter(map(len, docs), np.int64, len(docs))
            offsets = np.concatenate([[0], np.cumsum(lens)])
            ids = np.fromiter((get(w, -1) for w in chain.from_iterable(docs)), np.int64, int(offsets[-1]))
            places = np.flatnonzero(ids >= 0)
            edges = np.searchsorted(places, offsets)
            anchored = np.diff(np.searchsorted(places[np.isin(ids[places], anchors)], offsets))
            rows = []
            for d in range(len(docs)):
                own = places[edges[d] : edges[d + 1]]
                found = find(index, own - offsets[d], ids[own], drift, share) if anchored[d] else []
                at = [s for t, s, _ in found if t < index.n_base]
                rows.append((
                    len(at), min(at, default=None), max(at, default=None),
                    ",".join(sorted({index.templates[t].label for t, _, _ in found if t < index.n_base})), ",".join(sorted({index.templates[t].label for t, _, _ in found})),
                    max((s for _, _, s in found), default=0.0), [{"label": index.templates[t].label, "start": s, "score": x} for t, s, x in sorted(found)],
                ))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("score", pa.float64())]))), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(lens), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task, SCHEMA)
