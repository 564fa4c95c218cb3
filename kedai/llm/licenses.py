"""Licence scan: a positional index of rare template words, intersected by relative position."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import batch_rows, small_batches, text_or_empty

# Phrases that name a licence by themselves.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Label, wording of the notice, and the part of it that must be there word by word.
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files",
        "permission is hereby granted free of charge to any person obtaining a copy",
    ),
    ("mit", "released under the mit license", "the mit license"),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except "
        "in compliance with the license",
        "apache license version 2 0",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation",
        "under the terms of the gnu general public license",
    ),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        "gnu general public license version 3",
    ),
    (
        "lgpl",
        "it under the terms of the gnu lesser general public license as published by",
        "gnu lesser general public license",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms with or without modification",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "permission to use copy modify and or distribute this software",
    ),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    (
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        "creative commons attribution",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("proprietary", "copyright all rights reserved", "all rights reserved"),
)

# Rare words of each mandatory part that are indexed.
RARE = 3

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(
    b if b in _KEEP or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def licence_words(text: str | None) -> list[bytes]:
    """Words of ASCII letters, digits and any characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    key: tuple[bytes, ...]

    @property
    def key_at(self) -> int:
        """Place of the mandatory part in the wording."""
        size = len(self.key)
        return next(k for k in range(len(self.words)) if self.words[k : k + size] == self.key)


def templates() -> list[Template]:
    return [
        Template(label, tuple(licence_words(text)), tuple(licence_words(key)))
        for label, text, key in TEMPLATES
    ]


def vocabulary() -> list[bytes]:
    return sorted({word for template in templates() for word in template.words})


def document_frequencies(rows: DataFrame) -> DataFrame:
    """How many of all documents hold each template word, and, under a null word, their number."""
    wanted = frozenset(vocabulary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for (text,) in batch_rows(batches, "text"):
            held.update(wanted.intersection(licence_words(text)))
            held[None] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None if w is None else w.decode() for w in held], pa.string()),
                pa.array(list(held.values()), pa.int64()),
            ],
            names=["word", "n"],
        )

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """Postings of the rarest words of every mandatory part: word -> (template, place) pairs."""

    def __init__(self, frequencies: dict[str | None, int]):
        total = frequencies.get(None, 0)
        self.idf = {
            word: math.log((total + 1) / (frequencies.get(word.decode(), 0) + 1)) + 1
            for word in vocabulary()
        }
        self.templates = templates()
        self.needed: list[int] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, template in enumerate(self.templates):
            places: dict[bytes, int] = {}
            for place, word in enumerate(template.key):
                places.setdefault(word, template.key_at + place)
            rare = sorted(places, key=lambda word: (-self.idf[word], word))[:RARE]
            self.needed.append(len(rare))
            for word in rare:
                self.postings[word].append((number, places[word]))

    def starts(self, words: list[bytes]) -> list[tuple[int, int]]:
        """Templates and the file places of their first word where all rare words stand in place.

        The file's index words are looked up from the rarest on, so that the diagonals of a template
        are drawn from its rarest word and later words only confirm them.
        """
        found = set(self.postings).intersection(words)
        if not found:
            return []
        at: dict[bytes, list[int]] = defaultdict(list)
        for place, word in enumerate(words):
            if word in found:
                at[word].append(place)
        votes: Counter = Counter()
        for word in sorted(found, key=lambda w: (-self.idf[w], w)):
            for number, place in self.postings[word]:
                votes.update((number, p - place) for p in at[word])
        return [
            (number, start)
            for (number, start), n in votes.items()
            if n == self.needed[number] and self._verified(self.templates[number], words, start)
        ]

    @staticmethod
    def _verified(template: Template, words: list[bytes], start: int) -> bool:
        at = start + template.key_at
        return at >= 0 and tuple(words[at : at + len(template.key)]) == template.key

    def share(self, number: int, start: int, words: list[bytes]) -> float:
        """Weight of the template's words that stand in place, of its whole weight."""
        template = self.templates[number]
        whole = sum(self.idf[word] for word in template.words)
        there = sum(
            self.idf[word]
            for place, word in enumerate(template.words)
            if 0 <= start + place < len(words) and words[start + place] == word
        )
        return min(1.0, there / whole)


_PHRASES = [(tuple(licence_words(phrase)), label) for phrase, label in BASE]


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Every place where a base phrase stands, with its label."""
    found = []
    if b"license" not in words:
        return found
    for at, word in enumerate(words):
        if word == b"license":
            for phrase, label in _PHRASES:
                start = at + 1 - len(phrase)
                if start >= 0 and tuple(words[start : at + 1]) == phrase:
                    found.append((start, label))
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences named or quoted in every text.

    Returns doc_id, n_words, n_base (places of base phrases), first_word and last_word (their least
    and greatest start, null without any), base_labels, labels (base labels and those of templates
    whose mandatory part is found; distinct, sorted, comma-joined), score (0 without any licence, 1
    for a base phrase, else the greatest weighted share of a found template's wording) and notices,
    the found templates as ``label:first word`` in order of place.

    Word weights are inverse document frequencies over all documents; only the template words'
    counts, a few hundred numbers, reach the driver. Null and empty texts have no words. Null and
    repeated ids keep a row each. Extra columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    frequencies = {row["word"]: row["n"] for row in document_frequencies(rows).collect()}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(frequencies)
        for batch in batches:
            columns: list[list] = [[] for _ in NAMES[1:]]
            for (text,) in batch_rows(iter([batch]), "text"):
                words = licence_words(text)
                base = base_places(words)
                places = [at for at, _ in base]
                notices = sorted(index.starts(words), key=lambda x: (x[1], x[0]))
                named = {label for _, label in base}
                quoted = {index.templates[number].label for number, _ in notices}
                shares = [index.share(number, start, words) for number, start in notices]
                row = (
                    len(words),
                    len(base),
                    min(places, default=None),
                    max(places, default=None),
                    ",".join(sorted(named)),
                    ",".join(sorted(named | quoted)),
                    1.0 if base else max(shares, default=0.0),
                    ",".join(f"{index.templates[number].label}:{start}" for number, start in notices),
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, kind) for c, kind in zip(columns, KINDS[1:], strict=True)),
                ],
                names=NAMES,
            )

    return rows.mapInArrow(find, SCHEMA)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, notices string"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
KINDS = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.string()]
