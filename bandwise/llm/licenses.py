"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words; windows overlap by half, so every
span of half a window lies whole in one. A template is found in a block that
holds at least ``threshold`` of its distinct words.

1. One pass over all texts counts in how many blocks each template word
   occurs; the words of a template are put in the order of that global
   frequency, rarest first.
2. Prefix filter: a block that reaches the threshold holds one of the first
   |T| - ceil(threshold |T|) + 1 words of the template. Only texts with such a
   rare word go on, and of them only the windows around one.
3. Length filter: a block with fewer distinct words than are needed fails.
   Positional filter: words are looked up in the global order, and a template
   is given up as soon as the words found and those left cannot reach it.

The templates are a short list, so their index goes along with the task and
the texts never move.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_of, text_slices

#: Words: runs of ASCII digits, letters (lower-cased) and everything outside ASCII.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
BLOCK_WORDS = 64
THRESHOLD = 0.9

# Phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Fixed values: (label, template) of public license notices.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(WORD_TABLE).split()


def starts(n_words: int, block: int) -> range:
    """Where the windows start: every half block, as long as a window has words that none before had."""
    return range(0, max(1, n_words - block // 2), block // 2)


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


class Templates:
    """Templates in global frequency order, with the index of their prefix words."""

    def __init__(self, templates: Sequence[tuple[str, str]], frequency: Mapping[bytes, int], threshold: float):
        self.items, self.prefix = [], {}
        for label, text in templates:
            ordered = sorted(set(words_of(text)), key=lambda w: (frequency.get(w, 0), w))
            need = needed(len(ordered), threshold)
            for w in ordered[:len(ordered) - need + 1]:
                self.prefix.setdefault(w, []).append(len(self.items))
            self.items.append((label, ordered, need))

    def found(self, words: list[bytes], block: int) -> dict[str, float]:
        """Label -> highest containment of one of its templates in a block, if one reaches the threshold."""
        rare = self.prefix.keys() & set(words)
        if not rare:
            return {}
        out: dict[str, float] = {}
        at = np.flatnonzero(np.fromiter((w in rare for w in words), bool, len(words)))
        for start in starts(len(words), block):
            low, high = np.searchsorted(at, (start, start + block))
            if low == high:
                continue
            inside = set(words[start:start + block])
            for t in {t for i in at[low:high] for t in self.prefix[words[i]]}:
                label, ordered, need = self.items[t]
                if len(inside) < need:
                    continue
                hits = 0
                for place, w in enumerate(ordered):
                    hits += w in inside
                    if hits + len(ordered) - place - 1 < need:
                        break
                else:
                    out[label] = max(out.get(label, 0.0), hits / len(ordered))
        return out


def phrase_places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[int, str]]:
    """(start in words, label) of every place where a phrase's words stand one after the other."""
    text, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        wanted, at = b" " + phrase.encode() + b" ", -1
        while (at := text.find(wanted, at + 1)) >= 0:
            out.append((text.count(b" ", 0, at), label))
    return out


def _frequencies(vocabulary: frozenset[bytes], block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(vocabulary, 0)
        for part in text_slices(batches):
            for text in part.column("text").to_pylist():
                words = words_of(text)
                if vocabulary.isdisjoint(words):
                    continue
                for start in starts(len(words), block):
                    for w in vocabulary.intersection(words[start:start + block]):
                        total[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                         ["word", "n"])
    return run


def _scanned(templates: Templates, phrases: Mapping[str, str], block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = []
            for text in part.column("text").to_pylist():
                words = words_of(text)
                places, extra = phrase_places(words, phrases), templates.found(words, block)
                base = {label for _, label in places}
                first = [p for p, _ in places]
                rows.append((len(words), len(places), min(first, default=None), max(first, default=None),
                             ",".join(sorted(base)), ",".join(sorted(base | extra.keys())),
                             max([1.0] * bool(base) + list(extra.values()), default=0.0)))
            columns = zip(*rows, strict=True)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  phrases: Mapping[str, str] | None = None, threshold: float = THRESHOLD,
                  block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``labels`` joins the labels of the phrases and of the templates found;
    ``score`` is 1 where a phrase stands, else the highest containment of a
    template that was found, else 0. Null or empty text has no words and no
    labels (empty strings, null places). Repeated rows are each returned; an
    empty table gives an empty table.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    vocabulary = frozenset(w for _, t in templates for w in words_of(t))
    if block_words < 2 * max((len(words_of(t)) for _, t in templates), default=1):
        raise ValueError("a block must have twice the words of the longest template")
    # As many rows as the templates have words.
    counted = (docs.select("text").mapInArrow(_frequencies(vocabulary, block_words), "word binary, n long")
               .groupBy("word").agg(F.sum("n").alias("n")).toPandas())
    frequency = {bytes(w): int(n) for w, n in zip(counted["word"], counted["n"], strict=True)}
    index = Templates(templates, frequency, threshold)
    return docs.mapInArrow(_scanned(index, PHRASES if phrases is None else phrases, block_words),
                           f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, "
                           "base_labels string, labels string, score double")
