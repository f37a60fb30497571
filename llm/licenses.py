"""License notices in texts, by an exact set-similarity join of lines and word windows with templates.

A line matches a template when it holds at least THRESHOLD of the template's distinct
words. Template words are ordered by their frequency over all texts, rare ones first.
A line that matches must hold one of the first |T| - need + 1 of them (prefix filter), have
`need` words (length filter), and hold enough words from its first match on (positional filter);
what passes is verified by counting. As notices are wrapped, the same holds for windows of
consecutive words across line breaks, as long as the template's words over THRESHOLD: a window that
matches begins with a template word and holds `need` of them, repeated or not, which is
looked at before distinct ones are counted. Base phrases are found at consecutive words.

Words are lower-cased runs of digits, a-z and characters beyond ASCII. Defined results: a
null or empty text has no word, no label, score 0; repeated rows are scanned each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import LOWER, Prefix, raw, segments

THRESHOLD = 0.85

# Phrases with their labels, and notices with theirs.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("notice-apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("notice-apache-2.0", "you may not use this file except in compliance with the License"),
    ("notice-mit", "Released under the MIT License"),
    ("notice-mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("notice-gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("notice-gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("notice-bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("notice-mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("notice-cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("notice-cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("notice-cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]

_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@dataclass
class Words:
    row: np.ndarray
    line: np.ndarray
    hash: np.ndarray


def scan(texts: list[bytes]) -> Words:
    """Every word in order: its row, a number for its line, its hash."""
    rows_, lines, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    line = 0
    for data, rows, begins in segments(texts):
        data = LOWER[data]
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = _IN_WORD[data]
        edges = np.flatnonzero(np.diff(inside))
        start, end = edges[0::2], edges[1::2]
        breaks = data == 10
        breaks[begins[1:] - 1] = False  # what joins pieces isn't in the texts
        number = line + np.cumsum(breaks)
        rows_.append(rows[np.searchsorted(begins, start, side="right") - 1])
        lines.append(number[start])
        hashes.append(Prefix(data).of(start, end))
        line = int(number[-1]) if len(number) else line
    return Words(np.concatenate(rows_), np.concatenate(lines), np.concatenate(hashes))


def word_hashes(text: str) -> list[int]:
    return scan([text.encode()]).hash.tolist()


def phrase_places(words: Words, phrase: list[int]) -> np.ndarray:
    """Indexes of words where the phrase begins."""
    n = len(words.hash) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(words.hash[:n] == np.uint64(phrase[0]))
    for k, h in enumerate(phrase[1:], 1):
        at = at[(words.hash[at + k] == np.uint64(h)) & (words.row[at + k] == words.row[at])]
    return at


class Templates:
    """Templates as sets of words in one global order."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.labels = [label for label, _ in templates]
        spelled = [word_hashes(text) for _, text in templates]
        self.sets = [set(words) for words in spelled]
        self.width = [math.ceil(len(words) / threshold - 1e-9) for words in spelled]
        self.need = [math.ceil(threshold * len(s) - 1e-9) for s in self.sets]
        self.vocabulary = np.array(sorted(set().union(*self.sets)), dtype=np.uint64)
        self.order(np.zeros(len(self.vocabulary)))

    def order(self, frequency: np.ndarray) -> None:
        rank = np.empty(len(self.vocabulary), dtype=np.int64)
        rank[np.lexsort((self.vocabulary, frequency))] = np.arange(len(rank))
        self.rank = rank
        self.tokens = [np.sort(rank[np.searchsorted(self.vocabulary, np.array(list(s), np.uint64))]) for s in self.sets]

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(index of word, place in the vocabulary) of the words that stand in a template."""
        at = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == words.hash)
        return hit, at[hit]

    def match(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(template, row of each matching line, containment)."""
        index, place = self.hits(words)
        if not len(index):
            return
        line_key = (words.row << 32) | (words.line & 0xFFFFFFFF)
        lines, size = np.unique(line_key, return_counts=True)
        block = np.searchsorted(lines, line_key[index])
        pairs = np.unique(block * len(self.rank) + self.rank[place])
        block, token = pairs // len(self.rank), pairs % len(self.rank)
        for k, tokens in enumerate(self.tokens):
            need = self.need[k]
            prefix = tokens[: len(tokens) - need + 1]
            first = np.isin(token, prefix)
            candidates = np.unique(block[first])
            candidates = candidates[size[candidates] >= need]
            if not len(candidates):
                continue
            mine = np.isin(block, candidates) & np.isin(token, tokens)
            own_block, own_token = block[mine], token[mine]
            begins = np.flatnonzero(np.append(True, own_block[1:] != own_block[:-1]))
            counts = np.diff(np.append(begins, len(own_block)))
            place_in_template = np.searchsorted(tokens, own_token[begins])
            possible = np.minimum(counts, len(tokens) - place_in_template) >= need
            begins, counts = begins[possible], counts[possible]
            good = counts >= need
            yield k, lines[own_block[begins[good]]] >> 32, counts[good] / len(tokens)
        ranks, rows = self.rank[place], words.row[index]
        for k, tokens in enumerate(self.tokens):
            yield (k, *self.match_windows(k, tokens, index, ranks, rows))

    def match_windows(
        self, k: int, tokens: np.ndarray, index: np.ndarray, ranks: np.ndarray, rows: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(row, containment) of every window of template `k`'s width that matches it, wherever lines end."""
        need, width = self.need[k], self.width[k]
        in_template = np.zeros(len(self.rank), dtype=bool)
        in_template[tokens] = True
        mine = np.flatnonzero(in_template[ranks])
        index, ranks, rows = index[mine], ranks[mine], rows[mine]
        begins = np.arange(max(len(index) - need + 1, 0))
        last = begins + need - 1
        begins = begins[(index[last] < index[begins] + width) & (rows[last] == rows[begins])]
        seen = np.zeros((len(begins), len(tokens)), dtype=bool)
        for step in range(width):
            at = np.minimum(begins + step, len(index) - 1)
            inside = (begins + step < len(index)) & (index[at] < index[begins] + width) & (rows[at] == rows[begins])
            seen[np.flatnonzero(inside), np.searchsorted(tokens, ranks[at[inside]])] = True
        counts = seen.sum(axis=1)
        good = (counts >= need) & seen[:, : len(tokens) - need + 1].any(axis=1)
        return rows[begins[good]], counts[good] / len(tokens)


def template_frequencies(df: DataFrame, templates: Templates, text: str) -> np.ndarray:
    """How often each template word occurs over all texts."""
    n = len(templates.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype=np.int64)
        for batch in batches:
            _, place = templates.hits(scan(raw(batch.column(0).to_pylist())))
            total += np.bincount(place, minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total)], ["word", "n"])

    sums = df.select(F.col(text)).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(n)
    for row in sums.collect():  # one row for each template word
        out[row["word"]] = row["n"]
    return out


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def scan_licenses(
    df: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `df`; `score` is the best containment found, 1 for a base phrase."""
    known = Templates(templates, threshold)
    known.order(template_frequencies(df, known, text))
    phrases = {label: word_hashes(phrase) for phrase, label in PHRASES.items()}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words = scan(raw(batch.column("text").to_pylist()))
            counts = np.bincount(words.row, minlength=n)
            begin = np.cumsum(counts) - counts
            base: list[set[str]] = [set() for _ in range(n)]
            extra: list[set[str]] = [set() for _ in range(n)]
            places: list[list[int]] = [[] for _ in range(n)]
            score = np.zeros(n)
            for label, phrase in phrases.items():
                for at in phrase_places(words, phrase).tolist():
                    row = int(words.row[at])
                    places[row].append(at - int(begin[row]))
                    base[row].add(label)
                    score[row] = 1.0
            for k, rows, containment in known.match(words):
                np.maximum.at(score, rows, containment)
                for row in np.unique(rows).tolist():
                    extra[row].add(known.labels[k])
            columns = [
                batch.column("doc_id"),
                pa.array(counts),
                pa.array([len(p) for p in places], pa.int64()),
                pa.array([min(p) if p else None for p in places], pa.int64()),
                pa.array([max(p) if p else None for p in places], pa.int64()),
                pa.array([",".join(sorted(b)) for b in base]),
                pa.array([",".join(sorted(b | x)) for b, x in zip(base, extra, strict=True)]),
                pa.array(score),
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in SCHEMA.split(", ")])

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(find, SCHEMA)
