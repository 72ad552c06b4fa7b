"""License scans: exact phrases, and short notices found with a bounded number of errors.

A notice of m characters that stands in a text with at most e errors, cut into e + 1 seeds,
has at least one seed in the text unchanged (the pigeonhole principle). One automaton finds
all seeds; around each, the regex library's bounded-error matching decides: the first match is
looked for, then the best one that begins there, and the search goes on behind it. Texts are searched in normal form: their words, joined by single spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm.words import ALPHANUMERIC, slices, translated

# Phrases whose exact places count, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Short notices in normal form, with their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors", "bsd"),
    ("creative commons attribution", "cc"),
    ("licensed under cc by", "cc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("boost software license", "boost"),
    ("all rights reserved", "reserved"),
)

# A notice may have an error for each so many characters, and at most MOST_ERRORS.
PER_ERROR, MOST_ERRORS = 10, 5


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int
    pattern: regex.Pattern
    best: regex.Pattern

    def seeds(self) -> list[tuple[str, int]]:
        """The text cut into errors + 1 parts of about equal length, each with its place."""
        cuts = [len(self.text) * k // (self.errors + 1) for k in range(self.errors + 2)]
        return [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:])]


def notices(pairs=NOTICES, per_error: int = PER_ERROR, most: int = MOST_ERRORS) -> list[Notice]:
    """The notices, each with its bounded-error patterns, for any match and for the best one.

    They stand between word borders.
    """
    found = []
    for text, label in pairs:
        errors = min(len(text) // per_error, most)
        pattern = (rf"(?<![^ ])(?:{regex.escape(text, special_only=True, literal_spaces=True)})"
                   rf"{{e<={errors}}}(?![^ ])")
        found.append(Notice(text, label, errors, regex.compile(pattern),
                            regex.compile(f"(?b){pattern}")))
    return found


class Scanner:
    """Finds notices in normal form texts."""

    def __init__(self, known: list[Notice]) -> None:
        self.known = known
        self.seeds = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(known):
            for seed, at in notice.seeds():
                places.setdefault(seed, []).append((k, at))
        for seed, owners in places.items():
            self.seeds.add_word(seed, (len(seed), owners))
        self.seeds.make_automaton()

    def regions(self, text: str) -> dict[int, list[list[int]]]:
        """Where each notice may stand: around its seeds, with room for its errors."""
        found: dict[int, list[list[int]]] = {}
        for last, (length, owners) in self.seeds.iter(text):
            start = last - length + 1
            for k, at in owners:
                notice = self.known[k]
                # Errors move the start, and errors make it longer; one more character on
                # each side is looked at as a border.
                first = max(0, start - at - notice.errors - 1)
                end = start - at + len(notice.text) + 2 * notice.errors + 1
                spans = found.setdefault(k, [])
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([first, end])
        return found

    def matches(self, notice: Notice, text: str, at: int, end: int) -> Iterator[regex.Match]:
        """The matches of a notice in a region, from left to right, without overlaps.

        The best match is taken from a window that has no room for two of them, so a better one
        further on does not hide those before it.
        """
        while (first := notice.pattern.search(text, at, end)) is not None:
            border = text.find(" ", first.start() + len(notice.text) + 3 * notice.errors, end)
            found = notice.best.search(text, first.start(), border if border >= 0 else end) or first
            yield found
            at = found.end()

    def __call__(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(first, end, label, errors, likeness) of all notices found, in order."""
        found = []
        for k, spans in self.regions(text).items():
            notice = self.known[k]
            for first, end in spans:
                for match in self.matches(notice, text, first, min(end, len(text))):
                    errors = sum(match.fuzzy_counts)
                    likeness = 1 - errors / len(notice.text)
                    found.append((match.start(), match.end(), notice.label, errors, likeness))
        return sorted(found)


def phrase_places(normal: str) -> list[tuple[int, str]]:
    """(first word, label) of every place where the words of a phrase stand one after another."""
    text, found = f" {normal} ", []
    for phrase, label in PHRASES:
        at, counted, word = text.find(f" {phrase} "), 0, 0
        while at >= 0:
            word += text.count(" ", counted, at)
            found.append((word, label))
            counted, at = at, text.find(f" {phrase} ", at + 1)
    return sorted(found)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, "
          "spans array<struct<first_word:long,end_word:long,label:string,errors:long>>")


def license_scan(docs: DataFrame, pairs=NOTICES) -> DataFrame:
    """Phrases and notices in each row of ``docs`` (doc_id, text).

    Words are runs of 0-9, a-z (A-Z lower-cased) and all that is not ASCII. ``n_base`` counts
    the places of the exact phrases, ``first_word`` and ``last_word`` are the least and
    greatest of them (null without one), ``base_labels`` their labels. ``labels`` adds those of the
    notices found with errors; ``spans`` has the words of each such notice and its errors.
    ``score`` is the likeness of the best find: 1 for a phrase, 1 - errors / length for a
    notice, 0 for nothing.

    Texts are searched whole where they are read; nothing is shuffled. Null and empty texts
    have no words; each row gives one row, repeated rows alike; a null doc_id stays null;
    columns other than doc_id and text are not read; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices(pairs))
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                found = [_scanned(text, scanner)
                         for text in translated(texts, ALPHANUMERIC).to_pylist()]
                columns = list(zip(*found))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([
                    ("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()),
                    ("errors", pa.int64())]))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").cast(pa.int64()),
                     *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word",
                           "base_labels", "labels", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


def _scanned(text: str, scanner: Scanner) -> tuple:
    normal = " ".join(filter(None, text.split(" ")))
    n_words = normal.count(" ") + 1 if normal else 0
    places = phrase_places(normal) if "license" in normal else []
    found = scanner(normal)
    base = {label for _, label in places}
    spans, counted, word = [], 0, 0
    for first, end, label, errors, _ in found:
        word += normal.count(" ", counted, first)
        counted = first
        spans.append({"first_word": word, "label": label, "errors": errors,
                      "end_word": word + normal.count(" ", first, end) + 1})
    score = 1.0 if places else max((f[4] for f in found), default=0.0)
    return (n_words, len(places), places[0][0] if places else None,
            places[-1][0] if places else None, ",".join(sorted(base)),
            ",".join(sorted(base | {f[2] for f in found})), score, spans)
