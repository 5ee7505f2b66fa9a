"""License scans: base phrases, and fuzzy search for short notices.

Method. A notice that may differ by ``k`` edits is split into ``k + 1`` pieces; wherever it occurs,
at least one piece occurs unchanged (pigeonhole). Pieces are searched as plain strings, and only
around each of their places, in a window of the notice's length and ``k`` more on both sides, widened
to whole words, the regex library looks for the whole notice with at most ``k`` errors, in its
best-match mode, which verifies the edits and gives the span. Windows are verified one by one, so
that a better match nearby hides none and the work grows with the places.

A match stands on whole words, and edits never change what names the licence: of the notice's own
``names``, those of up to four letters stand in the span unchanged and longer ones within one edit,
in order; and where the notice has a version, the span's numbers are the first of the notice's. So a
short name is never edited into another. Names compete: of overlapping matches the one with the
fewest edits for its length stays; of equal ones the longer.

A match is denied, whatever its notice, if one of the ``REACH`` words before it says so ("not", "isn't",
"never") with no end of a sentence between, or if a word of it is one of the notice's with "un" or "non"
before it. A denied match keeps its place and gives no label. Base labels are no matter of denial. Text is compared as lower-case words with single blanks.

Cases. Null and empty texts have no words and no labels, score 0. A text is searched whole. Repeated
rows are scanned each. Overlapping places of a phrase all count. Equal matches: the longer, the
earlier, then the lesser label stays. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.common import alnum_words, as_bytes, per_batch, table

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notice text, label, edits allowed, names that edits may not change.
NOTICES = (
    ("released under the mit license", "mit", 3, "mit"),
    ("licensed under the mit license", "mit", 3, "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6, ""),
    ("licensed under the apache license version 2 0", "apache-2", 4, "apache 2"),
    ("licensed under cc by 4 0", "cc-by", 2, "cc by"),
    ("licensed under cc by sa 4 0", "cc-by-sa", 2, "cc by sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd", 2, "cc by nd"),
    ("licensed under cc by nc 4 0", "cc-by-nc", 2, "cc by nc"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", 2, "cc by nc sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", 2, "cc by nc nd"),
    ("licensed under the gnu general public license version 3", "gpl-3", 4, "gnu general 3"),
    ("licensed under the gnu general public license version 2", "gpl-2", 4, "gnu general 2"),
    ("licensed under the gnu lesser general public license", "lgpl", 4, "gnu lesser general"),
    ("licensed under the gnu affero general public license", "agpl", 4, "gnu affero general"),
    ("licensed under the gpl license", "gpl", 3, "gpl"),
    ("released under the gpl license", "gpl", 3, "gpl"),
    ("licensed under the bsd license", "bsd", 3, "bsd"),
    ("released under the bsd license", "bsd", 3, "bsd"),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 6, ""),
    ("licensed under the isc license", "isc", 3, "isc"),
    ("released under the isc license", "isc", 3, "isc"),
    ("licensed under the eclipse public license", "epl", 3, "eclipse"),
    ("licensed under the epl license", "epl", 3, "epl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2", 4, "mozilla 2"),
    ("this is free and unencumbered software released into the public domain", "unlicense", 5, "domain"),
    # names as people write them
    ("the mit license", "mit", 1, "mit"),
    ("mit license", "mit", 1, "mit"),
    ("apache license 2 0", "apache-2", 1, "apache 2"),
    ("apache 2 0 license", "apache-2", 1, "apache 2"),
    ("gnu gpl v3", "gpl-3", 0, "gpl v3"),
    ("gpl v3", "gpl-3", 0, "gpl v3"),
    ("gplv3", "gpl-3", 0, "gplv3"),
    ("gpl 3 0", "gpl-3", 0, "gpl 3"),
    ("gpl v2", "gpl-2", 0, "gpl v2"),
    ("gplv2", "gpl-2", 0, "gplv2"),
    ("gpl 2 0", "gpl-2", 0, "gpl 2"),
    ("lgpl v3", "lgpl", 0, "lgpl v3"),
    ("lgplv3", "lgpl", 0, "lgplv3"),
    ("agpl v3", "agpl", 0, "agpl v3"),
    ("agplv3", "agpl", 0, "agplv3"),
    ("bsd 3 clause license", "bsd-3", 2, "bsd 3"),
    ("bsd 3 clause", "bsd-3", 1, "bsd 3"),
    ("3 clause bsd license", "bsd-3", 2, "3 bsd"),
    ("bsd 2 clause license", "bsd-2", 2, "bsd 2"),
    ("bsd 2 clause", "bsd-2", 1, "bsd 2"),
    ("2 clause bsd license", "bsd-2", 2, "2 bsd"),
    ("mozilla public license 2 0", "mpl-2", 2, "mozilla 2"),
    ("mpl 2 0", "mpl-2", 0, "mpl 2"),
    ("boost software license", "bsl", 2, "boost"),
    ("creative commons attribution 4 0", "cc-by", 3, "creative commons attribution 4"),
    ("creative commons zero v1 0 universal", "cc0", 3, "creative commons zero"),
    ("cc0 1 0 universal", "cc0", 1, "cc0"),
)
#: Words that deny a notice soon after them, and how many words back they count.
DENIALS = frozenset(b"unlicensed unreleased not no never neither nor cannot without isn wasn aren weren hasn haven don doesn didn won".split())
REACH = 5
SENTENCE_END = re.compile(rb"[.!?;:\n]")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


#: Verified windows kept by their text; repeated lines ask for the same ones.
KEPT_WINDOWS = 4096


def _one_edit(a: bytes, b: bytes) -> bool:
    """At most one letter is put in, left out or changed."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


@dataclass
class Notice:
    text: bytes
    label: str
    edits: int
    names: bytes = b""

    def __post_init__(self):
        n, k = len(self.text), self.edits
        cuts = [n * i // (k + 1) for i in range(k + 2)]
        self.seeds = [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.verify = lru_cache(KEPT_WINDOWS)(self._verify)
        self.pattern = regex.compile(rb"(?b)(?<![^ ])(?:" + regex.escape(self.text) + rb"){e<=%d}(?![^ ])" % k)
        self.named = self.names.split()
        self.words = frozenset(self.text.split())
        self.numbers = [w for w in self.text.split() if w.isdigit()]
        self.versioned = any(w.isdigit() for w in self.named)

    def is_named(self, span: bytes) -> bool:
        """The span has the notice's names, in order, and its version."""
        words = span.split()
        if self.versioned:
            numbers = [w for w in words if w.isdigit()]
            if not numbers or numbers != self.numbers[: len(numbers)]:
                return False
        left = iter(words)
        return all(any(w == name or len(name) > 4 and _one_edit(w, name) for w in left) for name in self.named)

    def undone(self, span: bytes) -> bool:
        """A word of the notice stands in the span with "un" or "non" before it."""
        return any(w.startswith(p) and w[len(p) :] in self.words for w in span.split() for p in (b"un", b"non"))

    def find(self, text: bytes) -> list[tuple[int, int, int]]:
        """``(start, end, edits)`` of matches around exact seeds, on whole words."""
        n, k, size = len(text), self.edits, len(self.text)
        places: set[int] = set()
        for seed, offset in self.seeds:
            at = text.find(seed)
            while at >= 0:
                places.add(at - offset)
                at = text.find(seed, at + 1)
        found = set()
        for at in places:
            if at >= 0 and text.startswith(self.text, at) and text[at - 1 : at] in (b"", b" ") and text[at + size : at + size + 1] in (b"", b" "):
                found.add((at, at + size, 0))
                continue
            # the window is cut at blanks; a word of no end would make it longer than any match
            low, high = max(0, at - k), min(n, at + size + k)
            low = max(text.rfind(b" ", max(0, low - size), low) + 1, low - size, 0)
            after = text.find(b" ", high, high + size)
            high = after if after >= 0 else min(n, high + size)
            hit = self.verify(text[low:high], low > 0 and text[low - 1] != 32, high < n and text[high] != 32)
            if hit:
                found.add((low + hit[0], low + hit[1], hit[2]))
        return sorted(found)

    def _verify(self, window: bytes, cut_before: bool, cut_after: bool) -> tuple[int, int, int] | None:
        # where a long word was cut, its rest is no word
        text = b"x" * cut_before + window + b"x" * cut_after
        low, high = 0, len(text)
        while (m := self.pattern.search(text, low, high)) is not None:
            if self.is_named(m[0]):
                return m.start() - cut_before, m.end() - cut_before, sum(m.fuzzy_counts)
            # the best match has other names or numbers: without its last word, then without its first
            end = m[0].rfind(b" ")
            if end > 0 and high - m.end() < self.edits + len(self.text) // 2:
                high = m.start() + end
            elif (start := m[0].find(b" ")) > 0:
                low, high = m.start() + start + 1, len(text)
            else:
                return None
        return None


def denied(text: bytes, flat: bytes, start: int) -> bool:
    """Whether one of the words before a match denies it, in the same sentence of the text."""
    before = flat[max(0, start - 200) : start].split()[-REACH:]
    at = next((k for k in range(len(before) - 1, -1, -1) if before[k] in DENIALS), None)
    if at is None:
        return False
    place = flat.count(b" ", 0, start)  # the match's first word
    words = list(islice(_WORD.finditer(text), place - (len(before) - at), place + 1))
    return len(words) < 2 or not SENTENCE_END.search(text, words[0].end(), words[-1].start())


class Scanner:
    def __init__(self, notices=NOTICES):
        self.notices = [Notice(t.encode(), label, k, b" ".join(n.encode() for n in names)) for t, label, k, *names in notices]

    def scan(self, text: bytes | None) -> dict:
        words = alnum_words(text)
        flat = b" ".join(words)
        padded = b" " + flat + b" "
        places: list[tuple[int, str]] = []
        for phrase, label in BASE.items():
            needle = f" {phrase} ".encode()
            at, seen, words_before = padded.find(needle), 0, 0
            while at >= 0:
                words_before += padded.count(b" ", seen, at)
                seen = at
                places.append((words_before, label))
                at = padded.find(needle, at + 1)
        base = {label for _, label in places}
        matches = ((e / len(n.text), s, t, "" if n.undone(flat[s:t]) or denied(text, flat, s) else n.label, e) for n in self.notices for s, t, e in n.find(flat))
        found = sorted(matches, key=lambda f: (f[0], f[1] - f[2], f[1], f[3]))
        taken: list[tuple] = []  # disjoint, in the order of their starts
        starts: list[int] = []
        for f in found:
            i = bisect_left(starts, f[1])
            if (i == 0 or taken[i - 1][2] <= f[1]) and (i == len(taken) or f[2] <= starts[i]):
                taken.insert(i, f)
                starts.insert(i, f[1])
        spans, seen, words_before = [], 0, 0
        for _, start, end, label, edits in taken:
            if not label:
                continue
            words_before += flat.count(b" ", seen, start)
            seen = start
            spans.append(f"{label}:{words_before}-{words_before + flat.count(b' ', start, end)}:{edits}")
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min((i for i, _ in places), default=None),
            "last_word": max((i for i, _ in places), default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {f[3] for f in taken if f[3]})),
            "score": 1.0 if base else max((1 - f[0] for f in taken if f[3]), default=0.0),
            "spans": ";".join(spans),
        }


def scan(docs: DataFrame, keep: list[str], notices=NOTICES) -> DataFrame:
    """Add the base counts, labels, score and ``spans`` (label, first and last word, edits of each match)."""
    schema = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"

    def make():
        scanner = Scanner(notices)

        def run(batch: pa.RecordBatch) -> dict[str, list]:
            got = [scanner.scan(t) for t in as_bytes(batch.column("text"))]
            return {f.split()[0]: [g[f.split()[0]] for g in got] for f in schema.split(",")}

        return run

    return per_batch(docs.select(*dict.fromkeys([*keep, "text"])), make, schema, keep)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
