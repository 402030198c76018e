"""License scans: exact base phrases, and a fuzzy search for short notices.

A notice of m characters with up to k edits is cut into k + 1 pieces; by the pigeonhole principle one piece stands
unedited in every fuzzy occurrence. One automaton finds all pieces of all notices; around each, the regex library's
bounded-error matching verifies the whole notice and reports its span and its edits.

Cases: null text is the empty text (0 words, no labels, null spans); very long texts are whole; overlapping finds of
one notice keep the one with fewer edits, ties to the earlier; repeated rows are scanned one by one; a null id is
kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillfeed.llm.arrow import slices
from quillfeed.session import ship_package

#: Phrases whose words must stand consecutively, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Short notices of the fuzzy search (normalised words), and the labels that they add.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-notice",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "this program is free software you can redistribute it and or modify": "gpl-notice",
    "under the terms of the gnu general public license": "gpl-notice",
    "this work is licensed under a creative commons attribution": "cc-notice",
    "licensed under cc by 4 0": "cc-notice",
    "mozilla public license version 2 0": "mpl-2.0",
    "all rights reserved": "all-rights-reserved",
}
#: Edits that a notice may hold: one for each so many characters.
CHARACTERS_PER_EDIT = 12

#: Bytes of words after A-Z are lowered: digits, a-z and everything beyond ASCII.
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90 or b >= 128 for b in range(256)])
_PLAIN = bytes((b + 32 if 65 <= b <= 90 else b) if _WORD[b] else 32 for b in range(256))
_SPACES = re.compile(rb" +")
_BASE = re.compile(
    rb"(?<![^ ])(?:" + b"|".join(b"(" + p.replace(" ", " +").encode() + b")" for p in BASE_PHRASES) + rb")(?![^ ])"
)
_BASE_LABELS = [*BASE_PHRASES.values()]


class NoticeSearch:
    """The automaton of the seeds and the bounded-error patterns; made once for each Python worker."""

    def __init__(self, notices: dict[str, str] = NOTICES, per_edit: int = CHARACTERS_PER_EDIT):
        import ahocorasick
        import regex

        self.notices, self.automaton = [], ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, label) in enumerate(notices.items()):
            edits = len(notice) // per_edit
            pattern = regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={edits}}}")
            self.notices.append((notice, label, edits, pattern))
            bounds = [round(j * len(notice) / (edits + 1)) for j in range(edits + 2)]
            for a, b in zip(bounds, bounds[1:], strict=False):
                seeds.setdefault(notice[a:b], []).append((i, a))
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of the fuzzy occurrences in a normalised text, in order of place."""
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for i, at in places:
                notice, _, edits, _ = self.notices[i]
                start = last - length + 1 - at
                windows.setdefault(i, []).append((max(0, start - edits), min(len(text), start + len(notice) + edits)))
        found = []
        for i, own in windows.items():
            for a, b in _merged(own):
                every = [(sum(m.fuzzy_counts), m.start(), m.end()) for m in self.notices[i][3].finditer(text, a, b, overlapped=True)]
                found += [(i, start, end, edits) for edits, start, end in _apart(every)]
        return sorted(found, key=lambda f: (f[1], f[0]))


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Windows that overlap, joined, in order: the seeds of one place share a window."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _apart(finds: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (edits, start, end) those that overlap none with fewer edits, or as many and an earlier start."""
    taken: list[tuple[int, int, int]] = []  # in order of place
    for edits, start, end in sorted(set(finds)):
        at = bisect.bisect(taken, start, key=lambda t: t[1])
        if (at == 0 or taken[at - 1][2] <= start) and (at == len(taken) or end <= taken[at][1]):
            taken.insert(at, (edits, start, end))
    return taken


_search: list[NoticeSearch] = []


def search() -> NoticeSearch:
    if not _search:
        _search.append(NoticeSearch())
    return _search[0]


def scan_text(text: bytes) -> dict:
    """Everything about one UTF-8 text: words, base places (word numbers), notices with spans in words and edits."""
    plain = text.translate(_PLAIN)
    mask = np.frombuffer(plain, np.uint8) != 32
    starts = mask.copy()
    starts[1:] &= ~mask[:-1]
    begins = np.flatnonzero(starts)
    places = [(int(np.searchsorted(begins, m.start())), _BASE_LABELS[m.lastindex - 1]) for m in _BASE.finditer(plain)]
    # Spans of the fuzzy search are in words too: positions of the squeezed text map back by counting its spaces.
    squeezed = _SPACES.sub(b" ", plain).strip().decode("utf-8", "replace")
    found = search().find(squeezed)
    spaces = np.flatnonzero(np.frombuffer(squeezed.encode("utf-32-le"), np.uint32) == 32) if found else ()
    before = lambda at: int(np.searchsorted(spaces, at))
    notices = [
        (search().notices[i][1], before(a), before(b), edits, 1 - edits / len(search().notices[i][0])) for i, a, b, edits in found
    ]
    return {"n_words": len(begins), "places": places, "notices": notices}


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "notices array<struct<label:string,first_word:long,last_word:long,edits:int>>"
)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: the digest columns, and `notices` with the label, word span and edits of each find."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notice_type = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])
        for whole in batches:
            for batch in slices(whole, 1):
                out = [scan_text(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
                first = [min((p for p, _ in o["places"]), default=None) for o in out]
                last = [max((p for p, _ in o["places"]), default=None) for o in out]
                base = [{label for _, label in o["places"]} for o in out]
                more = [b | {n[0] for n in o["notices"]} for b, o in zip(base, out, strict=True)]
                score = [1.0 if o["places"] else max((n[4] for n in o["notices"]), default=0.0) for o in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([o["n_words"] for o in out], pa.int64()),
                        pa.array([len(o["places"]) for o in out], pa.int64()),
                        pa.array(first, pa.int64()),
                        pa.array(last, pa.int64()),
                        pa.array([",".join(sorted(b)) for b in base], pa.string()),
                        pa.array([",".join(sorted(m)) for m in more], pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array([[n[:4] for n in o["notices"]] for o in out], pa.list_(notice_type)),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"],
                )

    return df.select(id_col, text_col).mapInArrow(run, f"doc_id {df.schema[id_col].dataType.simpleString()}, {SCHEMA}")
