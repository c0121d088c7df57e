"""License scans by patience alignment.

For each template, windows of a text around its telling words are aligned with it: words that occur once in the window and
once in the template are anchors; their longest increasing subsequence is kept; the gaps between anchors, and what touches
them, are aligned in the same way. Coverage is the number of aligned words over the template's words or the words of the
text that the alignment spans, whichever are more, so left-out and inserted words both cost. A run of aligned words counts
only if it has the words by which a license is told from its relatives (name, version, ShareAlike) and spans none that name
a relative.

Telling words are the rarest of those demanded, or, without any, so many of the template's words that no covered window can
lack them all. Every window that holds one and might be covered better is tried; their length is bounded by the template's, so a long text costs in
proportion to its length.

Defined cases: null and empty texts have no license; equal coverages go to the longer template, then the first by name;
repeated rows are scanned each; an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import map_pandas, own

WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
MIN_COVERAGE = 0.75
VERSION = re.compile(r"^v(?=[0-9])|(?:\.0)+$")

# Notices by which the licenses ask to be named, as their publishers word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License.",
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_CC = "noncommercial nc non commercial noderivatives noderivs nd derivatives"
#: Words that a license's notice must have, and words that must not be in it, as they name a relative.
DISTINCT = {
    "Apache-2.0": ("apache 2", ""),
    "Apache-2.0-notice": ("apache 2", ""),
    "BSD": ("redistribution binary", ""),
    "CC-BY-4.0": ("creative commons attribution 4", f"{_CC} sharealike sa share alike"),
    "CC-BY-NC-4.0": ("cc by nc 4", "nd sa noderivatives sharealike"),
    "CC-BY-SA-4.0": ("creative commons attribution sharealike 4", _CC),
    "GPL-3.0": ("gnu general public 3", "lesser affero library"),
    "GPL-3.0-notice": ("gnu general public 3", "lesser affero library"),
    "ISC": ("permission distribute with without fee", ""),
    "MIT": ("mit", ""),
    "MIT-grant": ("permission person obtaining", ""),
    "MPL-2.0": ("mozilla 2", ""),
}


def words_of(text: str) -> list[str]:
    """Lower-cased words; v2.0 and 2.0 are 2."""
    return [VERSION.sub("", w) if w[-1].isdigit() else w for w in WORD.findall(text.lower())]


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs, sorted by the first, whose seconds increase (patience piles)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back.append(at[p - 1] if p else -1)
        tops[p : p + 1] = [j]
        at[p : p + 1] = [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Aligned positions of a[a0:a1] and b[b0:b1]."""
    head, tail = [], []
    while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
        head.append((a0, b0))
        a0, b0 = a0 + 1, b0 + 1
    while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
        a1, b1 = a1 - 1, b1 - 1
        tail.append((a1, b1))
    middle: list[tuple[int, int]] = []
    if a0 < a1 and b0 < b1:
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if nb[b[j]] == 1}
        anchors = rising([(i, place[a[i]]) for i in range(a0, a1) if na[a[i]] == 1 and a[i] in place])
        if anchors:
            i0, j0 = a0, b0
            for i, j in [*anchors, (a1, b1)]:
                middle += align(a, b, i0, i, j0, j)
                if i < a1:
                    middle.append((i, j))
                i0, j0 = i + 1, j + 1
    return head + middle + tail[::-1]


class Template:
    def __init__(self, name: str, text: str) -> None:
        self.words = words_of(text)
        self.size = len(self.words)
        demanded, barred = DISTINCT.get(name, ("", "")) if TEMPLATES.get(name) == text else ("", "")
        self.demanded, self.barred = frozenset(demanded.split()), frozenset(barred.split())
        self.count = Counter(self.words)
        self.least = math.ceil(MIN_COVERAGE * self.size)
        self.reach = math.floor(self.size / MIN_COVERAGE)

    def telling(self, often: Counter) -> set[str]:
        """Words of which a covered window has at least one."""
        rank = lambda w: (-min(len(w), 5), often[w], -len(w), w)
        if self.demanded:
            return {min(self.demanded, key=rank)}
        return set(sorted(self.words, key=rank)[: self.size - self.least + 1])

    def run(self, words: list[str], got: list[tuple[int, int]]) -> tuple[float, int, int]:
        """(coverage, first word, end) of the best run of aligned words."""
        best = (0.0, 0, 0)
        for i in range(len(got) - self.least + 1):
            for j in range(i + self.least, len(got) + 1):
                lo, hi = got[i][0], got[j - 1][0] + 1
                c = (j - i) / max(self.size, hi - lo)
                if c > best[0] and self.demanded.issubset(words[k] for k, _ in got[i:j]) and self.barred.isdisjoint(words[lo:hi]):
                    best = (c, lo, hi)
        return best


class Scanner:
    def __init__(self, templates: dict[str, str]) -> None:
        self.templates = {k: t for k in sorted(templates) if (t := Template(k, templates[k])).size}
        often = Counter(w for t in self.templates.values() for w in t.count)
        self.telling: dict[str, list[str]] = {}
        for k, t in self.templates.items():
            for w in t.telling(often):
                self.telling.setdefault(w, []).append(k)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, end) of the best place of each template that is covered enough."""
        low = (text or "").lower()
        if not any(w in low for w in self.telling):
            return []
        words = words_of(low)
        starts: dict[str, dict[int, None]] = {}
        for i, w in enumerate(words):
            for k in self.telling.get(w, ()):
                t = self.templates[k]
                # a run starts with a word of the template
                starts.setdefault(k, {}).update((a, None) for a in range(max(0, i - t.reach + 1), i + 1) if words[a] in t.count)
        out = []
        for k in sorted(starts):
            t, best = self.templates[k], (0.0, 0, 0)
            for a in starts[k]:
                if best[0] == 1:
                    break
                left, common = t.count.copy(), 0
                for z in range(a + 1, min(len(words), a + t.reach) + 1):
                    if (w := words[z - 1]) not in t.count:
                        continue
                    common += left[w] > 0
                    left[w] -= 1
                    # no more words than these can be aligned
                    if common >= t.least and common / max(t.size, z - a) > best[0]:
                        best = max(best, t.run(words, align(words, t.words, a, z, 0, t.size)), key=lambda x: x[0])
            if best[0] >= MIN_COVERAGE:
                out.append((k, *best))
        return out

    def best(self, found: list[tuple[str, float, int, int]]) -> tuple:
        return max(found, key=lambda x: (x[1], self.templates[x[0]].size), default=(None, None, None, None))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_licenses, licenses, best_license, best_coverage, start_word, end_word."""
    docs = own(docs, id_col, text_col)
    scanner = Scanner(templates or TEMPLATES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text in pdf.text:
                found = scanner.scan(text)
                out.append((len(found), ",".join(x[0] for x in found), *scanner.best(found)))
            cols = pd.DataFrame(out, columns=["n_licenses", "licenses", "best_license", "best_coverage", "start_word", "end_word"])
            cols = cols.astype({"start_word": "Int64", "end_word": "Int64"})
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), cols], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_pandas(docs, run, f"doc_id {kind}, n_licenses long, licenses string, best_license string, best_coverage double, start_word long, end_word long")
