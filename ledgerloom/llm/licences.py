"""Licence notices found by conditional compression and confirmed word by word."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import slices
from .tables import text_of

#: Common notices by their public short names.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
_BSD_END = "This software is provided by the copyright holders and contributors \"as is\""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
_GNU = """This program is free software{}: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as
published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""


def _gnu(kind: str, short: str, version: str, day: str) -> tuple[str, ...]:
    name = f"GNU {kind}General Public License"
    return (
        _GNU.format("", kind, version), f"{name}, version {version}", f"{name} v{version}", f"{name} Version {version}, {day}",
        f"under the terms of the {name} as published by the Free Software Foundation, version {version}",
        f"under the terms of version {version} of the {name}",
        f"{short} version {version} license", f"{short}v{version} license", f"licensed under {short}-{version}", f"licensed under {short}v{version}",
    )


def _cc(short: str, terms: str) -> tuple[str, ...]:
    return (
        f"licensed under a Creative Commons {terms} 4.0 International License", f"Creative Commons {terms} 4.0", f"CC {short} 4.0",
        f"Creative Commons Attribution {short} 4.0", f"creativecommons.org/licenses/{short.lower()}/4.0",
    )


#: Further wordings, headers and grants of the same licences. A long licence is known by its title and its header.
WORDINGS = {
    "MIT": (_MIT, "MIT License", "Licensed under the MIT License", "Licensed under MIT", "The MIT License (MIT)", "Distributed under the terms of the MIT License",
            "opensource.org/licenses/MIT"),
    "ISC": (_ISC, "ISC License", "Licensed under the ISC License"),
    "Apache-2.0": (_APACHE, "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Licensed under Apache 2.0", "Apache License Version 2.0, January 2004",
                   "Apache Software License 2.0", "apache.org/licenses/LICENSE-2.0"),
    "BSD-2-Clause": (f"{_BSD} {_BSD_END}", "BSD 2-Clause License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": (f"{_BSD} 3. {_BSD_NAMES} {_BSD_END}", "BSD 3-Clause License", "New BSD License", "Modified BSD License", "Revised BSD License", "BSD-style license"),
    "GPL-2.0": _gnu("", "GPL", "2", "June 1991"),
    "GPL-3.0": _gnu("", "GPL", "3", "29 June 2007"),
    "LGPL-2.1": (*_gnu("Lesser ", "LGPL", "2.1", "February 1999"), _GNU.replace("program", "library").format("", "Lesser ", "2.1")),
    "LGPL-3.0": (*_gnu("Lesser ", "LGPL", "3", "29 June 2007"), _GNU.replace("program", "library").format("", "Lesser ", "3")),
    "AGPL-3.0": _gnu("Affero ", "AGPL", "3", "19 November 2007"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Licensed under MPL 2.0", "Mozilla Public License Version 2.0",
                "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License 2.0",
                "Eclipse Public License - v 2.0"),
    "CC-BY-4.0": _cc("BY", "Attribution"),
    "CC-BY-SA-4.0": _cc("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-NC-4.0": _cc("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-ND-4.0": _cc("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _cc("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC0-1.0": ("CC0 1.0 Universal", "dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law",
                "Creative Commons Zero 1.0", "creativecommons.org/publicdomain/zero/1.0"),
    "Unlicense": ("Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose",
                  "released under the Unlicense", "The Unlicense"),
}
#: Notices that grant nothing. They are found like the others and counted apart.
RESERVED = {
    "all-rights-reserved": ("All rights reserved.",),
    "proprietary": ("proprietary and confidential", "Unauthorized copying of this file, via any medium, is strictly prohibited", "This software is proprietary",
                    "may not be copied, reproduced or distributed without the prior written permission of the copyright owner", "proprietary license"),
}
TEMPLATES = {name: (*([NOTICES[name]] if name in NOTICES else []), *WORDINGS.get(name, ())) for name in [*NOTICES, *WORDINGS]}
TEMPLATES = {name: (*said, f"SPDX-License-Identifier: {name}") for name, said in TEMPLATES.items()}
TEMPLATES |= {name: (*TEMPLATES[name], *(f"SPDX-License-Identifier: {name}-{more}" for more in ("only", "or-later"))) for name in TEMPLATES if "GPL" in name}
TEMPLATES |= RESERVED
#: A text around one of these is a candidate.
TRIGGERS = re.compile(
    r"licen[sc]e|public\W+domain|copyright|all\W+rights\W+reserved|creative\W*commons|\bcc\W+by\b|\bcc0\b|free\W+software|proprietary|unauthori[sz]ed\W+copying", re.I)
#: Numbers with their points, or runs of letters and digits; hyphens and other signs part words.
_WORD = re.compile(r"v?\d+(?:\.\d+)+|[^\W_]+", re.I)
#: Words a notice may lack, add or exchange whatever its length, but at most one in three.
SLACK = 2
#: A version number, or a word that tells one licence from another, counts as so many words.
WEIGHT = 3
#: Words that tell licences apart, besides the parts of the licences' names.
TELLING = frozenset("gnu lesser library affero mozilla eclipse attribution noncommercial sharealike noderivatives noderivs commercial derivatives simplified new modified revised not".split())
_PLAIN = frozenset("license licensed public general the of and or a all".split())
_USED = ""


def candidate_blocks(text: str, reach: int, triggers: re.Pattern = TRIGGERS) -> list[tuple[int, int]]:
    """Stretches of ``reach`` words on each side of triggers, across line ends; overlapping or touching ones are one."""
    places = [m.span() for m in triggers.finditer(text)]
    if not places:
        return []
    starts, stops = zip(*(m.span() for m in _WORD.finditer(text)))
    out: list[list[int]] = []
    for a, b in places:
        first = max(0, bisect_right(starts, a) - 1 - reach)
        last = min(len(starts), bisect_left(starts, b) + reach)
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    # signs before the first and after the last word go with the block
    return [(starts[i] if i else 0, starts[j] if j < len(starts) else len(text)) for i, j in out]


def word_key(word: str) -> str:
    """What is compared: lower case, one spelling of licence, 3 for v3 and 3.0."""
    word = word.lower().replace("licence", "license")
    number = re.fullmatch(r"v?(\d+(?:\.\d+)*?)(?:\.0)*", word)
    return number[1] if number else word


def misspelt(a: str, b: str) -> bool:
    """Words of five letters or more, one letter put in, left out, exchanged or swapped with the next."""
    if a == b or min(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 1 or any(c.isdigit() for c in a + b):
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1:] == b[k + 1:] or a[k:] == b[k + 1:] or a[k + 1:] == b[k:] or (a[k:k + 2] == b[k:k + 2][::-1] and a[k + 2:] == b[k + 2:])


def exchange(a: str, b: str, costs: tuple[int, int]) -> int:
    return 1 if max(costs) > 1 and misspelt(a, b) else max(costs)


def fit(notice: list[str], block: list[str], budget: float, weight: Callable[[str], int], begin: int = 0) -> tuple[int, int, set[int], set[int], int] | None:
    """A stretch of ``block`` from ``begin`` on with a difference from ``notice`` of at most ``budget``.

    It is the one with the least difference, and the first of equal ones, among those that can overlap the first found.

    A lacking, an added and an exchanged word count its weight (an exchange the larger of two, a slip of
    one letter in a long word 1). Cells above the budget
    are not followed. Gives the start and the end of the stretch, the positions in notice and block that are equal, and
    from where other stretches can begin.
    """
    n, costs = len(notice), [weight(w) for w in notice]
    span = n + int(budget)
    column, best, end, again = [0.0], budget, -1, begin
    for c in costs:
        if column[-1] + c > budget:
            break
        column.append(column[-1] + c)
    columns = [column]
    for j, w in enumerate(block[begin:] if begin else block):
        if end >= 0 and j >= end + span:
            break
        extra, before = weight(w), columns[-1]
        column = [0.0]
        for i in range(1, n + 1):
            x = column[i - 1] + costs[i - 1]
            if i <= len(before):
                x = min(x, before[i - 1] + (0 if notice[i - 1] == w else exchange(notice[i - 1], w, (costs[i - 1], extra))))
                if i < len(before):
                    x = min(x, before[i] + extra)
            elif x > budget:
                break
            column.append(x)
        while column[-1] > budget:
            column.pop()
        columns.append(column)
        if len(column) > n and (end < 0 or column[n] < best):
            again = again if end >= 0 else max(begin, begin + j + 1 - span)
            best, end = column[n], j + 1
    if end < 0:
        return None
    i, j, here, there = n, end, set(), set()
    at = lambda i, j: columns[j][i] if i < len(columns[j]) else float("inf")
    while i:
        now = columns[j][i]
        if j and notice[i - 1] == block[begin + j - 1] and now == at(i - 1, j - 1):
            i, j = i - 1, j - 1
            here.add(i), there.add(begin + j)
        elif now == at(i - 1, j) + costs[i - 1]:
            i -= 1
        elif now == at(i - 1, j - 1) + exchange(notice[i - 1], block[begin + j - 1], (costs[i - 1], weight(block[begin + j - 1]))):
            i, j = i - 1, j - 1
        else:
            j -= 1
    return (min(there), max(there) + 1, here, there, again) if there else None


class Matcher:
    """Rank notices for a block by how much shorter it gets once a notice is the compressor's dictionary."""

    def __init__(self, notices: Mapping[str, str | Sequence[str]], level: int = 3) -> None:
        import zstandard as z

        notices = {(name, k): t for name, said in notices.items() for k, t in enumerate([said] if isinstance(said, str) else said)}
        self.plain = z.ZstdCompressor(level=level)
        self.words = {name: self.split(notice) for name, notice in notices.items()}
        self.keys = {name: [word_key(w) for w in words] for name, words in self.words.items()}
        self.given = {}
        for name, keys in self.keys.items():
            held = z.ZstdCompressionDict(" ".join(keys).encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
            self.given[name] = z.ZstdCompressor(level=level, dict_data=held)
        self.telling = TELLING | {word_key(w) for name, _ in notices for w in self.split(name)} - _PLAIN
        self.need = {name: {w: 1 if misspelt(w, w + w[-1]) else self.weight(w) for w in keys} for name, keys in self.keys.items()}

    def reach(self, tolerance: float) -> int:
        """Words of the longest stretch that can be confirmed."""
        return max((len(keys) + int(self.budget(name, tolerance)) for name, keys in self.keys.items()), default=0)

    def triggers(self, tolerance: float) -> re.Pattern:
        """``TRIGGERS``; a notice without one adds so many of its longest words that a confirmed one has one of them."""
        own = {w for name, words in self.words.items() if not TRIGGERS.search(" ".join(words))
               for w in sorted(set(words), key=lambda w: (-len(w), w))[:int(self.budget(name, tolerance)) + 1]}
        return re.compile("|".join([TRIGGERS.pattern, *(rf"\b{re.escape(w)}\b" for w in sorted(own))]), re.I)

    @staticmethod
    def split(text: str) -> list[str]:
        return [w.lower() for w in _WORD.findall(text)]

    def weight(self, key: str) -> int:
        return WEIGHT if key in self.telling or key == _USED or any(c.isdigit() for c in key) else 1

    def budget(self, name: tuple[str, int], tolerance: float) -> float:
        n = len(self.keys[name])
        return max(tolerance * n, min(SLACK, n // 3))

    def gain(self, keys: list[str], name: tuple[str, int]) -> float:
        raw = " ".join(keys).encode()
        return 1 - len(self.given[name].compress(raw)) / len(self.plain.compress(raw))

    def ranked(self, keys: list[str], tolerance: float) -> list[tuple[float, tuple[str, int]]]:
        """The notices that do not lack too many of their words in the whole block, best gain first."""
        own = set(keys)
        able = [name for name, need in self.need.items() if keys and sum(c for w, c in need.items() if w not in own) <= self.budget(name, tolerance)]
        return sorted(((self.gain(keys, name), name) for name in able), key=lambda x: (-x[0], x[1]))

    def confirmed(self, block: str, tries: int, tolerance: float) -> Iterator[tuple[int, int, str, float, list[str], list[str]]]:
        """Notices of a block, best reduction first, with their place. Words once used confirm no second notice."""
        spans = [m.span() for m in _WORD.finditer(block)]
        words = [block[a:b].lower() for a, b in spans]
        keys = [word_key(w) for w in words]
        ranked = self.ranked(keys, tolerance)
        for _, name in ranked[:tries] if tries else ranked:
            begin = 0
            while hit := fit(self.keys[name], keys, self.budget(name, tolerance), self.weight, begin):
                start, stop, here, there, begin = hit
                missing = [w for k, w in enumerate(self.words[name]) if k not in here]
                extra = [words[k] for k in range(start, stop) if k not in there]
                signs = re.compile(r"[.!?)\"']*").match(block, spans[stop - 1][1]).end()
                yield spans[start][0], signs, name[0], self.gain(keys[start:stop], name), missing, extra
                for k in there:
                    keys[k] = _USED


FOUND = "array<struct<start:int,stop:int,licence:string,reduction:double,missing:array<string>,extra:array<string>>>"


def find_licences(
    docs: DataFrame, notices: Mapping[str, str | Sequence[str]] = TEMPLATES, tries: int = 0, tolerance: float = 0.05, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``n_candidates`` (blocks around a licence word) and ``found``, the confirmed notices.

    A block has on each side of a licence word as many words as the longest notice, across line ends; white space and
    signs, those of comments too, do not count. Every candidate block is compressed alone and with each notice as a raw zstandard dictionary. The notices are tried in
    the order of the size reduction (the best ``tries``; 0: all), and the first to be confirmed has the words. One is
    confirmed if the words that the block lacks, adds or exchanges are at most ``tolerance`` of its words, or two
    (``SLACK``) and no more than a third of them; version numbers and words that tell licences apart count as three words
    (``WEIGHT``). The differences are reported. A block can hold several notices, and one more than once. ``reduction``
    is that of the stretch that holds the notice, from ``start`` to ``stop``.

    One pass over the rows without shuffle. Null and empty texts have no blocks; texts are searched whole; equal
    reductions are ordered by name; repeated rows and null ids get results of their own; no rows give no rows. Other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    notices = dict(notices)
    found_type = pa.list_(pa.struct([
        ("start", pa.int32()), ("stop", pa.int32()), ("licence", pa.string()), ("reduction", pa.float64()),
        ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(notices)
        reach, triggers = matcher.reach(tolerance), matcher.triggers(tolerance)
        for batch in slices(batches, 1):
            counts, found = [], []
            for text in batch.column(1).to_pylist():
                blocks = candidate_blocks(text, reach, triggers)
                counts.append(len(blocks))
                found.append([
                    {"start": a + start, "stop": a + stop, "licence": name, "reduction": r, "missing": missing, "extra": extra}
                    for a, b in blocks for start, stop, name, r, missing, extra in matcher.confirmed(text[a:b], tries, tolerance)])
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, found_type)], ["doc_id", "n_candidates", "found"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_candidates bigint, found {FOUND}")


def licence_report(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id``, ``n_candidates``, ``n_licences`` (different ones), ``licences`` (their names, comma-joined) and
    ``reserved``, the names of the notices that grant nothing (``RESERVED``); these are not among the licences."""
    names = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["licence"])))
    found = find_licences(docs, **options).select("doc_id", "n_candidates", names.alias("names"))
    kept = F.array([F.lit(n) for n in RESERVED])
    granted, reserved = F.array_except("names", kept), F.array_intersect("names", kept)
    return found.select("doc_id", "n_candidates", F.size(granted).cast("long").alias("n_licences"), F.array_join(granted, ",").alias("licences"),
                        F.array_join(reserved, ",").alias("reserved"))
