"""License notices found by conditional compression.

Words that notices use are cues. Each template is laid on each cue by its own cue
words, which gives a candidate block. A template is a raw zstandard dictionary:
the block is compressed with and without it, and templates are ranked by the bytes
that they save, so a long notice comes before the short one that it holds. The
first of them that is confirmed is the notice: by the exact differences in
wording, the smallest set of words to replace, drop or add that turns the template
into a part of the block.

Null reads as the empty text, which has no notices. Rows that repeat are scanned
alike, each on its own.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sluice.llm.work import making_room, ship

# Notices of common licenses, several wordings each. A name is that of the license, and of the wording if it has more than one.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-header": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-short": "Licensed under the Apache 2.0 License.",
    "Apache-2.0-distributed": "Distributed under the terms of the Apache License, Version 2.0.",
    "Apache-2.0-released": "Released under the Apache License 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-2-Clause-released": "Released under the BSD 2-Clause License.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-3-Clause-released": "Released under the BSD 3-Clause License.",
    "BSD-3-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "BSD-3-Clause-distributed": "Distributed under the terms of the BSD 3-Clause License.",
    "BSD-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-name": "licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-name": "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-SA-4.0-name": "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-name": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "CC0 1.0 Universal Public Domain Dedication",
    "CC0-1.0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-name": "licensed under the GNU General Public License v2",
    "GPL-2.0-short": "Licensed under GPL-2.0",
    "GPL-2.0-header": "it under the terms of the GNU General Public License as published by the Free Software Foundation; "
    "either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-name": "licensed under the GNU General Public License v3",
    "GPL-3.0-name-point": "licensed under the GNU General Public License v3.0",
    "GPL-3.0-short": "Licensed under GPL-3.0",
    "GPL-3.0-short-v": "Licensed under the GPL v3",
    "GPL-3.0-header": "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.",
    "GPL-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "ISC": "Licensed under the ISC License.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-header": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
    "either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-header": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
    "either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-distributed": "Distributed under the terms of the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the Software), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-licensed": "Licensed under the Mozilla Public License 2.0.",
    "Public-domain": "This work is in the public domain.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Licenses that are named by their identifier alone.
IDENTIFIERS = """
AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense
""".split()
TEMPLATES |= {f"{x}-identifier": f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS}

#: Words that one of these matches point at a notice, also where a line ends inside of them.
CUE = r"(?i)licen[cs]|copyright|hereby|public\W+domain|cc0|unencumbered|redistribution"
WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
#: Words of names and versions: a notice that lacks one of its template's is of another license, and so is one with another of the second kind.
NAMED = frozenset(
    "agpl affero apache attribution bsd by cc cc0 clause commons creative dedication domain gnu gpl isc lesser lgpl library mit mozilla mpl nc nd "
    "noncommercial noderivatives public sa sharealike spdx style universal unencumbered unlicense".split()
)
FOREIGN = NAMED - frozenset("by clause creative domain public spdx style".split())
#: A number that counts the parts of a text, not a version.
PART = re.compile(r"[:.;] (\d+)\. ")


@dataclass(frozen=True)
class Scan:
    """`gain` is the least share of a block's size that its template saves.

    `differ` is the most words that may differ, as a share of the template's,
    but one may in any template and two in one of `short` words or more: one
    that is replaced counts twice. Names and versions may not.
    """

    templates: Mapping[str, str] = field(default_factory=lambda: TEMPLATES)
    cue: str = CUE
    gain: float = 0.1
    differ: float = 0.1
    short: int = 6
    level: int = 9

    def allowed(self, n: int) -> int:
        return max(int(self.differ * n), 2 if n >= self.short else 1)


def spelled(word: str) -> str:
    """A word in the spelling that is compared: lower case, `licence` as `license`, `v2.0` as `2.0`."""
    word = word.lower()
    if word.startswith("licenc"):
        return "licens" + word[6:]
    return word[1:] if len(word) > 1 and word[0] == "v" and word[1].isdigit() else word


def words(text: str) -> list[tuple[str, int, int]]:
    """Words as compared, with their places."""
    return [(spelled(m.group()), m.start(), m.end()) for m in WORD.finditer(text)]


def wording(template: list[str], block: list[str], fixed: Collection[str] = ()) -> tuple[int, int, list[str]]:
    """First and last word (exclusive) of the part of `block` nearest to the template, and the differences.

    Differences are `-word` for a word of the template that is missing and
    `+word` for one that is not in it. Of equally near parts the first is taken.
    A `fixed` word that is missing counts three times.
    """
    n, m = len(template), len(block)
    cost, lack = [[0] * (m + 1)], [3 if w in fixed else 1 for w in template]
    for i in range(1, n + 1):
        above, drop = cost[-1], lack[i - 1]
        row = [above[0] + drop]
        for j in range(1, m + 1):
            same = template[i - 1] == block[j - 1]
            row.append(min(above[j - 1] + (0 if same else drop + 1), above[j] + drop, row[j - 1] + 1))
        cost.append(row)
    end = j = min(range(m + 1), key=lambda x: (cost[n][x], x))
    i, out = n, []
    while i:
        same = j > 0 and template[i - 1] == block[j - 1]
        if j and same and cost[i][j] == cost[i - 1][j - 1]:
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + lack[i - 1]:
            out.append("-" + template[i - 1])
            i -= 1
        else:
            out.append("+" + block[j - 1])
            j -= 1
    return j, end, out[::-1]


class Template:
    def __init__(self, name: str, text: str, how: Scan, cue: re.Pattern):
        import zstandard

        placed = words(text)
        self.name, self.words = name, [w for w, _, _ in placed]
        self.allowed = how.allowed(len(self.words))
        starts = [s for _, s, _ in placed]
        self.cues = sorted({bisect_right(starts, m.start()) - 1 for m in cue.finditer(text)})
        self.counts = Counter(self.words)
        self.fixed = {w for w in self.words if w in NAMED or w[0].isdigit()} - set(PART.findall(text))
        given = zstandard.ZstdCompressionDict(" ".join(self.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.coder = zstandard.ZstdCompressor(level=how.level, dict_data=given, write_content_size=False, write_dict_id=False)

    def may_be_in(self, block: list[str]) -> bool:
        """Whether a block has enough of the words: as many as lack are differences at least."""
        have, missing = Counter(block), 0
        for word, n in self.counts.items():
            missing += max(0, n - have[word])
            if missing > self.allowed:
                return False
        return True

    def accepts(self, differences: list[str]) -> bool:
        if len(differences) > self.allowed:
            return False
        return not any(d[1:] in (self.fixed if d[0] == "-" else FOREIGN) for d in differences)


class Matcher:
    def __init__(self, how: Scan):
        import zstandard

        self.how, self.cue = how, re.compile(how.cue)
        self.plain = zstandard.ZstdCompressor(level=how.level, write_content_size=False)
        self.templates = [Template(name, text, how, self.cue) for name, text in sorted(how.templates.items())]

    def saved(self, template: Template, block: list[str]) -> tuple[int, float]:
        """The bytes of a compressed block that a template saves, and their share."""
        data = " ".join(block).encode()
        plain = len(self.plain.compress(data))
        less = plain - len(template.coder.compress(data))
        return less, less / plain

    def find(self, text: str) -> list[tuple[str, int, int, str]]:
        """(name, start, end, differences) of the notices of a text, in its order; places are code points, notices do not overlap.

        A template's cue words are laid on each cue of the text, so its block
        begins as many words before the cue as the template does, wherever
        lines end, but not inside the notice before it.
        """
        placed = words(text)
        flat, starts = [w for w, _, _ in placed], [s for _, s, _ in placed]
        known = set(flat)
        able = [t for t in self.templates if t.fixed <= known]
        found, done, first = [], 0, 0
        for cue in self.cue.finditer(text) if able else ():
            if cue.start() < done:
                continue
            hit = self.confirmed(flat, able, bisect_right(starts, cue.start()) - 1, first)
            if hit:
                name, i, j, differences = hit
                found.append((name, placed[i][1], placed[j - 1][2], " ".join(differences)))
                first, done = j, placed[j - 1][2]
        return found

    def confirmed(self, flat: list[str], able: list[Template], at: int, first: int) -> tuple[str, int, int, list[str]] | None:
        """The notice about the word `at`: of the templates ranked by what they save, the first whose wording is confirmed.

        Blocks that lack more words than a template may differ by are not
        compressed: its wording could not be confirmed. Of templates that save
        equally much, one with fewer differences comes first, then by name.
        """
        ranked = []
        for template in able:
            for cue in template.cues:
                low = max(first, at - cue - template.allowed)
                block = flat[low : max(low, at - cue + len(template.words) + template.allowed)]
                if template.may_be_in(block):
                    less, share = self.saved(template, block)
                    if share >= self.how.gain:
                        ranked.append((-less, template.name, low, block, template))
        ranked.sort(key=lambda x: x[:3])
        for less, group in groupby(ranked, key=lambda x: x[0]):
            confirmed = []
            for _, name, low, block, template in group:
                i, j, differences = wording(template.words, block, template.fixed)
                if j > i and template.accepts(differences):
                    confirmed.append((len(differences), name, low + i, low + j, differences))
            if confirmed:
                return min(confirmed)[1:]
        return None


def scanned(docs: DataFrame, how: Scan = Scan(), text: str = "text", out: str = "licenses") -> DataFrame:
    """`docs` with an array column `out` of struct(name, start, end, differences). Texts without a cue never leave the JVM.

    A column of `docs` named as `out` is kept with `_` behind its name.
    """
    ship(docs.sparkSession)
    docs = making_room(docs, out)
    item = pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("differences", pa.string())])

    def run(column: pa.Array) -> pa.Array:
        matcher = Matcher(how)
        rows = [[] if x is None else matcher.find(x) for x in column.to_pylist()]
        return pa.array([[dict(zip(("name", "start", "end", "differences"), hit, strict=True)) for hit in row] for row in rows], pa.list_(item))

    cued = F.when(F.col(text).rlike(how.cue), F.col(text))
    return docs.withColumn(out, arrow_udf(run, "array<struct<name:string,start:bigint,end:bigint,differences:string>>")(cued))
