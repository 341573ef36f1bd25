"""License scans by conditional compression.

Blocks of text around license words are compressed with every license's wordings as raw zstandard dictionary.
Most licenses have nothing to do with a block, so the median of the bytes saved is what unrelated wordings save;
licenses that save more are candidates, largest reduction first, and confirmed if the wording differs in few words and
names the license exactly.  What is confirmed is blanked and the block compressed again, until no candidate is
confirmed: in a list of many licenses the rest then stand out.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from mailtriage.llm.common import column_of, documents, text_groups, texts_of

# Names of licenses as notices give them.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "EPL-2.0"),
    "Zlib": ("zlib License", "Zlib"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "BSL-1.0"),
    "OFL-1.1": ("SIL Open Font License, Version 1.1", "OFL-1.1"),
    "WTFPL": ("WTFPL",),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0 Universal", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}
# Sentences that grant a named license.
FORMS = (
    "Licensed under {}", "Licensed under the {}", "Released under the {}", "Released under {}", "Distributed under the {}",
    "This work is licensed under the {}", "This work is licensed under a {}", "Available under the terms of the {}",
    "Subject to the terms of the {}", "SPDX-License-Identifier: {}",
)
_GNU = (
    "This {} is free software; you can redistribute it and/or modify it under the terms of the {} as published by the Free "
    "Software Foundation; either version {} of the License, or (at your option) any later version."
)
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met"
)
_BSD_TWO = _BSD_OPENING + (
    ": Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    " The name of the author may not be used to endorse or promote products derived from this software without specific "
    "prior written permission.",
)
_BSD_ADVERTS = (
    " All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the organization."
)
# Notices that have a wording of their own.
NOTICES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD": (_BSD_OPENING,),  # which of them is not said
    "BSD-2-Clause": (_BSD_TWO + " THIS SOFTWARE IS PROVIDED",),
    "BSD-3-Clause": tuple(_BSD_TWO + clause for clause in _BSD_NAMES),
    "BSD-4-Clause": tuple(_BSD_TWO + _BSD_ADVERTS + clause for clause in _BSD_NAMES),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "GPL-2.0": (_GNU.format("program", "GNU General Public License", "2"),),
    "GPL-3.0": (_GNU.format("program", "GNU General Public License", "3"),),
    "LGPL-2.1": (_GNU.format("library", "GNU Lesser General Public License", "2.1"),),
    "LGPL-3.0": (_GNU.format("library", "GNU Lesser General Public License", "3"),),
    "AGPL-3.0": (_GNU.format("program", "GNU Affero General Public License", "3"),),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which "
        "accompanies this distribution",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
        "is furnished to do so, all subject to the following",
    ),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "all-rights-reserved": ("All rights reserved.",),
}
# Words of a notice that must stay, each group next to each other; one of the alternatives, if there are some.
KEPT = {
    "Apache-2.0": (("Apache License Version 2.0",),),
    "BSD-2-Clause": (("provided with the distribution THIS SOFTWARE IS PROVIDED",),),
    "BSD-3-Clause": (("endorse or promote products",),),
    "BSD-4-Clause": (("advertising materials",), ("endorse or promote products",)),
    "GPL-2.0": (("GNU General Public License",), ("version 2", "version 2.0")),
    "GPL-3.0": (("GNU General Public License",), ("version 3", "version 3.0")),
    "LGPL-2.1": (("GNU Lesser General Public License",), ("version 2.1",)),
    "LGPL-3.0": (("GNU Lesser General Public License",), ("version 3", "version 3.0")),
    "AGPL-3.0": (("GNU Affero General Public License",), ("version 3", "version 3.0")),
    "MPL-2.0": (("Mozilla Public License",), ("2.0",)),
    "OFL-1.1": (("SIL Open Font License",), ("1.1",)),
    "EPL-2.0": (("Eclipse Public License 2.0", "Eclipse Public License v 2.0", "Eclipse Public License v2.0",
                 "Eclipse Public License version 2.0"),),
}
CUES = re.compile(r"licen[sc]|copyright|rights reserved|permission|redistribut|public domain|spdx|\bcc[ -]by\b|\bcc0\b"
                  r"|(?:released|distributed) under|under the terms of|subject to the terms of", re.I)
# What one of the cues contains, in lower case: a text without any is done.
HINTS = ("licens", "licenc", "copyright", "rights reserved", "permission", "redistribut", "public domain", "spdx", "cc by", "cc-by", "cc0",
         "released under", "distributed under", "the terms of")
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*", re.I)

#: Characters before and after a license word: a sentence that names a license, and a whole notice.
SCALES = ((80, 120), (700, 1600))
#: Characters of a block and of what neighbouring blocks share, for each scale: the longest wording fits into the overlap.
BLOCKS = ((320, 160), (4000, 1600))
SLACK = 0.12
LEVEL = 9
MARK = "0"  # a word in the place of what was confirmed, so that its neighbours do not meet
OUT = ("doc_id long, license string, start long, length long, saved long, n_differences long, "
       "differences array<string>, wording string")


def tokens(text: str) -> list[str]:
    return [m.group().lower() for m in WORD.finditer(text)]


@dataclass
class Wording:
    text: str
    words: list[str]
    name: list[list[list[str]]]  # words that must occur unchanged: of each entry one run, next to each other


def wordings() -> dict[str, list[Wording]]:
    """All wordings of every license: its notices, and every form with every name."""
    out: dict[str, list[Wording]] = {}
    for license_id, notices in NOTICES.items():
        kept = [[tokens(run) for run in runs] for runs in KEPT.get(license_id, ())]
        out.setdefault(license_id, []).extend(Wording(t, tokens(t), kept) for t in notices)
    for license_id, names in NAMES.items():
        for name in names:
            out.setdefault(license_id, []).extend(Wording(t, tokens(t), [[tokens(name)]]) for t in (form.format(name) for form in FORMS))
    return out


class Scanner:
    """Compressors and wordings, made once in each task."""

    def __init__(self, given: dict[str, list[Wording]] | None = None):
        self.wordings = given or wordings()
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.with_dict = {}
        for license_id, own in self.wordings.items():
            data = "\n".join(w.text for w in own).encode()
            held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.with_dict[license_id] = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False)

    def candidates(self, block: str) -> list[tuple[int, str]]:
        """(bytes saved, license), largest first, of the licenses that save more than unrelated ones do."""
        data = block.encode("utf-8", "replace")
        size = len(self.plain.compress(data))
        saved = {i: size - len(c.compress(data)) for i, c in self.with_dict.items()}
        unrelated = sorted(saved.values())[(len(saved) - 1) // 2]
        return sorted(((n, i) for i, n in saved.items() if n > max(unrelated, 0)), key=lambda s: (-s[0], s[1]))

    def confirmed(self, block: str) -> list[tuple]:
        """(start, end, license, saved, differences, wording) of the wordings that stand in the block.

        Every round blanks some words, so there are at most as many rounds as wordings in the block.
        """
        found: list[tuple] = []
        while fresh := self._round(block):
            found += fresh
            for start, end, *_ in fresh:
                block = f"{block[:start]}{MARK}{' ' * (end - start - len(MARK))}{block[end:]}"
        return _apart(found)

    def _round(self, block: str) -> list[tuple]:
        spans = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(block)]
        words, found = [s[0] for s in spans], []
        held = set(words)
        for saved, license_id in self.candidates(block):
            for wording in self.wordings[license_id]:
                allowed = int(SLACK * len(wording.words))
                if len(set(wording.words) - held) > allowed or not all(any(set(run) <= held for run in runs) for runs in wording.name):
                    continue
                for a, b, changes in aligned(wording.words, words, allowed):
                    if all(any(_within(run, words[a:b]) for run in runs) for runs in wording.name):
                        found.append((spans[a][1], spans[b - 1][2], license_id, saved, changes, wording.text))
        return _apart(found)

    def scan(self, text: str) -> list[tuple]:
        found, low = [], text.lower()
        if not any(hint in low for hint in HINTS):
            return found
        for before, after in SCALES:
            for start, end in blocks_of(text, before, after):
                found += [(start + a, start + b, *rest) for a, b, *rest in self.confirmed(text[start:end])]
        return _apart(found)


def _within(name: list[str], words: list[str]) -> bool:
    return any(words[i : i + len(name)] == name for i in range(len(words) - len(name) + 1))


def _apart(found: list[tuple]) -> list[tuple]:
    """Findings that do not overlap: longest wording first, then fewest differences."""
    kept: list[tuple] = []
    unique = set((*x[:4], tuple(x[4]), x[5]) for x in found)
    for f in sorted(unique, key=lambda x: (-len(x[5].split()) + 2 * len(x[4]), len(x[4]), x[0], x[2], -x[3], x[5])):
        at = bisect.bisect(kept, f[0], key=lambda k: k[0])
        if (not at or kept[at - 1][1] <= f[0]) and (at == len(kept) or f[1] <= kept[at][0]):
            kept.insert(at, f)
    return kept


def aligned(wording: list[str], words: list[str], allowed: int) -> list[tuple[int, int, list[str]]]:
    """(start, end, differences) of stretches of ``words`` within ``allowed`` word edits of ``wording``.

    The table is filled a row of the wording at a time; a stretch may begin anywhere.  Ends are taken where
    the number of edits is least among overlapping stretches.
    """
    n, m = len(wording), len(words)
    if not n or not m:
        return []
    number = {w: k for k, w in enumerate(dict.fromkeys([*wording, *words]))}
    given = np.array([number[w] for w in words])
    table = np.zeros((n + 1, m + 1), np.int32)
    steps = np.arange(m + 1)
    for i, word in enumerate(wording, 1):
        row = np.empty(m + 1, np.int32)
        row[0] = i
        row[1:] = np.minimum(table[i - 1, :-1] + (given != number[word]), table[i - 1, 1:] + 1)
        table[i] = np.minimum.accumulate(row - steps) + steps
    out, taken = [], 0
    ends = [e for e in np.flatnonzero(table[n] <= allowed).tolist() if e]
    for end in sorted(ends, key=lambda e: (table[n, e], e)):
        start, changes = _traced(table, wording, words, end)
        if start < end and all(end <= a or b <= start for a, b, _ in out):
            out.append((start, end, changes))
            taken += 1
    return sorted(out)


def _traced(table: np.ndarray, wording: list[str], words: list[str], j: int) -> tuple[int, list[str]]:
    i, changes = len(wording), []
    while i:
        if j and table[i, j] == table[i - 1, j - 1] + (wording[i - 1] != words[j - 1]):
            if wording[i - 1] != words[j - 1]:
                changes.append(f"{wording[i - 1]} > {words[j - 1]}")
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + 1:
            changes.append(f"- {wording[i - 1]}")
            i -= 1
        else:
            changes.append(f"+ {words[j - 1]}")
            j -= 1
    return j, changes[::-1]


def blocks_of(text: str, before: int, after: int) -> list[tuple[int, int]]:
    """Stretches of ``before`` characters before and ``after`` behind each license word, short ones no further than
    the next blank line (clauses of a notice stand apart); stretches that meet are joined and cut into overlapping blocks."""
    size, shared = BLOCKS[after >= SCALES[-1][1]]
    joined: list[list[int]] = []
    for m in CUES.finditer(text):
        low, high = max(0, m.start() - before), min(len(text), m.end() + after)
        if after < SCALES[-1][1]:
            low = max(low, text.rfind("\n\n", low, m.start()) + 1)
            gap = text.find("\n\n", m.end(), high)
            high = high if gap < 0 else gap
        if joined and low <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    out = []
    for low, high in joined:
        out += [(at, min(high, at + size)) for at in range(low, max(low + 1, high - shared), size - shared)]
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every confirmed license wording: doc_id, license, start and length (code points), saved (bytes
    by compression), n_differences, differences (word edits) and the wording.

    Whole texts, row-local.  Null and empty texts, texts without a license word and an empty table give no
    rows; repeated rows are scanned once each, null ids stay null.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in text_groups(batches):
            rows = [(doc_id, f[2], f[0], f[1] - f[0], f[3], len(f[4]), list(f[4]), f[5])
                    for doc_id, text in zip(column_of(batch, "doc_id").to_pylist(), texts_of(batch)) for f in scanner.scan(text)]
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string()]
                names = ["doc_id", "license", "start", "length", "saved", "n_differences", "differences", "wording"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return documents(docs, id_col, text_col).mapInArrow(run, OUT)
