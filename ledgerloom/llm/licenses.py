"""Licence recognition by sentence rules.

Texts are cut into sentences; a normalised sentence that is known gets its identifier, and the sequence of identifiers found in a
text is matched against ordered licence rules, the first rule that fits at a place winning. A sentence may be wrapped over any
number of lines, and may hold slots for what differs between projects, such as the name of a holder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import small_batches

# Known sentences by identifier (fixed values: phrases of public licence notices). Case, punctuation and spacing do not matter; ... is a slot.
SENTENCES = {
    "mit-short": ("Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License", "This software is released under the MIT License"),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
    ),
    "mit-notice": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",),
    "as-is": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ),
    "apache-short": (
        "Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "This project is licensed under the Apache License 2.0", "Released under the Apache License, Version 2.0",
    ),
    "apache-comply": ("you may not use this file except in compliance with the License", "you may not use this work except in compliance with the License"),
    "apache-copy": ("You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "apache-basis": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution",
    ),
    "bsd-advertising": (
        "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product "
        "includes software developed by ...",
    ),
    "bsd-name": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission",
        "Neither the name of ... nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        "Neither the name of ... nor the names of other contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        "The name of ... may not be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "gpl3-short": (
        "This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
        "This program is licensed under the GNU General Public License v3.0",
    ),
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "gpl2-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    ),
    "gpl2-only": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 "
        "as published by the Free Software Foundation",
    ),
    "lgpl21-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    ),
    "lgpl3-free": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "agpl3-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    ),
    "gpl-details": ("See the GNU General Public License for more details",),
    "lgpl-details": ("See the GNU Lesser General Public License for more details",),
    "agpl-details": ("See the GNU Affero General Public License for more details",),
    "mpl-subject": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "mpl-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    ),
    "epl2": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    "bsl": ("Distributed under the Boost Software License, Version 1.0", "Use, modification and distribution are subject to the Boost Software License, Version 1.0"),
    "zlib-as-is": ("This software is provided 'as-is', without any express or implied warranty",),
    "zlib-event": ("In no event will the authors be held liable for any damages arising from the use of this software",),
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:",
    ),
    "artistic2": ("You may use this program under the terms of the Artistic License 2.0", "Licensed under the Artistic License 2.0"),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "cc-by": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc0": ("Licensed under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    "reserved": ("All rights reserved",),
}
# Licences whose short identifier may stand in a file (fixed values).
TAGGED = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "Zlib",
)
SENTENCES |= {f"tag-{licence}": (f"SPDX-License-Identifier: {licence}",) for licence in TAGGED}
# Rules in order: licence, and the identifiers that must follow one another in a text. Longer rules stand before their parts.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-grant",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-short", "apache-comply", "apache-copy", "apache-basis")),
    ("Apache-2.0", ("apache-short",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-2.0-only", ("gpl2-only", "gpl-hope", "gpl-details")),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("LGPL-2.1-or-later", ("lgpl21-free", "gpl-hope", "lgpl-details")),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free", "gpl-hope", "lgpl-details")),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope", "agpl-details")),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("GPL-3.0", ("gpl3-short",)),
    ("MPL-2.0", ("mpl-subject", "mpl-copy")),
    ("MPL-2.0", ("mpl-subject",)),
    ("EPL-2.0", ("epl2",)),
    ("BSL-1.0", ("bsl",)),
    ("Zlib", ("zlib-as-is", "zlib-event", "zlib-grant")),
    ("Artistic-2.0", ("artistic2",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC0-1.0", ("cc0",)),
)
RULES += tuple((licence, (f"tag-{licence}",)) for licence in TAGGED)
#: A slot holds so many characters of normalised text at most, which is the size of what may stand there.
SLOT = 200
_NOT_PLAIN = re.compile(r"[^a-z0-9]+")
_WORD_OR_END = re.compile(r"(?P<word>[a-z0-9]+)|[.!?;:,]+(?=\s|\Z)|\n|\Z")


def normalised(sentence: str) -> str:
    return _NOT_PLAIN.sub(" ", sentence.lower()).strip()


class Scanner:
    """Known sentences and rules, ready to scan texts."""

    def __init__(self, sentences: dict[str, tuple[str, ...]] = SENTENCES, rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES):
        self.rules = rules
        self.identifier = {normalised(s): name for name, known in sentences.items() for s in known if "..." not in s}
        slotted = [([normalised(part) for part in s.split("...")], name) for name, known in sentences.items() for s in known if "..." in s]
        self.slotted = [(re.compile(f"[a-z0-9][a-z0-9 ]{{0,{SLOT - 1}}}?".join(self._around(parts))), name) for parts, name in slotted]
        self.longest = max([len(s) for s in self.identifier] + [sum(map(len, parts)) + SLOT * (len(parts) - 1) for parts, _ in slotted], default=0)
        # Two words open a known sentence; the rest of a text is not looked at further.
        firsts = sorted({" ".join(s.split()[:2]) for s in [*self.identifier, *(parts[0] for parts, _ in slotted)]})
        self.opening = re.compile(r"(?<![a-z0-9])(?:" + "|".join(re.escape(f).replace(r"\ ", "[^a-z0-9]+") for f in firsts) + r")(?![a-z0-9])") if firsts else None

    @staticmethod
    def _around(parts: list[str]) -> list[str]:
        """Patterns of the fixed parts, with the blanks that part them from their slots."""
        last = len(parts) - 1
        return [(" " if k and p else "") + re.escape(p) + (" " if k < last else "") for k, p in enumerate(parts)]

    def _known(self, plain: str) -> str | None:
        """The identifier of a normalised sentence; sentences without slots come first."""
        if plain in self.identifier:
            return self.identifier[plain]
        return next((name for pattern, name in self.slotted if pattern.fullmatch(plain)), None)

    def found(self, text: str) -> list[tuple[int, int, str]]:
        """Known sentences of a text without overlap: start, end, identifier.

        A sentence begins where two of its words open it and ends at the end of a clause or line; the longest known one counts.
        White space, line breaks and signs in between do not matter, however many.
        """
        if self.opening is None or len(text) < 2:
            return []
        lower = text.lower()
        if len(lower) != len(text):  # a few characters grow when lowered
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        out, at = [], 0
        while m := self.opening.search(lower, at):
            at = m.end()
            best, words, size = None, [], -1
            for e in _WORD_OR_END.finditer(lower, m.start()):
                if e.lastgroup == "word":
                    words.append(e.group())
                    size += len(e.group()) + 1
                    if size > self.longest:
                        break
                elif words and (name := self._known(" ".join(words))):
                    best = (m.start(), e.end() if e.group() != "\n" else e.start(), name)
            if best:
                out.append(best)
                at = best[1]
        return out

    def scan(self, text: str | None) -> list[tuple[str, int, int, int, int]]:
        """Matches: licence, rule number, sentences, start, end (code points). Sentences that fit no rule are passed over."""
        found, out, k = self.found(text or ""), [], 0
        while k < len(found):
            for number, (licence, names) in enumerate(self.rules):
                if tuple(f[2] for f in found[k : k + len(names)]) == names:
                    out.append((licence, number, len(names), found[k][0], found[k + len(names) - 1][1]))
                    k += len(names)
                    break
            else:
                k += 1
        return out


def licence_matches(documents: DataFrame, sentences: dict[str, tuple[str, ...]] = SENTENCES, rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES) -> DataFrame:
    """One row per match: doc_id, match (from 1, in text order), licence, rule, n_sentences, start, stop (code points of the text).

    NULL and empty texts have no matches. Whole texts are scanned. Repeated rows give their matches each, NULL doc_ids are kept.
    Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentences, rules)
        for batch in small_batches(batches, "text", 4 << 20):
            rows = [(k, n + 1, *m) for k, t in enumerate(batch.column("text")) for n, m in enumerate(scanner.scan(t.as_py()))]
            kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            columns = [pa.array([r[c + 1] for r in rows], k) for c, k in enumerate(kinds)]
            ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.record_batch([ids, *columns], names=["doc_id", "match", "licence", "rule", "n_sentences", "start", "stop"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, match int, licence string, rule int, n_sentences int, start long, stop long")
