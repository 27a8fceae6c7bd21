"""Licence recognition by sentences.

A text is cut into sentences, within lines and, for wrapped paragraphs, from the start of a line over the following
lines up to the end of the sentence. Normalised sentences that are in the table of licence sentences become
identifiers; the identifiers of a text, in their order, are matched against the rules. Rules are tried in the order
listed, longer and more special ones first; a match consumes its sentences, and what no rule takes is reported as
``unknown`` with its identifiers.

The work is a projection of each document: no shuffle, memory of one batch. Texts without any of the stems that every
known sentence has (a test holds the table to it) are passed over by a plain search; a stem of two words is found over
line ends and margins too.

Defined cases: null and empty texts have no licence; a licence that occurs twice gives two rows; rows with equal
doc_id are searched each; a null doc_id stays null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEMS = ("licen", "warrant", "permission", "redistribut", "copyright", "public domain", "liab", "mozilla", "reserved")

# Licence sentences as their licences word them, by identifier.
SENTENCES = {
    "mit-name": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
                 "This software is released under the MIT License", "SPDX-License-Identifier: MIT", "MIT License", "The MIT License",
                 "The MIT License (MIT)"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                  "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                  "permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                   "the Software"],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                     "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
                      "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
                      "OR OTHER DEALINGS IN THE SOFTWARE"],
    "apache2-name": ["Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
                     "This project is licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0",
                     "Licensed under the Apache License, Version 2.0 (the \"License\")", "Apache License, Version 2.0"],
    "apache2-comply": ["you may not use this file except in compliance with the License"],
    "apache2-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                     "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "apache2-asis": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                     "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "apache2-see": ["See the License for the specific language governing permissions and limitations under the License"],
    "gpl3-name": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
                  "This program is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only",
                  "Released under the GNU General Public License, version 3"],
    "gpl2-name": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2",
                  "SPDX-License-Identifier: GPL-2.0-only", "Released under the GNU General Public License, version 2"],
    "gpl3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                   "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl2-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                   "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
                 "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "gpl-details": ["See the GNU General Public License for more details"],
    "gpl-received": ["You should have received a copy of the GNU General Public License along with this program"],
    "lgpl3-name": ["Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only"],
    "agpl3-name": ["Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only"],
    "mpl2-name": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0",
                  "Licensed under the Mozilla Public License, version 2.0"],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                  "following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                   "disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                    "products derived from this software without specific prior written permission"],
    "bsd-warranty": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                     "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"],
    "bsd3-name": ["Released under the BSD 3-Clause License", "Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "bsd2-name": ["Released under the BSD 2-Clause License", "Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                  "provided that the above copyright notice and this permission notice appear in all copies"],
    "cc-by-nc-4": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
                   "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-4": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0",
                "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0",
                   "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["Dedicated to the public domain under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related "
            "or neighboring rights to this work"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "reserved": ["All rights reserved under copyright law", "Copyright, all rights reserved", "All rights reserved"],
}

# Rules in the order in which they are tried, each a licence and the identifiers that stand for it.
RULES = [
    ("MIT", ["mit-name", "mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("Apache-2.0", ["apache2-name", "apache2-comply", "apache2-copy", "apache2-asis", "apache2-see"]),
    ("Apache-2.0", ["apache2-name", "apache2-comply", "apache2-copy"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-hope", "gpl-details", "gpl-received"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-hope", "gpl-details", "gpl-received"]),
    ("BSD-3-Clause", ["reserved", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]),
    ("BSD-2-Clause", ["reserved", "bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"]),
    ("ISC", ["isc-grant", "mit-warranty"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-hope", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-hope", "gpl-details"]),
    ("MPL-2.0", ["mpl2-name", "mpl2-copy"]),
    ("MIT", ["mit-name"]),
    ("Apache-2.0", ["apache2-name"]),
    ("GPL-3.0-only", ["gpl3-name"]),
    ("GPL-2.0-only", ["gpl2-name"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("LGPL-3.0-only", ["lgpl3-name"]),
    ("AGPL-3.0-only", ["agpl3-name"]),
    ("MPL-2.0", ["mpl2-name"]),
    ("BSD-3-Clause", ["bsd3-name"]),
    ("BSD-2-Clause", ["bsd2-name"]),
    ("ISC", ["isc-grant"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("All-rights-reserved", ["reserved"]),
]

SCHEMA = "doc_id long, license string, sentences array<string>, first_line int, last_line int"
_END = re.compile(r"(?<=[.!?;:])(?=\s+\S)")
_NOISE = re.compile(r"[^a-z0-9]+")
_STEM = re.compile("|".join(s.replace(" ", "[^a-z0-9]+") for s in STEMS))


def normalised(sentence: str) -> str:
    """Lower case, British spelling folded, everything but letters and digits one blank."""
    return _NOISE.sub(" ", sentence.lower().replace("licence", "license")).strip()


KNOWN = {normalised(s): name for name, texts in SENTENCES.items() for s in texts}
_LONGEST = max(map(len, KNOWN))


def known_sentences(text: str) -> list[tuple[int, int, str]]:
    """(first line, last line, identifier) of the licence sentences of a text, in order; the longest reading wins."""
    pieces = [(number, p) for number, line in enumerate(text.split("\n")) for p in _END.split(line) if p.strip()]
    parts = [(number, normalised(p)) for number, p in pieces]
    # A sentence may go on in the next part where no end stands, or a number follows as in "v. 2.0".
    open_end = [p.rstrip()[-1] not in ".!?" or after[:1].isdigit() for (_, p), (_, after) in zip(pieces, [*parts[1:], (0, "")])]
    found, i = [], 0
    while i < len(parts):
        if not parts[i][1]:  # rules, bullets and the like begin no sentence
            i += 1
            continue
        best, joined, j = None, "", i
        while j < len(parts) and len(joined) <= _LONGEST:
            joined = f"{joined} {parts[j][1]}".strip()
            if joined in KNOWN:
                best = (j, KNOWN[joined])
            if not open_end[j]:
                break
            j += 1
        if best:
            found.append((parts[i][0], parts[best[0]][0], best[1]))
            i = best[0] + 1
        else:
            i += 1
    return found


def apply_rules(found: list[tuple[int, int, str]]) -> list[tuple[str, list[str], int, int]]:
    """(licence, identifiers, first line, last line) of each rule that matches, first rule first at each place."""
    names, out, i = [x[2] for x in found], [], 0
    while i < len(names):
        name, length = next(((lic, len(ids)) for lic, ids in RULES if names[i:i + len(ids)] == ids), ("unknown", 1))
        out.append((name, names[i:i + length], found[i][0], found[i + length - 1][1]))
        i += length
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[] for _ in range(5)]
        for doc, text in zip(batch.column("doc_id"), batch.column("text")):
            text = text.as_py()
            if text and _STEM.search(text.lower()):
                for match in apply_rules(known_sentences(text)):
                    for column, value in zip(rows, (doc.as_py(), *match)):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.list_(pa.string())),
            pa.array(rows[3], pa.int32()), pa.array(rows[4], pa.int32())], [f.split()[0] for f in SCHEMA.split(", ")])


def scan(docs: DataFrame) -> DataFrame:
    """One row per licence found: doc_id, license, sentences (identifiers), first_line, last_line (from 0)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan, SCHEMA)
