"""Licence scan by sentences, in built-in functions.

The known texts are cut into sentences; every sentence has an identifier, and a licence is the rule
"these identifiers in this order". Of a document, the sentences that are known are replaced by their
identifiers, all others are left out, and the rules are tried on what remains, longest first. A rule takes
what it matches, so a licence that is contained in a longer one is not reported with it.

Sentences end at . ; : ! ? before white space and at empty lines. A document is also read line by line, as
licence notes are often lines of their own among text that ends without a stop. Case, punctuation, comment
signs and line breaks do not matter. Tag lines (``SPDX-License-Identifier: MIT``) are one sentence each, as they stand on a line.

Defined results. Every row gives a row; null and empty texts have no licence. Repeated sentences match repeatedly and are
reported once. Known sentences that no rule takes are listed in ``unmatched``. Ids are carried along and may be anything.
The documents themselves are the only data; rules travel as literals, whose number is fixed here.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_text

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: "
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GPL_END = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details."
)
_GPL_GRANT = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by "
    "the Free Software Foundation, either version {1} of the License, or (at your option) any later version. "
)
_GNU_GRANT = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the "
    "Free Software Foundation; either version {2} of the License, or (at your option) any later version. "
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
    "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)

# Licence texts and notes as they are published, with the identifier of their licence.
KNOWN = (
    ("MIT", _MIT_GRANT + "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _MIT_WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_ENDORSE + _BSD_WARRANTY),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\n\n"
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0-or-later", _GPL_GRANT.format("", "2") + _GPL_END.format("")),
    ("GPL-3.0-or-later", _GPL_GRANT.format("", "3") + _GPL_END.format("")),
    ("AGPL-3.0-or-later", _GPL_GRANT.format("Affero ", "3") + _GPL_END.format("Affero ")),
    ("LGPL-3.0-or-later", _GPL_GRANT.format("Lesser ", "3") + _GPL_END.format("Lesser ")),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("all-rights-reserved", "All rights reserved."),
    ("GPL-2.0-or-later", _GNU_GRANT.format("program", "", "2") + _GPL_END.format("")),
    ("LGPL-2.1-or-later", _GNU_GRANT.format("library", "Lesser ", "2.1") + _GPL_END.format("Lesser ").replace("program", "library")),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
        'covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative '
        "works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices "
        "in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in "
        "all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in "
        'the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND "
        "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_WARRANTY,
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("Artistic-1.0-Perl OR GPL-1.0-or-later", "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself."),
)

# Identifiers that tag lines of source files name, and the names that notes give to licences.
TAGGED = (
    "0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 "
    "CC-BY-NC-ND-4.0 CC0-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only "
    "LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 MS-PL OFL-1.1 PostgreSQL Python-2.0 Unlicense WTFPL Zlib"
).split()
TAGGED_PAIRS = ("Apache-2.0 OR MIT", "MIT OR Apache-2.0", "GPL-2.0-only OR MIT", "GPL-2.0-only OR BSD-2-Clause", "GPL-2.0-only OR BSD-3-Clause")
NAMES = (
    ("MIT", ("MIT", "MIT License")),
    ("Apache-2.0", ("Apache-2.0", "Apache License 2.0", "Apache License, Version 2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License",)),
    ("BSD-3-Clause", ("BSD 3-Clause License",)),
    ("GPL-2.0-only", ("GPLv2", "GPL v2")),
    ("GPL-3.0-only", ("GPLv3", "GPL v3")),
    ("LGPL-3.0-only", ("LGPLv3", "LGPL v3")),
    ("AGPL-3.0-only", ("AGPLv3", "AGPL v3")),
    ("MPL-2.0", ("MPL 2.0", "Mozilla Public License 2.0")),
    ("ISC", ("ISC License",)),
)
NOTES = ("Licensed under {}.", "Licensed under the {}.", "This project is licensed under the {}.", "This software is licensed under the {}.", "Released under the {}.", "Distributed under the {}.")

SPLIT = r"[.;:!?]+(?=\s|$)|\n[^\S\n]*\n"


def _plain(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def _cut(text: str) -> list[str]:
    return [s for s in map(_plain, re.split(SPLIT, text)) if s]


def _lines() -> list[tuple[str, str]]:
    """Lines that are sentences as a whole: tags with an identifier, and notes with a name."""
    tags = [(name, f"SPDX-License-Identifier: {name}") for name in (*TAGGED, *TAGGED_PAIRS)]
    return tags + [(licence, note.format(name)) for licence, names in NAMES for name in names for note in NOTES]


def knowledge() -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Identifier of every known sentence, and (licence, identifiers in order) with the longest first."""
    names: dict[str, str] = {}
    rules = []
    for licence, text in KNOWN:
        for n, sentence in enumerate(_cut(text), 1):
            names.setdefault(sentence, f"<{licence}#{len(names) + 1}>")
        rules.append((licence, "".join(names[s] for s in _cut(text))))
    for licence, text in _lines():
        sentence = _plain(text)
        if sentence not in names:
            names[sentence] = f"<{licence}#{len(names) + 1}>"
            rules.append((licence, names[sentence]))
    return names, sorted(rules, key=lambda r: -r[1].count("<"))


def _identifiers(pieces: Column, names: dict[str, str]) -> Column:
    """The identifiers of known sentences, in order, as one string."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    plain = F.transform(pieces, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    # a map is searched from its start, the set of its keys by hash
    return F.array_join(F.transform(plain, lambda s: F.when(s.isin(*names), F.try_element_at(known, s))), "")


def _apply(sequence: Column, rules: list[tuple[str, str]]) -> Column:
    """struct<rest, found> after all rules; a match is replaced by a mark that no rule has."""
    listed = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(ids).alias("ids")) for name, ids in rules])
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["ids"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_append(state["found"], rule["licence"])).otherwise(state["found"]).alias("found"),
        )

    return F.when(sequence == "", start).otherwise(F.aggregate(listed, start, step))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, licences (sorted, distinct), unmatched (identifiers of known sentences that no rule took)."""
    names, rules = knowledge()
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(F.col(text_col)).alias("_text"))
    read = rows.select("doc_id", F.array(_identifiers(F.split("_text", SPLIT), names), _identifiers(F.split("_text", "\n"), names)).alias("_read"))
    both = read.select("doc_id", F.transform("_read", lambda s: _apply(s, rules)).alias("_both"))
    licences = F.array_sort(F.array_distinct(F.flatten(F.col("_both.found"))))
    rest = F.translate(F.array_join(F.col("_both.rest"), ""), "|", "")
    unmatched = F.array_sort(F.array_distinct(F.regexp_extract_all(rest, F.lit("<([^>]*)>"), F.lit(1))))
    taken = F.flatten(F.col("_both.found"))
    return both.select("doc_id", licences.alias("licences"), F.filter(unmatched, lambda u: ~F.array_contains(taken, F.split_part(u, F.lit("#"), F.lit(1)))).alias("unmatched"))
