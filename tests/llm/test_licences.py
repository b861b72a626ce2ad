import textwrap

from pagemill.llm import licences

from .helpers import clashing, docs

TEXTS = dict((f"{name} {n}", text) for n, (name, text) in enumerate(licences.KNOWN))


def test_every_known_text_is_its_licence(spark):
    pairs = [(n, text) for n, (_, text) in enumerate(licences.KNOWN)]
    got = {r.doc_id: (r.licences, r.unmatched) for r in licences.scan(clashing(docs(spark, pairs))).collect()}
    assert got == {n: ([name], []) for n, (name, _) in enumerate(licences.KNOWN)}


def test_wrapped_commented_and_upper_case_text(spark):
    pairs = []
    for n, (_, text) in enumerate(licences.KNOWN):
        wrapped = "\n".join("# " + line for line in textwrap.wrap(text.upper().replace("\n\n", ". "), 60))
        pairs.append((n, f"some code without stop\n\n{wrapped}\n#\n\nmore code = 1;"))
    got = {r.doc_id: r.licences for r in licences.scan(docs(spark, pairs)).collect()}
    assert got == {n: [name] for n, (name, _) in enumerate(licences.KNOWN)}


def test_order_and_length_of_rules(spark):
    bsd2 = next(t for n, t in licences.KNOWN if n == "BSD-2-Clause")
    bsd3 = next(t for n, t in licences.KNOWN if n == "BSD-3-Clause")
    mit = licences.KNOWN[0][1]
    first, second = mit[: mit.index("The above")], mit[mit.index("The above") :]
    pairs = [
        (1, bsd3), (2, f"{bsd2}\n\n{mit}"), (3, f"{second}\n{first}"), (4, "word word\nReleased under the MIT License.\nword\nAll rights reserved\nx"),
        (5, "x. Licensed under CC BY-NC 4.0. y"), (6, None), (7, ""), (8, "filler. " * 50_000 + "Licensed under CC BY 4.0."), (9, "All rights reserved.\n" * 500),
        (9, "nothing"), (None, "released under the mit license"),
    ]
    got = sorted(((r.doc_id or 0, r.licences, bool(r.unmatched)) for r in licences.scan(docs(spark, pairs)).collect()), key=str)
    assert got == sorted(
        [
            (1, ["BSD-3-Clause"], False), (2, ["BSD-2-Clause", "MIT"], False), (3, [], True), (4, ["MIT", "all-rights-reserved"], False),
            (5, ["CC-BY-NC-4.0"], False), (6, [], False), (7, [], False), (8, ["CC-BY-4.0"], False), (9, ["all-rights-reserved"], False), (9, [], False), (0, ["MIT"], False),
        ],
        key=str,
    )


def test_empty_table(spark):
    assert licences.scan(docs(spark, [])).count() == 0


def test_tags_notes_and_texts_in_their_own_words(spark):
    """Texts as they stand in files, not taken from the module's tables."""
    zlib = (
        "/* This software is provided 'as-is', without any express or implied\n * warranty. In no event will the authors be held liable for any damages\n"
        " * arising from the use of this software.\n *\n * Permission is granted to anyone to use this software for any purpose,\n"
        " * including commercial applications, and to alter it and redistribute it\n * freely, subject to the following restrictions:\n *\n"
        " * 1. The origin of this software must not be misrepresented; you must not\n *    claim that you wrote the original software. If you use this software\n"
        " *    in a product, an acknowledgment in the product documentation would be\n *    appreciated but is not required.\n"
        " * 2. Altered source versions must be plainly marked as such, and must not be\n *    misrepresented as being the original software.\n"
        " * 3. This notice may not be removed or altered from any source distribution.\n */\nint x;"
    )
    gpl2 = (
        " This program is free software; you can redistribute it and/or modify\n it under the terms of the GNU General Public License as published by\n"
        " the Free Software Foundation; either version 2 of the License, or\n (at your option) any later version.\n\n"
        " This program is distributed in the hope that it will be useful,\n but WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n GNU General Public License for more details.\n"
    )
    pairs = [
        (1, "#!/bin/sh\n# SPDX-License-Identifier: MIT\necho 1"), (2, "/* SPDX-License-Identifier: GPL-2.0-or-later */\nint a;"),
        (3, "<!-- SPDX-License-Identifier: Apache-2.0 OR MIT -->"), (4, "SPDX-License-Identifier: unheard-of"), (5, "The notes say\nlicensed under GPLv3\nand so on"),
        (6, zlib), (7, gpl2), (8, "Distributed under the MPL 2.0. // SPDX-License-Identifier: MIT"), (9, "MIT\n1. GPL v3\nApache-2.0"),
        (10, "This project is licensed under the Apache License 2.0."), (11, "the word licensed under GPLv3 inside of a longer line"),
    ]
    got = {r.doc_id: (r.licences, r.unmatched) for r in licences.scan(docs(spark, pairs)).collect()}
    assert got == {
        1: (["MIT"], []), 2: (["GPL-2.0-or-later"], []), 3: (["Apache-2.0 OR MIT"], []), 4: ([], []), 5: (["GPL-3.0-only"], []), 6: (["Zlib"], []),
        7: (["GPL-2.0-or-later"], []), 8: (["MPL-2.0"], []), 9: ([], []), 10: (["Apache-2.0"], []), 11: ([], []),
    }
