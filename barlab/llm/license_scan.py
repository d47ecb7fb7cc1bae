"""Licence scan by sentence rules (DataFrame functions only).

A text is cut into sentences, each is normalised (A-Z lower-cased, every run of
other characters than a-z and 0-9 one blank, none at the ends) and looked up
among the known licence sentences.  What is found, in text order and without the
unknown sentences in between, is the text's identifier sequence.  A licence is
reported if one of its rules, an ordered list of sentence identifiers, occurs in
that sequence as consecutive entries.

Texts are read twice: with line ends as sentence ends (notices on a line of their
own), and with line ends as blanks (wrapped licence texts), where a blank line or one of
marks only, and the end of a line that begins with "copyright", still end a sentence; a
licence found in either reading counts.  An SPDX tag is a pair of sentences, the tag
and the licence's identifier.  The known sentences and rules are fixed tables, so the
scan is a projection of each row: nothing is shuffled or broadcast.

Defined results: null and empty texts have no sentence and no licence; a licence
named more than once is listed once; repeated rows are scanned each; columns
named ``n_known`` or ``licenses`` are replaced, all others are kept, whatever their name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.names import unused

# Licence sentences by identifier, as their licences and notices have them.
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-project": "This project is licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-copy-url": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-unless": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl3-work": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl3-work": "This work is licensed under the GNU Affero General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-terms": "either version 2 of the License, or (at your option) any later version.",
    "gpl2-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "lgpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-licensed": "Licensed under the BSD License.",
    "bsd3-licensed": "Licensed under the 3-Clause BSD License.",
    "isc-and-grant": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v 2.0.",
    "mpl-subject-head": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-version": "2.0.",
    "mpl-copy-https": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0": "This work is released under CC0 1.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}
# Fixed values: (licence, sentence identifiers in order); a licence may have several rules.  The GPL
# family's grants name their licence by themselves: what stands before is "This program", "This library"
# or another name, or a copyright line that has no end.
RULES = [
    ("AGPL-3.0", ["agpl3-work"]),
    ("AGPL-3.0", ["agpl3-terms"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("Apache-2.0", ["apache-header", "apache-comply"]),
    ("Apache-2.0", ["apache-comply", "apache-copy", "apache-unless", "apache-see"]),
    ("Apache-2.0", ["apache-comply", "apache-copy-url"]),
    ("BSD", ["bsd-licensed"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd3-licensed"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-4.0", ["cc-by-long"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-long"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-long"]),
    ("CC0-1.0", ["cc0"]),
    ("GPL-2.0", ["gpl2-work"]),
    ("GPL-2.0", ["gpl2-grant", "gpl2-terms"]),
    ("GPL-3.0", ["gpl3-work"]),
    ("GPL-3.0", ["gpl3-terms"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-and-grant"]),
    ("LGPL-3.0", ["lgpl3-work"]),
    ("LGPL-3.0", ["lgpl3-terms"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-project"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-notice", "mit-warranty", "mit-liability"]),
    ("MPL-2.0", ["mpl-subject"]),
    ("MPL-2.0", ["mpl-subject-head", "mpl-version"]),
    ("MPL-2.0", ["mpl-copy"]),
    ("MPL-2.0", ["mpl-copy-https"]),
    ("Unlicense", ["unlicense"]),
]
# How notices of one sentence name a licence, and its SPDX identifiers.  A notice is any of
# the openings, a name and any of the ends.
OPENINGS = ["Licensed under", "Released under", "Distributed under", "Available under"]
SUBJECTS = ["", "This project is", "This software is", "This program is", "This library is", "This package is", "This code is", "This work is"]
ENDS = ["", "(see LICENSE)", "see LICENSE", "see the LICENSE file", "see the LICENSE file for details", "see LICENSE for details"]
NAMES = {
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License"],
    "BSD-2-Clause": ["the 2-Clause BSD License", "the BSD 2-Clause License"],
    "BSD-3-Clause": ["the 3-Clause BSD License", "the BSD 3-Clause License"],
    "GPL-2.0": ["the GNU General Public License v2.0", "the GNU General Public License, version 2"],
    "GPL-3.0": ["the GNU General Public License v3.0", "the GNU General Public License, version 3"],
    "ISC": ["the ISC License"],
    "MIT": ["the MIT License", "the terms of the MIT License"],
    "MPL-2.0": ["the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0"],
}
SPDX = {
    "AGPL-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "Apache-2.0": ["Apache-2.0"],
    "BSD-2-Clause": ["BSD-2-Clause"],
    "BSD-3-Clause": ["BSD-3-Clause"],
    "CC-BY-4.0": ["CC-BY-4.0"],
    "CC-BY-SA-4.0": ["CC-BY-SA-4.0"],
    "CC0-1.0": ["CC0-1.0"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0+", "GPL-2.0-only", "GPL-2.0-or-later"],
    "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "ISC": ["ISC"],
    "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "MIT": ["MIT"],
    "MPL-2.0": ["MPL-2.0"],
    "Unlicense": ["Unlicense"],
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = r"([.!?;:])[\x20\x09-\x0D]+"
_COPYRIGHT = r"((?:^|\n)[^a-z0-9\n]*copyright[^\n]*)"  # in lower-cased text
_BLANK = r"\n[^a-z0-9\n]*\n"


def normalise(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _known(sentences: dict[str, str]) -> dict[str, str]:
    """Identifiers by normalised sentence; no two sentences may be alike."""
    known = {}
    for name, text in sentences.items():
        if (other := known.setdefault(normalise(text), name)) != name:
            raise ValueError(f"sentences {other} and {name} are the same once normalised")
    return known


KNOWN = _known(SENTENCES)


def _add_notices() -> None:
    """Known sentences and rules of the one-sentence notices and the SPDX tags."""
    for licence, names in NAMES.items():
        RULES.append((licence, ["notice-" + licence]))
        for name in names:
            for text in (f"{subject} {opening} {name} {end}" for subject in SUBJECTS for opening in OPENINGS for end in ENDS):
                KNOWN.setdefault(normalise(text), "notice-" + licence)
    KNOWN[normalise("SPDX-License-Identifier:")] = "spdx"
    single = [(normalise(tag), licence) for licence, tags in SPDX.items() for tag in tags]
    for tag, licence in single:
        KNOWN.setdefault(tag, "spdx-" + licence)
    RULES.extend((licence, ["spdx", "spdx-" + licence]) for licence in SPDX)
    for tag, licence in single:  # a choice or sum of two names both
        for other_tag, other in single:
            if licence != other:
                for word in ("or", "and"):
                    KNOWN.setdefault(f"{tag} {word} {other_tag}", "spdx-" + "-and-".join(sorted([licence, other])))
    for a in SPDX:
        for b in SPDX:
            if a < b:
                RULES.extend((x, ["spdx", f"spdx-{a}-and-{b}"]) for x in (a, b))


_add_notices()


def _flowing(lower: Column) -> Column:
    """Lower-cased text with line ends as blanks, but for ends of paragraphs and of copyright lines."""
    ended = F.regexp_replace(F.regexp_replace(lower, _COPYRIGHT, "$1.\n"), _BLANK, ".\n")
    return F.translate(ended, "\n\r\x0b\x0c", "    ")


def _sentences(lower: Column) -> Column:
    """Normalised sentences of a lower-cased text whose line ends are sentence ends."""
    cut = F.split(F.regexp_replace(lower, _END, "$1\n"), "\n", -1)
    return F.transform(cut, lambda s: F.btrim(F.regexp_replace(s, "[^a-z0-9]+", " ")))


def _identifiers(lower: Column) -> Column:
    """The known sentences' identifiers in text order."""
    names = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    found = F.filter(_sentences(lower), lambda s: s.isin(list(KNOWN)))
    return F.transform(found, lambda s: names[s])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_known`` (known sentences, line ends as sentence ends)
    and ``licenses`` (array of licence names, in alphabetical order)."""
    base = docs.drop("n_known", "licenses")
    lower, line, flow, seq = unused([*base.columns, "n_known", "licenses"], "lower", "line", "flow", "seq")
    rows = base.withColumn(lower, F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER))
    rows = rows.withColumn(line, _identifiers(F.col(lower))).withColumn(flow, _identifiers(_flowing(F.col(lower))))
    sequence = lambda c: F.concat(F.lit("|"), F.array_join(c, "|"), F.lit("|"))
    rows = rows.withColumn(seq, F.concat(sequence(line), F.lit("\n"), sequence(flow)))
    hits = [F.when(F.contains(F.col(seq), F.lit("|" + "|".join(ids) + "|")), F.lit(name)) for name, ids in RULES]
    rows = rows.withColumn("n_known", F.size(line).cast("long")).withColumn("licenses", F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))))
    return rows.drop(lower, line, flow, seq)


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in KNOWN.items())
    rules = ", ".join(f"({quote(name)}, {quote('|' + '|'.join(ids) + '|')})" for name, ids in RULES)
    cut = rf"string_split(regexp_replace(t, '{_END}', '\1' || chr(10), 'g'), chr(10))"
    ended = rf"regexp_replace(regexp_replace(t, '{_COPYRIGHT}', '\1.' || chr(10), 'g'), '{_BLANK}', '.' || chr(10), 'g')"
    return f"""
WITH known(k, id) AS (VALUES {known}),
rules(name, ids) AS (VALUES {rules}),
lowered AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
texts AS (
  SELECT doc_id, 1 AS view, t FROM lowered
  UNION ALL
  SELECT doc_id, 2, translate({ended}, chr(10) || chr(13) || chr(11) || chr(12), '    ') FROM lowered),
cut AS (SELECT doc_id, view, unnest({cut}) AS s, generate_subscripts({cut}, 1) AS pos FROM texts),
found AS (
  SELECT doc_id, view, pos, id FROM cut JOIN known ON trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) = k),
seqs AS (SELECT doc_id, view, count(*) AS n, '|' || string_agg(id, '|' ORDER BY pos) || '|' AS seq FROM found GROUP BY doc_id, view),
named AS (
  SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM seqs JOIN rules ON contains(seq, ids) GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_known, coalesce(n.licenses, '') AS licenses
FROM documents d LEFT JOIN seqs s ON s.doc_id = d.doc_id AND s.view = 1 LEFT JOIN named n ON n.doc_id = d.doc_id
"""


ORACLE_SQL = _sql()
