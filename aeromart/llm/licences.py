"""Licence scans with built-in functions only.

A text's units are its lines and, where several lines have words, the whole text. A unit is normalised to lower-case letters and digits, and
its set of word bigrams is compared with that of each licence template by the Dice coefficient
2 |A n B| / (|A| + |B|). Three bounds prune without loss:

* Dice >= t needs t / (2 - t) of a template's bigrams in the unit. A few words, chosen so that more of every template's bigrams
  hold one of them than may be missing, must therefore occur in a unit, and in its text: a text without any is not even normalised;
* it needs t / (2 - t) <= |B| / |A| <= (2 - t) / t, so only templates of a fitting size are compared;
* it also needs t / (2 - t) of the unit's bigrams to occur in some template, which is a set lookup
  per bigram and stops nearly every unit before any template is looked at.

Nothing is shuffled: the templates are literals of the plan, a fixed list.
"""

from collections import Counter
from collections.abc import Mapping
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Bounds give way by so much, so that rounding never rules out a unit that lies at the threshold.
SLACK = 1e-9
SEPARATORS = r"[^\p{L}\p{N}\n]+"

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
)
_BSD_TWO = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_THREE = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
_BSD_AS_IS = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
_NO_WARRANTY = (
    " {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
    "FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this "
    "{what}. If not, see <https://www.gnu.org/licenses/>."
)


def _gnu_header(name: str, version: str, it: str = "This program", what: str = "program") -> str:
    return (
        f"{it} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software "
        f"Foundation, either version {version} of the License, or (at your option) any later version."
    ) + _NO_WARRANTY.format(it=it, name=name, what=what)


#: Fixed texts: usual notices and headers of public licences, and the short licences in full. The SQL compares units of up to 400
#: bigrams, so no template may have more than 266.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD-3-Clause": "Released under the 3-Clause BSD License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MIT grant": _MIT_GRANT,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "AGPL-3.0 header": _gnu_header("Affero General Public License", "3"),
    "BSD grant": _BSD_GRANT,
    "BSD-2-Clause text": _BSD_GRANT + _BSD_TWO + _BSD_AS_IS,
    "BSD-3-Clause text": _BSD_GRANT + _BSD_TWO + _BSD_THREE + _BSD_AS_IS,
    "EPL-2.0 header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/"
    ),
    "GPL-2.0 header": _gnu_header("General Public License", "2"),
    "GPL-3.0 header": _gnu_header("General Public License", "3"),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-2.1 header": _gnu_header("Lesser General Public License", "2.1", "This library", "library"),
    "LGPL-3.0 header": _gnu_header("Lesser General Public License", "3"),
    "MIT text": (
        _MIT_GRANT + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}

#: Fixed texts: usual one-line notices, and the licences they are said of.
_NOTICES = ("Licensed under the {}.", "This project is licensed under the {}.", "The code is released under the {}.", "This work is distributed under the terms of the {}.")
_NAMES = {
    "AGPL-3.0": "GNU Affero General Public License v3.0", "Apache-2.0": "Apache License 2.0", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
    "EPL-2.0": "Eclipse Public License 2.0", "GPL-2.0": "GNU General Public License v2.0", "GPL-3.0": "GNU General Public License v3.0", "ISC": "ISC License",
    "LGPL-3.0": "GNU Lesser General Public License v3.0", "MIT": "MIT License", "MPL-2.0": "Mozilla Public License 2.0",
}
TEMPLATES |= {f"{name} notice {k}": notice.format(long) for name, long in _NAMES.items() for k, notice in enumerate(_NOTICES, 1)}


def normalised(text: Column) -> Column:
    """Lower-case letters, digits and line ends; everything else is one space."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, " "))


def unit_words(unit: Column) -> Column:
    return F.filter(F.split(unit, " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words; fewer than two words have none."""
    tail = F.when(F.size(words) > 1, F.slice(words, 2, F.size(words) - 1)).otherwise(F.array().cast("array<string>"))
    head = F.slice(words, 1, F.size(tail))
    return F.array_distinct(F.zip_with(head, tail, lambda a, b: F.concat_ws(" ", a, b)))


def template_bigrams(templates: Mapping[str, str] = TEMPLATES) -> dict[str, list[str]]:
    """Licence -> its distinct bigrams, under the same normalisation."""
    out = {}
    for name, text in sorted(templates.items()):
        words = "".join(c.lower() if c.isalnum() else " " for c in text).split()
        out[name] = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))  # noqa: B905
    return out


def gate_words(known: Mapping[str, list[str]], threshold: float) -> list[str]:
    """Words of which a unit must hold one to be as similar as `threshold` to any of the templates.

    Of a template with n bigrams at most n - n t / (2 - t) may be missing; the words are taken greedily, long ones
    first, until more bigrams than that hold one of them.
    """
    need = {name: len(own) - ceil(len(own) * threshold / (2 - threshold) - SLACK) + 1 for name, own in known.items()}
    left = {name: list(own) for name, own in known.items()}
    words: list[str] = []
    while any(n > 0 for n in need.values()):
        gain: dict[str, int] = {}
        for name, own in left.items():
            if need[name] > 0:
                for word, n in Counter(w for b in own for w in set(b.split())).items():
                    gain[word] = gain.get(word, 0) + min(n, need[name])
        best = min(gain, key=lambda w: (len(w) < 5, -gain[w], w))
        words.append(best)
        for name, own in left.items():
            rest = [b for b in own if best not in b]  # as texts are searched for it, also inside words
            need[name] -= len(own) - len(rest)
            left[name] = rest
    return sorted(words)


def licence_units(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, line, licence, n_shared, dice: for each unit the template with the largest Dice of at least `threshold`.

    `line` counts from 1; 0 is the whole text. Of equal templates the first by name is taken. Null and
    empty texts and units with fewer than two words have no row. Repeated rows give repeated rows; a
    null id stays null. Other columns are not read.
    """
    known = template_bigrams(templates)
    widest, least = (2 - threshold) / threshold + SLACK, threshold / (2 - threshold) - SLACK
    sizes = [len(b) for b in known.values()]
    gate = gate_words(known, threshold)

    def may_match(column: Column) -> Column:
        return reduce(Column.__or__, [column.contains(w) for w in gate])

    text = normalised(F.col("text"))
    lines = F.split(F.col("norm"), "\n")
    filled = F.size(F.filter(lines, lambda u: F.trim(u) != ""))
    whole = F.when(filled > 1, F.translate("norm", "\n", " ")).otherwise("")
    units = (
        docs.where(may_match(F.lower("text")))
        .select("doc_id", text.alias("norm"))
        .select("doc_id", F.posexplode(F.concat(F.array(whole), lines)).alias("line", "unit"))
        .where(may_match(F.col("unit")))
        .select("doc_id", "line", bigrams(unit_words(F.col("unit"))).alias("own"))
        .where(F.size("own").between(int(least * min(sizes)), int(widest * max(sizes)) + 1))
        .where(F.size(F.filter("own", lambda b: b.isin(sorted({x for y in known.values() for x in y})))) >= least * F.size("own"))
    )
    rows = F.array(
        *(
            F.struct(F.lit(-k).alias("place"), F.lit(name).alias("licence"), F.array(*map(F.lit, own)).alias("theirs"))
            for k, (name, own) in enumerate(known.items())
        )
    )

    def compared(t: Column) -> Column:
        shared = F.size(F.array_intersect(F.col("own"), t["theirs"]))
        dice = 2.0 * shared / (F.size("own") + F.size(t["theirs"]))
        return F.struct(dice.alias("dice"), t["place"].alias("place"), t["licence"].alias("licence"), shared.alias("n_shared"))

    def fits(t: Column) -> Column:
        return (F.size(t["theirs"]) >= least * F.size("own")) & (F.size(t["theirs"]) <= widest * F.size("own"))

    best = F.array_max(F.transform(F.filter(rows, fits), compared))
    return (
        units.select("doc_id", "line", best.alias("best"))
        .where(F.col("best.dice") >= threshold)
        .select("doc_id", "line", "best.licence", F.col("best.n_shared").cast("long").alias("n_shared"), "best.dice")
    )


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licence_sql(templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for the rows of `licence_units` over the table documents, without the pruning."""
    values = ", ".join(f"({k}, {_literal(name)}, [{', '.join(map(_literal, own))}])" for k, (name, own) in enumerate(template_bigrams(templates).items()))
    return f"""
WITH templates(place, licence, theirs) AS (VALUES {values}),
norm AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(lower(regexp_replace(coalesce(text, ''), '{SEPARATORS}', ' ', 'g')), chr(10)) AS lines
  FROM documents),
units AS (
  SELECT r, doc_id, i AS line, lines[i] AS unit FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM norm)
  UNION ALL
  SELECT r, doc_id, 0, array_to_string(lines, ' ') FROM norm WHERE len(list_filter(lines, lambda x: trim(x) <> '')) > 1),
split AS (SELECT r, doc_id, line, list_filter(string_split(unit, ' '), lambda x: x <> '') AS w FROM units),
pairs AS (
  SELECT r, doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own FROM split WHERE len(w) > 1),
rated AS (
  SELECT r, doc_id, line, licence, place, len(list_intersect(own, theirs)) AS n_shared,
         2.0::DOUBLE * len(list_intersect(own, theirs)) / (len(own) + len(theirs)) AS dice
  FROM pairs, templates WHERE len(own) <= 400 AND list_has_any(own, theirs)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r, line ORDER BY dice DESC, place) AS k FROM rated)
SELECT doc_id, line, licence, n_shared, dice FROM ranked WHERE k = 1 AND dice >= {threshold}
"""
