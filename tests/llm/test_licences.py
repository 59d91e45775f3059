"""Varied notices and full texts of licences, in Python with the operator's own normalisation and in SQL."""

import duckdb

from aeromart.llm import licences

MIT_WRAPPED = licences.TEMPLATES["MIT text"].replace(". ", ".\n\n").replace(", ", ",\n")
FOUND = {
    1: ("Licensed under the MIT License.", "MIT"), 2: ("This project is licensed under the MIT License.", "MIT"), 3: ("The code is released under the MIT license", "MIT"),
    4: ("Copyright (c) 2020 A. Author\n\n" + MIT_WRAPPED, "MIT"), 5: (licences.TEMPLATES["BSD-3-Clause text"].replace("; ", ";\n"), "BSD-3-Clause"),
    6: (licences.TEMPLATES["AGPL-3.0 header"], "AGPL-3.0"), 7: ("This project is licensed under the GNU General Public License v3.0", "GPL-3.0"),
    8: (licences.TEMPLATES["BSD-2-Clause text"], "BSD-2-Clause"), 9: ("The code is released under the ISC license", "ISC"),
}


def test_varied_notices_and_full_texts(frame):
    rows = [(i, text) for i, (text, _) in FOUND.items()] + [(50, "The licence of the river boat is with the harbour master."), (51, "released under the bridge")]
    found = [tuple(r) for r in licences.licence_units(frame(rows)).collect()]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(map(repr, found)) == sorted(map(repr, connection.execute(licences.licence_sql()).fetchall()))
    for i, (_, licence) in FOUND.items():
        assert any(r[0] == i and r[2].startswith(licence) for r in found), (i, [r for r in found if r[0] == i])
    assert not {r[0] for r in found} & {50, 51}


def test_no_unit_passes_the_gate_and_is_similar():
    """Units made of a template's bigrams without the gate's words are all below the threshold."""
    known = licences.template_bigrams()
    gate = licences.gate_words(known, licences.THRESHOLD)
    assert len(gate) < 40
    for own in known.values():
        rest = [b for b in own if not any(w in b for w in gate)]
        assert 2 * len(rest) / (len(rest) + len(own)) < licences.THRESHOLD


def test_templates_fit_the_sql():
    assert max(map(len, licences.template_bigrams().values())) <= 266
