from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest
from tools.compare import rows_of

from riskweave.llm import license_scan as ls
from riskweave.llm import queries_text
from riskweave.llm.license_texts import KNOWN, WHOLE

MIT = KNOWN[0][1]


def test_canonical_form():
    assert ls.canonical("Copyright (c) 2020 A. Person\nThe  Licence,\n\tis-granted!") == "the license is granted"
    assert ls.canonical("© 2020 X\n(C) Copyright Y\ncopyright © Z") == ""
    assert ls.canonical("COPYRIGHT HOLDERS be liable") == "copyright holders be liable"
    assert ls.canonical("Éa licences sublicence licencee") == "Éa licenses sublicense licencee"
    assert ls.digest(" .,!") is None and ls.digest("a") == ls.digest("A.\n")


def test_whole_texts_and_lines(documents_of):
    header = "Copyright (c) 1999 Somebody\nAll words here count\n"
    changed = MIT.upper().replace("\n", "\r\n   ").replace('"', "''")
    rows = [MIT, f"Copyright (c) 2024 Someone <x@y.z>\n\n{changed}", MIT + " more", "words\nReleased under the MIT Licence!\nLicensed under CC BY-NC 4.0.", header, None, "", MIT.replace("sublicense", "sublicence")]
    got = {r.doc_id: r for r in ls.scan(documents_of(rows)).collect()}
    assert [got[i].license for i in range(8)] == ["MIT", "MIT", None, None, None, None, None, "MIT"]
    assert (got[3].n_notices, got[3].notices) == (2, "2:MIT,3:CC-BY-NC-4.0") and got[0].n_notices == 0
    assert got[5].text_digest is None and got[6].text_digest is None and got[0].text_digest == got[1].text_digest


def test_sql_knows_whole_texts_and_bare_forms(documents_of):
    gpl = Path("/usr/share/common-licenses/GPL-3")
    texts = [MIT, f"Copyright: 2020 Somebody\nAll rights reserved.\n{MIT}", f"Copyright by X\n\n{MIT}", "All rights reserved.", None, "", "x\nReleased under the MIT License.", *([gpl.read_text()] if gpl.exists() else [])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    df = ls.scan(documents_of(texts))
    cur = con.execute(queries_text.license_sql())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())
    got = {r.doc_id: r.license for r in df.collect()}
    assert [got[i] for i in range(7)] == ["MIT", "MIT", "MIT", None, None, None, None] and (not gpl.exists() or got[7] == "GPL-3.0")


def test_own_table_and_shared_digests(spark, documents_of):
    known = ls.known_digests(spark, [("A", "some text"), ("B", "Some Text."), ("C", "...")])
    assert [tuple(r)[1] for r in known.collect()] == ["A / B"]
    (row,) = ls.scan(documents_of(["SOME text"]), known).collect()
    assert row.license == "A / B" and row.notices == "1:A / B"


def test_edges(documents_of, clashing):
    assert ls.scan(documents_of([])).count() == 0
    got = ls.scan(documents_of([(1, "a"), (1, "a"), (None, "Licensed under the MIT License."), (2, "b " * 200000)])).collect()
    assert len(got) == 4 and [r.notices for r in got if r.doc_id is None] == ["1:MIT"]
    assert ls.scan(clashing(["a"])).columns == ["doc_id", "text_digest", "license", "n_notices", "notices"]


LICENSES = Path("/usr/share/common-licenses")
NAMES = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
END = "END OF TERMS AND CONDITIONS"
#: First words of the standard header in the text, and the line it ends with.
HEADERS = {f: f"This {w}" for f, w in (("GPL-1", "program is free"), ("GPL-2", "program is free"), ("GPL-3", "program is free"), ("LGPL-2", "library is free"), ("LGPL-2.1", "library is free"), ("MPL-2.0", "Source Code Form is subject"))}
LAST = r"(51 Franklin|gnu\.org/licenses/>|MPL/2\.0/)[^\n]*\n"


def whole_forms(file):
    """A licence's text, the text without what follows its end, and its standard header."""
    text = (LICENSES / file).read_text()
    out = [text]
    if m := re.search(END, text):
        out += [text[: m.end()], text[: m.start()]]
    if file in HEADERS:
        rest = text[text.index(HEADERS[file]) :]
        out.append(rest[: re.search(LAST, rest).end()])
    return out


def whole_digests():
    return sorted({(NAMES[f], ls.bare_digest(t) or ls.digest(t)) for f in NAMES for t in whole_forms(f)})


@pytest.mark.skipif(not all((LICENSES / f).exists() for f in NAMES), reason="the machine has no licence texts")
def test_whole_licences_are_known(documents_of):
    assert whole_digests() == sorted(WHOLE)
    rows = [(f"{f}", t) for f in NAMES for t in whole_forms(f)]
    got = {r.doc_id: r.license for r in ls.scan(documents_of([t for _, t in rows])).collect()}
    assert [got[i] for i in range(len(rows))] == [NAMES[f] for f, _ in rows]


def test_statement_lines_don_t_hide_a_licence(documents_of):
    bsd = next(t for n, t in KNOWN if n == "BSD-3-Clause")
    heads = ["Copyright (c) 2020, X\nAll rights reserved.\n", "Copyright The X Authors\n", "Copyright by X\nALL RIGHTS RESERVED\r\n", "# Copyright: 2020 X\n"]
    got = {r.doc_id: r for r in ls.scan(documents_of([h + bsd for h in heads] + ["All rights reserved."])).collect()}
    assert [got[i].license for i in range(5)] == ["BSD-3-Clause"] * 4 + [None] and got[0].text_digest == ls.digest(heads[0] + bsd)
    assert ls.bare_digest("the above\ncopyright notice and this\nCOPYRIGHT HOLDERS and all rights reserved by law") is None
