from pathlib import Path

import duckdb

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import licenses, oracle


def test_whole_texts_and_lines(spark):
    mit = dict(licenses.KNOWN_TEXTS[:1])["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2020 A B\nAll rights reserved.\n\n" + mit.upper().replace("\n", "  ")),
            (3, mit + " And more."), (4, "Some words.\n  released under the M.I.T  Licence!\nmore"),
            (5, "Released under the MIT Licence"), (6, "(c) 1999 nobody"), (7, "The licence is MIT."),
            (8, mit.replace("sublicense", "sub-license")),
            (9, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.license, r.line_licenses, r.n_notice_lines) for r in licenses.scan_licenses(df).collect()}
    assert [got[i][0] for i in range(1, 10)] == ["MIT", "MIT", None, None, "MIT", None, None, "MIT", None]
    assert got[4] == (None, [], 0)  # M.I.T is three words
    assert got[5] == ("MIT", ["MIT"], 1) and got[9] == (None, ["CC-BY-NC-4.0", "MIT"], 3)


def test_edges(edge_docs, no_docs):
    got = licenses.scan_licenses(edge_docs).collect()
    assert len(got) == len(EDGE_ROWS) and {r.license for r in got} == {None}
    assert licenses.scan_licenses(no_docs).count() == 0


def test_license_files(spark):
    """Licence files as they come: title, copyright line, blank lines, numbered or starred conditions, full texts."""
    body = {n: next(t for k, t in licenses.KNOWN_TEXTS if k == n and len(t) > 400) for n in ("MIT", "ISC", "BSD-3-Clause")}
    head = "\n\nCopyright (c) 2020, A B <a@b.org>\nAll rights reserved.\n\n"
    starred = body["BSD-3-Clause"].replace("\n1. ", "\n\n* ").replace("\n2. ", "\n\n* ").replace("\n3. ", "\n\n* ")
    rows = [("MIT", "MIT License" + head + body["MIT"]), ("MIT", "The MIT License (MIT)" + head + body["MIT"]),
            ("ISC", "ISC License" + head + body["ISC"]), ("BSD-3-Clause", "BSD 3-Clause License" + head + body["BSD-3-Clause"]),
            ("BSD-3-Clause", head + starred), (None, "MIT License\n\nbut other words")]
    common = Path("/usr/share/common-licenses")
    for name, file in {"Apache-2.0": "Apache-2.0", "GPL-2.0-only": "GPL-2", "GPL-3.0-only": "GPL-3", "LGPL-2.1-only": "LGPL-2.1",
                       "LGPL-3.0-only": "LGPL-3", "MPL-2.0": "MPL-2.0"}.items():
        if (common / file).exists():
            rows.append((name, (common / file).read_text()))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.digest) for r in licenses.scan_licenses(df).collect()}
    assert [got[i][0] for i in range(len(rows))] == [n for n, _ in rows]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (_, t) in enumerate(rows)])
    assert {i: (name, digest) for i, digest, name, *_ in con.sql(oracle.op3()).fetchall()} == got
