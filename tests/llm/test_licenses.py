from __future__ import annotations

import math
import re
import textwrap

import pytest

from lodespark.llm import licenses, queries
from tests.compare import connect, differences


@pytest.fixture
def templates(frame):
    rows = [(name, n, notice) for n, (name, notice) in enumerate(licenses.TEMPLATES)]
    return frame(rows, "licence string, template int, notice string")


def cosine(line, notice):
    vectors = [set(re.findall("[a-z0-9]+", n.lower())) for _, n in licenses.TEMPLATES]
    idf = lambda t: math.log(1 + len(vectors)) - math.log(1 + sum(t in v for v in vectors)) + 1
    a, b = (set(re.findall("[a-z0-9]+", x.lower())) for x in (line, notice))
    length = lambda v: math.sqrt(sum(idf(t) ** 2 for t in v))
    return sum(idf(t) ** 2 for t in a & b) / (length(a) * length(b))


def test_notices(frame, templates):
    lines = [
        "prose\nLicensed under the Apache License, Version 2.0.\nmore",
        "This is released under the MIT License",
        "Redistribution and use in source and binary forms, with or\nwithout modification, are permitted"
        " provided that the\nfollowing conditions are met\n\nand more",
        "licensed",
        "",
        None,
    ]
    files = frame([(f"f{n}", t) for n, t in enumerate(lines)], "path string, text string")
    found = {r["path"]: r for r in licenses.notices(files, templates).collect()}
    assert {p: r["licence"] for p, r in found.items()} == {
        "f0": "Apache-2.0", "f1": "MIT", "f2": "BSD-3-Clause"
    }
    assert found["f1"]["score"] == pytest.approx(cosine(lines[1], "Released under the MIT License."), abs=1e-8)


def test_inheritance(frame, templates):
    mit, gpl = "Released under the MIT License.", licenses.TEMPLATES[7][1]
    rows = [
        ("r/LICENSE", mit), ("r/a/COPYING.txt", gpl), ("r/a/b/c.py", "x"), ("r/d/e.py", "x"),
        ("r/a/f.py", mit), ("r/ab/g.py", None), ("other/h.py", "x"), (None, mit), ("top", "x"),
        ("r/d/e.py", "x"), ("r/notice.py", mit),
    ]
    files = frame([(*r, "clash") for r in rows], "path string, text string, licence string")
    found = licenses.scan(files, templates).collect()
    assert sorted((str(r["path"]), str(r["licence"]), str(r["inherited_from"])) for r in found) == sorted(
        [
            ("r/LICENSE", "MIT", "None"), ("r/a/COPYING.txt", "GPL-3.0", "None"),
            ("r/a/b/c.py", "GPL-3.0", "r/a/COPYING.txt"), ("r/d/e.py", "MIT", "r/LICENSE"),
            ("r/d/e.py", "MIT", "r/LICENSE"), ("r/a/f.py", "MIT", "None"), ("r/ab/g.py", "MIT", "r/LICENSE"),
            ("other/h.py", "None", "None"), ("None", "None", "None"), ("top", "None", "None"),
            ("r/notice.py", "MIT", "None"),
        ]
    )
    assert licenses.scan(files.limit(0), templates).collect() == []
    assert licenses.scan(files, templates.limit(0)).where("licence is not null").collect() == []


def test_headers_that_are_wrapped_and_commented(frame, templates):
    def wrapped(notice, mark, width):
        return mark[0] + "\n".join(mark[1] + line for line in textwrap.wrap(notice, width)) + mark[2]

    marks = [("", "", ""), ("/*\n", " * ", "\n *\n * more words\n */"), ("", "# ", "\n#\n# more"), ("", "REM ", "")]
    rows = [("spdx.c", "// SPDX-License-Identifier: GPL-2.0-only\nint x;"), ("plain.c", "free software of the version")]
    wanted = {"spdx.c": "GPL-2.0-only", "plain.c": None}
    for n, (licence, notice) in enumerate(licenses.HEADERS):
        for k, mark in enumerate(marks):
            rows.append((f"{n}.{k}", "Some words before it\n" + wrapped(notice, mark, 50 + 9 * k)))
            wanted[f"{n}.{k}"] = licence
    found = licenses.scan(frame(rows, "path string, text string"), templates).collect()
    assert {r["path"]: r["licence"] for r in found} == wanted
    (row,) = licenses.scan(frame([(None, rows[0][1])], "path string, text string"), templates).collect()
    assert row["licence"] is None


def test_all_that_is_found_decides(frame, templates):
    wanted = {
        "planted/two/LICENSE": "BSD-2-Clause", "planted/two/code.c": "BSD-2-Clause", "planted/three/LICENSE": "BSD-3-Clause",
        "planted/spdx.c": "BSD-2-Clause", "planted/sentence.c": "BSD-3-Clause", "planted/zlib.h": "Zlib",
        "planted/zero.txt": "0BSD", "planted/isc.txt": "ISC",
    }
    found = licenses.scan(frame(list(licenses.PLANTED), "path string, text string"), templates).collect()
    assert {r["path"]: r["licence"] for r in found} == wanted


def test_texts_set_aside_hold_no_notice(frame, templates):
    lines = [" ".join(n.split()[: len(n.split()) * k // 10]) for _, n in licenses.TEMPLATES + licenses.HEADERS for k in range(3, 11)]
    files = frame([(f"{n}", f"prose\n{t}\nprose") for n, t in enumerate(lines)], "path string, text string")
    few = [notice for _, notice in licenses.TEMPLATES]
    kept = {r["path"] for r in licenses.hopeful(files, few).collect()}
    for found in (licenses.candidates(files, templates), licenses.headers(files)):
        assert {r["path"] for r in found.select("path").distinct().collect()} <= kept
    assert licenses.hopeful(frame([("a", "an ordinary text"), (None, "license"), ("b", None)], "path string, text string"), few).count() == 0


def test_query_on_the_smallest_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert differences(queries.op2_license_scan(spark, sf_dir), connect(sf_dir), licenses.SQL) == ""
