"""Wrapped headers and whole licence files, ties, long texts; and the queries that SQL can express against it."""

import random
import textwrap

import duckdb
import pytest

from lifespans.llm import licences, queries

from ..conftest import DATA
from ..test_queries import TABLES, rows

TEXTS = dict(licences.whole_texts())
MIT, BSD3, GPL_HEADER = (max((t for n, t in licences.TEMPLATES if n == name and "Version 3, 29" not in t), key=len) for name in ("MIT", "BSD-3-Clause", "GPL-3.0"))
FILLER = " ".join(f"body{i % 700} clause{i}" for i in range(3000))


def wrapped(text, width=60, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def licence_files():
    """Whole texts as they come: with titles and many copyright lines, rewrapped, as comments; and a notice that fills its file."""
    lines = "\n".join(f"Copyright (c) {2010 + k} Person Number{k} and others. All rights reserved." for k in range(6))
    files = {name: [text, lines + "\n\n" + text, wrapped(text, 90), wrapped(text, 50, "# ")] for name, text in TEXTS.items()}
    files["MIT"].append("MIT License\n\nCopyright (c) 2021 Some Body\n\n" + wrapped(MIT) + "\n\nThe above copyright notice and this permission notice shall be included in all copies.\n")
    files["BSD-3-Clause"].append("Copyright 2019 A. Person. All rights reserved.\n\n" + wrapped(BSD3, 72) + "\n\nTHIS SOFTWARE IS PROVIDED AS IS")
    files["BSL-1.0"].append(TEXTS["BSL-1.0"].split("\n\n")[1])
    return files


def test_licence_files_license_their_directories(spark):
    assert set(TEXTS) >= {"GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "LGPL-3.0", "Apache-2.0", "MPL-2.0", "EPL-2.0", "CC0-1.0", "BSL-1.0", "Unlicense", "Zlib", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause"}
    files, want = [], {}
    for name, texts in licence_files().items():
        for k, text in enumerate(texts):
            files += [(len(files), f"{name}/{k}/LICENSE", text), (len(files) + 1, f"{name}/{k}/src/deep/a.py", "print('hello')\nplain words")]
            want[f"{name}/{k}/LICENSE"], want[f"{name}/{k}/src/deep/a.py"] = (name, "own", None), (name, "inherited", f"{name}/{k}")
    got = {r.path: (r.licence, r.origin, r.from_dir) for r in licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert {k: (got[k], v) for k, v in want.items() if got[k] != v} == {}


def test_parts_and_mixtures_are_no_licence_files(spark):
    """A beginning followed by other words has an own licence and licenses nothing; half of two licences is neither; code that quotes a licence licenses nothing."""
    gpl, apache = TEXTS["GPL-2.0"], TEXTS["Apache-2.0"]
    files = [
        (1, "a/COPYING", gpl[:1500] + FILLER), (2, "a/x.c", "int main"), (3, "b/both", gpl + "\n" + apache), (4, "b/x.c", "int main"),
        (5, "c/code.c", wrapped(GPL_HEADER, 60, " * ") + "\n" + FILLER), (6, "c/x.c", "int main"), (7, "d/words", "license work program " * 500), (8, "d/x.c", "int main"),
    ]
    got = {r.doc_id: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got[1] == ("GPL-2.0", "own") and got[5] == ("GPL-3.0", "own") and got[7] == (None, None)
    assert [got[k] for k in (2, 4, 6, 8)] == [(None, None)] * 4 and got[3][1] == "own"


def test_a_file_as_near_to_two_texts_is_neither(spark):
    texts = [("One", "alpha beta gamma delta first"), ("Two", "alpha beta gamma delta second")]
    files = [(1, "a/l", "alpha beta gamma delta"), (2, "b/l", "alpha beta gamma delta first"), (3, "c/l", "alpha beta gamma delta second second"), (4, "d/l", "x"), (5, None, None), (None, "e/l", "")]
    scan = licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string"), templates=[("Zero", "none of these words")], texts=texts, text_threshold=0.7)
    assert {r.doc_id: r.licence for r in scan.collect()} == {1: None, 2: "One", 3: "Two", 4: None, 5: None, None: None}


@pytest.mark.parametrize(("mark", "width"), [("", 400), ("# ", 50), (" * ", 70), ("// ", 33)])
def test_headers_in_any_wrapping(spark, mark, width):
    code = "\n" + "x = 1\n" * 400
    files = [
        (1, "a/1", wrapped("Copyright (C) 2020 Me", width, mark) + "\n" + wrapped(GPL_HEADER + " This program is distributed in the hope that it will be useful.", width, mark) + code),
        (2, "a/2", wrapped(BSD3, width, mark) + code), (3, "a/3", wrapped("Copyright 2020 Me. Licensed under the MIT License.", width, mark) + code), (4, "a/4", "nothing" + code),
    ]
    got = {r.doc_id: r.licence for r in licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got == {1: "GPL-3.0", 2: "BSD-3-Clause", 3: "MIT", 4: None}


def test_ties_and_long_texts(spark):
    one, two = "Licensed under CC BY 4.0.", "Released under the MIT License."
    files = [
        (1, "t/both", f"{one}\n{two}\n"), (2, "t/u/c", "x"), (3, "l/hyphens", "a" + "-" * 300_000 + "b"), (4, "l/long", " ".join(f"w{i}" for i in range(200_000)) + "\n" + two),
        (5, "l/lines", "licence license\n" * 20_000), (6, "l/dots", ". " * 100_000 + two),
    ]
    got = {r.doc_id: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("MIT", "inherited"), 4: ("MIT", "own"), 5: ("MIT", "inherited"), 6: ("MIT", "own")}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = queries.queries()[name](spark, DATA).toPandas().astype(object)
    want = con.execute(queries.oracle_sql()[name]).df().astype(object)
    number = lambda f: f.map(lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x)
    assert rows(number(got)) == rows(number(want))


def test_random_texts_match_sql_rules(spark):
    """Headers cut anywhere into random words are found exactly when a whole template is there."""
    r = random.Random(2)
    files = []
    for k in range(60):
        text = r.choice([GPL_HEADER, MIT, "Licensed under CC BY-SA 4.0."])
        words = text.split()
        broken = " ".join(words[: len(words) // 3]) if k % 2 else text
        files.append((k, f"f{k}/x", f"{FILLER[:500]}\n{broken}\n{FILLER[500:900]}"))
    got = {x.doc_id: x.licence for x in licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert all(got[k] for k in range(0, 60, 2))
