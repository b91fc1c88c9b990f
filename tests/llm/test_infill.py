"""Fill-in-the-middle against slicing by code points, on edge cases and on the smallest tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lifespans.llm import infill, queries

from ..conftest import DATA

TEXTS = [
    None, "", "a", "ab", " \n\t\r\n", "😀😀é\U0001d54fz" * 50, "holds <P> itself", "<S>", "x<M>", "<P<S<M", "$1 \\ $2 ${a} \\E", "P><S", "line\nline\r\n end",
    "\x00\x01", "é" * 9, "long " * 60_000, "👍🏽 " * 4096, "y" * 4096, "z" * 4097, "same", "same",
]


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(k * 13 + j, t) for j in range(6) for k, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (7, "twice"), (7, "twice"), (2**63 - 1, "end"), (-5, "below")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(0) for c in ("n", "a", "b", "form", "output", "h1")})


def test_edge_cases_match_slices_and_come_back(edge):
    got = infill.fill_in_middle(edge).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "", brute(r.doc_id, r.text)) for r in edge.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.back, (r.n, r.form, r.prefix_units, r.middle_units, r.output)) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    want = {r.doc_id: (*brute(r.doc_id, r.text)[:4], sha(brute(r.doc_id, r.text)[4]), sha(r.text)) for r in docs.collect()}
    assert {r[0]: tuple(r)[1:] for r in queries.op11_fill_in_middle(spark, DATA).collect()} == want


def test_other_units_marks_and_shares(spark):
    """Words as units: borders fall between words, and a text that the units don't cover stays plain."""
    docs = spark.createDataFrame([(k, f"one two  three {k} four\nfive ") for k in range(60)] + [(60, " leading")], "id long, body string")
    marks = infill.Marks("[$pre]", "[suf.]", "[mid\\]")
    got = infill.fill_in_middle(docs, "id", "body", seed=7, plain=0, spm=50, marks=marks, unit=r"\S+\s*").withColumn("back", infill.restored(F.col("output"), F.col("form"), marks)).collect()
    for r in got:
        text = f"one two  three {r.doc_id} four\nfive " if r.doc_id < 60 else " leading"
        assert r.back == text and (r.form == "plain") == (r.doc_id == 60)
        if r.form != "plain":
            assert r.n == 6 and r.output.count("[$pre]") == 1 and 0 <= r.prefix_units + r.middle_units <= 6
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(docs.limit(0), "id", "body").count() == 0
