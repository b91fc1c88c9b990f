"""Fill-in-the-middle: a pattern made for each row, with counted possessive quantifiers, cuts and rearranges a text in one match."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_POINT = "(?s:.)"
BLOCK = 4096  # units that are counted at once


@dataclass(frozen=True)
class Marks:
    """What stands before the parts of a rearranged text; none may occur in another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def unit_count(text: Column, unit: str = CODE_POINT) -> Column:
    """How many units follow one another from the start of a text.

    ``regexp_count`` keeps its matches until they are counted, so whole blocks of units are counted first and single
    units in what remains only: it never holds more than a copy of the text.
    """
    block = rf"\G(?:{unit}){{{BLOCK}}}+"
    rest = F.regexp_replace(text, block, "")
    return F.regexp_count(text, F.lit(block)).cast("long") * BLOCK + F.regexp_count(rest, F.lit(rf"\G{unit}"))


def draw(key: Column, k: int) -> Column:
    """The ``k``-th (from 1) group of eight digits of a key's SHA-256, as an unsigned number."""
    return F.conv(F.substring(F.sha2(key, 256), 8 * k - 7, 8), 16, 10).cast("long")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output was made from, by its form alone."""
    p, s, m = (re.escape(x) for x in (marks.prefix, marks.suffix, marks.middle))
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain: int = 10, spm: int = 20,
    marks: Marks = Marks(), unit: str = CODE_POINT,
) -> DataFrame:
    """doc_id, n, form, prefix_units, middle_units and output of every row.

    A text is cut into ``n`` units, matches of the pattern ``unit`` that follow one another from its start (code points
    unless told otherwise).  The numbers drawn from ``seed`` and the id place two borders between units and choose the
    form: ``plain`` percent stay as they are, ``spm`` percent of the others have the suffix first, the rest the prefix.
    One ``regexp_replace`` with the row's own pattern captures the three parts and writes them between the marks.

    Null and empty texts, texts that hold a mark, and texts that the units don't cover are plain: the text itself, with
    null sizes.  A null id draws like an empty one.  Repeated rows give equal rows; an empty table gives none; other
    columns are not read, whatever their names.  Matching takes time linear in the text and holds a few copies of it.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("n", unit_count(F.col("text"), unit))
    h = [draw(key, k) for k in (1, 2, 3, 4)]
    one, two = (F.pmod(x, F.col("n") + 1) for x in h[:2])
    held = F.lit(False)
    for mark in (marks.prefix, marks.suffix, marks.middle):
        held = held | F.contains("text", F.lit(mark))
    form = F.when((F.col("text") == "") | held | (F.pmod(h[2], F.lit(100)) >= 100 - plain), "plain")
    form = form.when(F.pmod(h[3], F.lit(100)) < spm, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", F.least(one, two).alias("a"), F.greatest(one, two).alias("b"), form.alias("form"))
    if unit != CODE_POINT:  # code points cover every text
        covered = F.regexp_replace("text", F.concat(F.lit(rf"\A(?:{unit}){{"), F.col("n").cast("string"), F.lit("}+")), F.lit("")) == ""
        rows = rows.withColumn("form", F.when(covered, F.col("form")).otherwise("plain"))
    units = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"\A"), units(F.col("a")), units(F.col("b") - F.col("a")), F.lit(r"((?s:.)*+)\z"))
    p, s, m = (_quoted(x) for x in (marks.prefix, marks.suffix, marks.middle))
    written = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    plainly = F.col("form") == "plain"
    return rows.select(
        "doc_id", "n", "form", F.when(~plainly, F.col("a")).alias("prefix_units"), F.when(~plainly, F.col("b") - F.col("a")).alias("middle_units"),
        F.when(plainly, F.col("text")).otherwise(F.regexp_replace("text", pattern, written)).alias("output"),
    )
