"""Fill-in-the-middle against a plain cut by position, and the way back."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sedimenta.llm.fill_in_middle import fill_in_middle, restored


def brute(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (i, len(units), "plain", None, None, text)
    if h[3] % 100 < 20:
        return (i, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (i, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


TEXTS = [
    "",
    None,
    "a",
    "One two, three.\nFour\r\n\tfive  six!",
    "naïve Ünïcode 😀😀 mixed日本語text end",
    "$1 \\2 ${name} $ \\ a$",
    "<P",
    "S>",
    "<<P<<S<M ><",
    "x <P> y",
    "x <S> y",
    "x <M> y",
    "\n",
    "\n\n\n",
    "ab\x00cd",
    "tail newline\n",
    ">",
    "<",
]


def test_forms(spark, documents):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(20 * len(TEXTS))]
    rows += [(None, "no id, and some words"), (5, "id five again"), (5, "id five again"), (-7, "a negative id")]
    df = documents(*rows, extra=True)
    cut = fill_in_middle(df)
    assert cut.columns == [*df.columns, "n", "form", "prefix_chars", "middle_chars", "output"]
    back = cut.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    got = [tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in back]
    assert sorted(got, key=repr) == sorted((brute(*r) for r in rows), key=repr)
    assert all(r["back"] == (r["text"] or "") for r in back)
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}


def test_very_long_texts(documents):
    rows = [(i, t) for i in range(4) for t in ("x" * 3_000_000, "a1 " * 400_000, "😀" * 300_000, "line\n" * 300_000)]
    rows = [(4 * n + i, t) for n, (i, t) in enumerate(rows)]
    got = [tuple(r) for r in fill_in_middle(documents(*rows)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
    assert sorted(got) == sorted(brute(*r) for r in rows)


def test_clash_is_refused(documents):
    with pytest.raises(ValueError, match="form"):
        fill_in_middle(documents((1, "a")).withColumn("Form", F.lit(1)))


def test_names_used_inside_may_be_columns(documents):
    df = documents((1, "one two three"), (2, "four five")).withColumn("whole_text", F.lit("z")).withColumn("Unit_Pattern", F.lit("y"))
    got = sorted(tuple(r) for r in fill_in_middle(df).select("doc_id", "output", "whole_text").collect())
    assert got == [(i, brute(i, t)[5], "z") for i, t in ((1, "one two three"), (2, "four five"))]


def test_empty_table(documents):
    assert fill_in_middle(documents()).collect() == []
