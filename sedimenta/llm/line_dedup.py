"""Repeated runs of lines, found by winnowing; DataFrame functions only.

Lines are hashed. From each line on, the shortest run of lines with at least
``min_words`` words is a window, and so is the shortest such run that ends at a line; the
smallest line hash in a window is its fingerprint. Equal windows choose the same line, so
every repeated run of ``min_words`` words or more shares a fingerprint with its earlier
occurrence, and windows whose fingerprint is at one place only are dropped after one narrow
aggregation.

The places of a fingerprint are joined to the first place of the same window (told apart
by two keys of all its lines), and a match is extended both ways by the windows that
reach on from its lines, forwards and backwards. That takes in exactly the maximal runs of
``min_words`` words or more that occur earlier, whichever earlier place each is at: a line
of such a run lies in the window from itself on, or in the one that ends at it, or else
both sides of it are short and it lies in the window from the run's first line on; all of
these are inside the run, so they occurred earlier too. Conversely a window that occurred
earlier is part of such a run. Earlier means: smaller doc_id, then smaller line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import Scratch, fresh, quoted, text_of

#: What is taken off both ends of a line before it is compared.
BLANK = " \t\r"
_LAST_ID = (1 << 63) - 1
#: A window as a number: its first line times this, and its lines.
_SPAN = 1 << 32


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _windows(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """A row per window: document, first line, number of lines, fingerprint, keys.

    A window is written as one number, its first line and how many lines it has, so that
    one which is both kinds is one row.
    """
    text = text_of(docs, text_col)
    bare = F.filter(F.transform(_lines(text), _bare), lambda x: x != "")
    base = docs.select(
        F.coalesce(quoted(id_col).cast("long"), F.lit(_LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("content"),
        F.transform(
            bare,
            lambda x: F.struct(
                F.xxhash64(F.lit(1), x).alias("a"),
                F.xxhash64(F.lit(2), x).alias("b"),
                _words(x).alias("w"),
            ),
        ).alias("lines"),
    )

    def reach(rest: Column) -> Column:
        """How many of the lines make up a window; 0 if all are too few."""
        zero = F.struct(F.lit(0).alias("w"), F.lit(0).alias("k"))
        return F.aggregate(
            rest,
            zero,
            lambda acc, x: F.when(acc["w"] >= min_words, acc).otherwise(
                F.struct((acc["w"] + x["w"]).alias("w"), (acc["k"] + 1).alias("k"))
            ),
            lambda acc: F.when(acc["w"] >= min_words, acc["k"]).otherwise(0),
        )

    def onward(x: Column, i: Column) -> Column:
        rest = F.slice(F.col("lines"), i + 1, F.lit(min_words))
        n = F.when(x["w"] >= min_words, 1).otherwise(reach(rest))
        return F.when(n > 0, i.cast("long") * _SPAN + n)

    def backward(x: Column, i: Column) -> Column:
        start = F.greatest(i - min_words + 1, F.lit(0))
        rest = F.reverse(F.slice(F.col("lines"), start + 1, i - start + 1))
        n = F.when(x["w"] >= min_words, 1).otherwise(reach(rest))
        return F.when(n > 0, (i - n + 1).cast("long") * _SPAN + n)

    both = F.array_union(F.transform("lines", onward), F.transform("lines", backward))
    spans = base.select("doc", "content", "lines", F.explode(both).alias("span")).filter("span IS NOT NULL")
    spans = spans.select(
        "doc",
        "content",
        "lines",
        F.shiftright("span", 32).cast("int").alias("first"),
        F.pmod("span", F.lit(_SPAN)).cast("int").alias("n"),
    )
    part = F.slice("lines", F.col("first") + 1, F.col("n"))
    chosen = spans.withColumns(
        {
            "a": F.transform(part, lambda x: x["a"]),
            "b": F.transform(part, lambda x: x["b"]),
        }
    )
    return chosen.select(
        "doc",
        "content",
        "first",
        "n",
        F.array_min("a").alias("mark"),
        (F.col("first") + F.array_position("a", F.array_min("a")).cast("int") - 1).alias("anchor"),
        F.xxhash64("a").alias("key_a"),
        F.xxhash64(F.lit(2), "b").alias("key_b"),
    )


def _order() -> Column:
    scale = F.lit(1 << 31).cast("decimal(10,0)")
    return F.col("doc").cast("decimal(20,0)") * scale + F.col("first")


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 25,
    removed: str = "n_removed",
) -> DataFrame:
    """``docs`` without the later occurrences of repeated runs of lines.

    Of every run of at least ``min_words`` words that occurs at an earlier place too, and
    is as long as the two places agree, all lines go. All columns stay; ``text_col`` loses lines and ``removed`` says how many. Lines are
    compared without blanks at their ends; blank lines are never counted nor removed.
    A NULL text stays NULL, and an empty one empty; a text all of whose lines go is
    empty. A document without id comes after all others. Rows with one id and one text
    are the same document and are treated alike. A run shorter than ``min_words`` words
    stays, however often it occurs; words are counted by single spaces. Very long texts
    are compared whole; a task holds one text's lines at a time. An extra column
    with the name of an inner one does no harm; one named ``removed`` is an error.
    """
    if removed in docs.columns:
        raise ValueError(f"there is a column {removed} already")
    scratch = Scratch(docs.sparkSession, "lines")
    windows = scratch.keep(_windows(docs, id_col, text_col, min_words))
    place = F.xxhash64("doc", "content", "anchor")
    shared = (
        windows.groupBy("mark")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .filter("low < high")
        .select("mark")
    )
    matched = scratch.keep(windows.join(shared, "mark", "left_semi").drop("anchor"))
    scratch.free(windows)
    same = ["mark", "key_a", "key_b"]
    firsts = (
        matched.groupBy(*same)
        .agg(F.min(_order()).alias("low"), F.max(_order()).alias("high"))
        .filter("low < high")
        .drop("high")
    )
    # written, so that a hot window's places are split over the tasks of the join
    firsts = scratch.keep(firsts)
    later = matched.join(firsts, same).filter(_order() > F.col("low"))
    doc, content, spans, lines, places, gone = fresh(
        docs, "doc", "content", "spans", "lines", "places", "gone"
    )
    repeats = scratch.keep(
        later.groupBy("doc", "content")
        .agg(F.collect_set(F.struct("first", "n")).alias("spans"))
        .toDF(doc, content, spans)
    )
    scratch.free(matched, firsts)
    text = text_of(docs, text_col)
    # by shuffle at every size: the table of repeats grows with the input
    joined = docs.withColumns(
        {
            doc: F.coalesce(quoted(id_col).cast("long"), F.lit(_LAST_ID)),
            content: F.xxhash64(text),
        }
    ).join(repeats.hint("merge"), [doc, content], "left")
    split = joined.withColumn(lines, _lines(text)).withColumn(
        places,
        F.filter(
            F.transform(quoted(lines), lambda x, i: F.when(_bare(x) != "", i)),
            lambda i: i.isNotNull(),
        ),
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform(
                quoted(spans), lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1)
            )
        )
    )
    lost = split.withColumn(gone, covered)
    stay = F.array_except(
        F.sequence(F.lit(0), F.size(quoted(lines)) - 1),
        F.transform(quoted(gone), lambda j: F.get(quoted(places), j)),
    )
    short = F.array_join(F.transform(stay, lambda i: F.get(quoted(lines), i)), "\n")
    hit = quoted(spans).isNotNull()
    return lost.select(
        *[
            F.when(hit, short).otherwise(quoted(c)).alias(c) if c == text_col else quoted(c)
            for c in docs.columns
        ],
        F.when(hit, F.size(quoted(gone))).otherwise(0).cast("long").alias(removed),
    )


#: The same in DuckDB's SQL, for a table ``{docs}``: runs that are repeated, from the shortest
#: ones on that are long enough, whichever of their ends these begin at.
SQL = """
WITH split AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM {docs}
), bare AS (
  SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(13)) AS line FROM split
  WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
), counted AS (
  SELECT doc_id, pos, line, length(line) - length(replace(line, ' ', '')) + 1 AS w,
         row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM bare
), summed AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM counted
), spans AS (
  SELECT a.doc_id, a.i, b.i AS last
  FROM summed a ASOF JOIN summed b
    ON a.doc_id = b.doc_id AND a.upto - a.w + {min_words} <= b.upto
  UNION
  SELECT b.doc_id, a.i, b.i AS last
  FROM summed b ASOF JOIN summed a
    ON a.doc_id = b.doc_id AND b.upto - {min_words} >= a.upto - a.w
), keys AS (
  SELECT s.doc_id, s.i, s.last, string_agg(c.line, chr(10) ORDER BY c.i) AS content
  FROM spans s JOIN counted c ON c.doc_id = s.doc_id AND c.i BETWEEN s.i AND s.last
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS seen FROM keys
), gone AS (
  SELECT DISTINCT c.doc_id, c.pos
  FROM ranked r JOIN counted c ON c.doc_id = r.doc_id AND c.i BETWEEN r.i AND r.last
  WHERE r.seen > 1
), removed AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), rebuilt AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.pos) AS text
  FROM split s ANTI JOIN gone g ON g.doc_id = s.doc_id AND g.pos = s.pos
  WHERE s.doc_id IN (SELECT doc_id FROM removed)
  GROUP BY s.doc_id
)
SELECT d.* REPLACE (CASE WHEN m.n IS NULL THEN d.text ELSE coalesce(r.text, '') END AS text),
       coalesce(m.n, 0) AS n_removed
FROM {docs} d LEFT JOIN removed m ON m.doc_id = d.doc_id LEFT JOIN rebuilt r ON r.doc_id = d.doc_id
"""
