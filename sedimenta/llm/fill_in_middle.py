"""Texts rearranged for fill-in-the-middle training, by one match of a pattern of their own.

A text is a sequence of units: a run of the letters A-Z and a-z, or any other single
character. ``regexp_count`` says how many there are, two draws by the id say where the
prefix and the middle end, and a pattern with these two counts written into it captures
the three parts in one match: ``(unit{a})(unit{b-a})(rest)``. The quantifiers are
possessive, so the match runs through the text once, without a stack or a way back, and
the replacement puts the captured parts into the order wanted.

The text of one row and the units that ``regexp_count`` finds in it are all that a task
holds; nothing is shuffled, and a row's result depends on nothing but the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import fresh, quoted, text_of

#: One unit: letters are taken as a whole, any other character alone.
UNIT = r"[A-Za-z]+|[^A-Za-z]"
#: The same inside the per-row pattern; a run of letters is never given up in part.
_HELD = r"(?:[A-Za-z]++|[^A-Za-z])"

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: In a hundred: texts that are rearranged, and those of them that begin with the suffix.
REARRANGED, SUFFIX_FIRST = 90, 20


def draws(id_column: Column, seed: int = 1, count: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers: the groups of eight digits of the SHA-256 of ``seed:id``.

    A NULL id draws as an empty one would.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substr(digest, F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("long") for i in range(count)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    rearranged: int = REARRANGED,
    suffix_first: int = SUFFIX_FIRST,
    out: tuple[str, str, str, str, str] = ("n", "form", "prefix_chars", "middle_chars", "output"),
) -> DataFrame:
    """``docs`` with the columns ``out``: units, form, characters of prefix and middle, new text.

    The form is ``psm`` (prefix, suffix, middle), ``spm`` (suffix first) or ``plain``. An
    empty or NULL text, and one that contains a marker, is plain; its output is the text
    and it has no prefix or middle (NULL). Prefix, middle and suffix may be empty. Rows
    with one id have the same draws, rows without id those of an empty id. Long texts are
    matched whole. An empty table gives an empty one; a name in ``out`` that ``docs``
    already has is refused.
    """
    taken = {c.lower() for c in docs.columns} & {c.lower() for c in out}
    if taken:
        raise ValueError(f"columns already there: {', '.join(sorted(taken))}")
    n, form, prefix_chars, middle_chars, output = out
    text, pattern, order = fresh(docs, "whole_text", "unit_pattern", "part_order")
    whole = quoted(text)
    cut_a, cut_b, keep, turn = draws(quoted(id_col), seed)
    ends = [F.pmod(cut, quoted(n) + 1) for cut in (cut_a, cut_b)]
    low, high = F.least(*ends), F.greatest(*ends)
    marked = [F.contains(whole, F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = (whole == "") | marked[0] | marked[1] | marked[2] | (F.pmod(keep, F.lit(100)) >= rearranged)
    captures = F.format_string(rf"(?s)\A({_HELD}{{%d}}+)({_HELD}{{%d}}+)(.*+)\z", low, high - low)
    cut = (
        docs.withColumn(text, text_of(docs, text_col))
        .withColumn(n, F.regexp_count(whole, F.lit(UNIT)).cast("long"))
        .withColumn(
            form,
            F.when(plain, PLAIN).when(F.pmod(turn, F.lit(100)) < suffix_first, SPM).otherwise(PSM),
        )
        .withColumn(pattern, captures)
        .withColumn(
            order,
            F.when(quoted(form) == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(
                f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"
            ),
        )
        .withColumn(
            output,
            F.when(quoted(form) == PLAIN, whole).otherwise(
                F.regexp_replace(whole, quoted(pattern), quoted(order))
            ),
        )
    )
    prefix, middle, _ = parts(quoted(output), quoted(form))
    return cut.select(
        *[quoted(c) for c in docs.columns],
        quoted(n),
        quoted(form),
        F.length(prefix).cast("long").alias(prefix_chars),
        F.length(middle).cast("long").alias(middle_chars),
        quoted(output),
    )


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of a rearranged text; NULL for a plain one.

    A text with a marker in it is never rearranged, and no marker can come about where a
    part meets one, so each marker is found once.
    """
    lead = F.substr(F.substring_index(output, MIDDLE, 1), F.lit(4))
    middle = F.substring_index(output, MIDDLE, -1)
    first = {m: F.substring_index(lead, m, 1) for m in (PREFIX, SUFFIX)}
    last = {m: F.substring_index(lead, m, -1) for m in (PREFIX, SUFFIX)}
    psm = form == PSM
    prefix = F.when(psm, first[SUFFIX]).otherwise(last[PREFIX])
    suffix = F.when(psm, last[SUFFIX]).otherwise(first[PREFIX])
    shown = form != PLAIN
    return F.when(shown, prefix), F.when(shown, middle), F.when(shown, suffix)


def restored(output: Column, form: Column) -> Column:
    """The text before it was rearranged."""
    return F.coalesce(F.concat(*parts(output, form)), output)


#: DuckDB: the units as a list, cut by position.
SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM {docs}
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS x,
         ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS y,
         ('0x' || substr(digest, 17, 8))::BIGINT % 100 AS keep,
         ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS turn
  FROM texts
), cut AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR keep >= 90 THEN 'plain'
              WHEN turn < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(x, y)], '') AS prefix,
         array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(units[greatest(x, y) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
