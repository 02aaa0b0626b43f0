"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed by (source, language, topic). Raking scales these cells in
turn to the target shares of each marginal until all three hold; a document is kept
with the probability that its cell was scaled by, so that the expected tokens of the
sample have the target shares. Cells that would need a probability above 1 are kept whole
and the others are raked to what is left, so no rare cell decides how much is kept.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import Scratch, fresh, quoted, refuse_taken, text_of

#: Cells that are raked on the driver, and that are sent to all tasks; more stay tables.
DRIVER_CELLS, BROADCAST_CELLS = 1 << 20, 1 << 16
#: Rounds of raking at most.
ROUNDS = 200
#: Share of all tokens in cells that may miss the targets, as they are kept whole.
SPARED = 0.01
#: Category of NULLs and values without a target, where there are targets.
REST = "(rest)"


#: Columns that the result has beside those of the input.
RESULTS = ("topic", "tokens", "probability", "sampled")


def token_weight(text: Column) -> Column:
    """Tokens of a text, counted by single spaces; none in an empty one."""
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def topic_of(text: Column) -> Column:
    """A plain topic by form: ``legal`` for licence lines, ``table`` for many marks, else by length."""
    size = F.length(text)
    marks = size - F.length(F.translate(text, "#$%&*{}<>|", ""))
    return (
        F.when(text.contains("icense"), "legal")
        .when(marks * 20 > size, "table")
        .when(size < 1000, "note")
        .when(size < 5000, "article")
        .otherwise("long")
    )


def tempered(totals: Mapping[str, float], power: float) -> dict[str, float]:
    """Target shares in proportion to the present ones to the given power."""
    raised = {k: v**power for k, v in totals.items() if v > 0}
    whole = sum(raised.values())
    return {k: v / whole for k, v in raised.items()}


def rake(
    cells: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS, tolerance: float = 1e-9
) -> np.ndarray:
    """``cells`` scaled to the ``targets``, one array of shares per axis.

    Targets of categories without any weight are dropped and the others scaled up. Stops
    when no share is further off than ``tolerance``; targets that contradict each other
    (cells that are zero can't grow) leave the last round's cells.
    """
    if not cells.sum():
        return cells.astype(float)
    at = np.nonzero(cells)
    held = Cells(list(at), cells[at] / cells.sum())
    goals = [held.goal(a, np.asarray(t, float), 1.0, bound=False) for a, t in enumerate(targets)]
    held.solve(goals, range(cells.ndim), False, rounds, tolerance)
    out = np.zeros(cells.shape)
    out[at] = held.weight * held.factor
    return out


class Cells:
    """The cells as arrays: a code for each dimension, the ``weight`` (all add up to 1) and
    the ``factor`` that raking gives them."""

    def __init__(self, codes: list[np.ndarray], weight: np.ndarray):
        self.codes, self.weight, self.factor = codes, weight, np.ones(len(weight))

    def sums(self, axis: int, values: np.ndarray, size: int = 0) -> np.ndarray:
        return np.bincount(self.codes[axis], values, size)

    def goal(self, axis: int, shares: np.ndarray, whole: float, bound: bool) -> np.ndarray:
        """``whole`` dealt to the categories in proportion to ``shares``, to none more than
        it has if ``bound``; what that leaves goes to the others."""
        has = self.sums(axis, self.weight, len(shares))
        shares = np.where(has > 0, shares, 0.0)
        if not shares.sum():
            raise ValueError(f"no category of dimension {axis} has both weight and target")
        full = np.zeros(len(shares), bool)
        scale = whole / shares.sum()
        while bound:
            more = (shares * scale >= has) & (shares > 0)
            if (more == full).all() or not shares[~more].sum():
                full = more
                break
            full = more
            scale = max(whole - has[full].sum(), 0.0) / shares[~full].sum()
        return np.where(full, has, shares * scale)

    def step(self, axis: int, goal: np.ndarray, bound: bool) -> float:
        """Scale one dimension to its goal; how far it was off. If ``bound``, a cell counts
        with a factor of 1 at most, and the scale of each category allows for that."""
        code, size = self.codes[axis], len(goal)
        plain = self.sums(axis, self.weight * self.factor, size)
        scale = np.divide(goal, plain, out=np.zeros(size), where=plain > 0)
        off = np.abs(self.sums(axis, self.weight * (np.minimum(self.factor, 1.0) if bound else self.factor), size) - goal)
        # what a category keeps is concave in its scale, so Newton's steps rise to the goal
        for _ in range(ROUNDS if bound else 0):
            free = self.factor * scale[code] < 1
            rest = self.sums(axis, self.weight * self.factor * free, size)
            fixed = self.sums(axis, self.weight * ~free, size)
            new = np.divide(goal - fixed, rest, out=scale.copy(), where=rest > 0)
            if (new <= scale * (1 + 1e-14)).all():
                break
            scale = np.maximum(new, scale)
        self.factor = np.minimum(self.factor * scale[code], 1e300)
        return float(off.max())

    def solve(self, goals: list[np.ndarray], order, bound: bool, rounds: int = ROUNDS, tolerance: float = 1e-9) -> None:
        for _ in range(rounds):
            if max([self.step(axis, goals[axis], bound) for axis in order]) <= tolerance:
                break

    def top(self, spared: float) -> float:
        """The largest factor but for cells that have less than ``spared`` of the weight."""
        order = np.argsort(-self.factor)
        at = int(np.searchsorted(np.cumsum(self.weight[order]), spared, side="right"))
        return float(self.factor[order[min(at, len(order) - 1)]])

    def rescale(self, by: float) -> float:
        """Multiply the factors; the share of the weight that is kept then."""
        self.factor = self.factor * by
        return float((self.weight * np.minimum(self.factor, 1.0)).sum())


def draw_shares(cells: Cells | SparkCells, shares: list, stated: list[int], kept: float | None) -> None:
    """Rake ``cells`` so that the factors, cut at 1, are probabilities.

    The share of the weight to keep is ``kept``. Without it, it is the largest at which the
    ``stated`` dimensions hold or, if none is stated, the largest at which all hold but for
    cells with ``SPARED`` of the weight: a rare cell that would need more than it has is
    kept whole instead of making all others smaller.
    """
    every = range(len(shares))
    chosen = stated or list(every)
    goals = [cells.goal(a, shares[a], 1.0, bound=False) for a in every]
    cells.solve(goals, chosen, False)
    share = cells.rescale(1 / cells.top(0.0 if stated else SPARED))
    if kept is not None:
        cells.rescale(kept / share)
        share = kept
    # what was stated comes last, so it holds where the others contradict it
    order = [a for a in every if a not in stated] + stated
    cells.solve([cells.goal(a, shares[a], share, bound=True) for a in every], order, True)


class SparkCells:
    """``Cells`` as a table, for more than fit the driver: columns ``k0``, ``k1``... and ``w``.

    Each step sums by one dimension, joins the categories' scales back and is written.
    """

    def __init__(self, table: DataFrame, scratch: Scratch):
        self.scratch, self.whole = scratch, float(table.agg(F.sum("w")).first()[0])
        self.table = scratch.keep(table.withColumns({"w": F.col("w") / self.whole, "f": F.lit(1.0)}))

    def _replace(self, table: DataFrame) -> None:
        old, self.table = self.table, self.scratch.keep(table)
        self.scratch.free(old)

    def shares(self, axis: int, targets: Mapping[str, float] | None, power: float) -> DataFrame:
        """Categories with what they have and their shares, in no certain scale."""
        sums = self.table.groupBy(f"k{axis}").agg(F.sum("w").alias("has"))
        if targets is None:
            return self.scratch.keep(sums.withColumn("share", F.pow("has", F.lit(power))))
        given = self.table.sparkSession.createDataFrame([(f"={k}", float(v)) for k, v in targets.items()], f"k{axis} string, share double")
        found = sums.join(given, f"k{axis}", "left")
        return self.scratch.keep(found.withColumn("share", F.coalesce("share", F.lit(0.0))))

    def goal(self, axis: int, shares: DataFrame, whole: float, bound: bool) -> DataFrame:
        total = shares.agg(F.sum("share")).first()[0]
        if not total:
            raise ValueError(f"no category of dimension {axis} has both weight and target")
        scale, full = whole / total, 0
        while bound:
            more = (F.col("share") * F.lit(scale) >= F.col("has")) & (F.col("share") > 0)
            n, has, rest = shares.agg(
                F.count_if(more), F.sum(F.when(more, F.col("has"))), F.sum(F.when(~more, F.col("share")))
            ).first()
            if n == full or not rest:
                break
            full, scale = n, max(whole - has, 0.0) / rest
        goal = F.col("share") * F.lit(scale)
        return shares.select(f"k{axis}", (F.least(goal, "has") if bound else goal).alias("goal"))

    def step(self, axis: int, goal: DataFrame, bound: bool) -> float:
        """One of Newton's steps for each category, not all; the rounds bring the others."""
        mass, free = F.col("w") * F.col("f"), F.col("f") < 1
        sums = self.table.groupBy(f"k{axis}").agg(
            F.sum(mass).alias("plain"),
            F.coalesce(F.sum(F.when(free, mass)), F.lit(0.0)).alias("free"),
            F.coalesce(F.sum(F.when(~free, F.col("w"))), F.lit(0.0)).alias("fixed"),
        )
        from_zero = F.when(F.col("plain") > 0, F.col("goal") / F.col("plain")).otherwise(0.0)
        off, by = F.abs(F.col("plain") - F.col("goal")), from_zero
        if bound:
            off = F.abs(F.col("fixed") + F.col("free") - F.col("goal"))
            on = F.when(F.col("free") > 0, (F.col("goal") - F.col("fixed")) / F.col("free")).otherwise(1.0)
            by = F.when(F.col("goal") > F.col("fixed"), on).when((F.col("goal") == F.col("fixed")) & (F.col("free") == 0), 1.0).otherwise(from_zero)
        scales = self.scratch.keep(sums.join(goal, f"k{axis}").select(f"k{axis}", off.alias("off"), by.alias("by")))
        worst = scales.agg(F.max("off")).first()[0]
        scaled = self.table.join(scales.drop("off"), f"k{axis}")
        self._replace(scaled.withColumn("f", F.least(F.col("f") * F.col("by"), F.lit(1e300))).drop("by"))
        self.scratch.free(scales)
        return float(worst)

    def solve(self, goals: list[DataFrame], order, bound: bool, rounds: int = ROUNDS, tolerance: float = 1e-6) -> None:
        Cells.solve(self, goals, order, bound, rounds, tolerance)

    def top(self, spared: float) -> float:
        low, high = self.table.filter("f > 0").agg(F.min("f"), F.max("f")).first()
        above = 0.0
        # ranges of factors, then of the range where the weight above passes ``spared``
        for _ in range(8):
            if spared <= 0 or high <= low:
                break
            wide = (high - low) / 1024
            place = F.least(F.floor((F.col("f") - low) / wide), F.lit(1023))
            inside = self.table.filter((F.col("f") >= low) & (F.col("f") <= high))
            ranges = inside.groupBy(place.alias("at")).agg(F.sum("w"), F.min("f"), F.max("f")).collect()
            for _, weight, first, last in sorted(ranges, reverse=True):
                low, high = first, last
                if above + weight > spared:
                    break
                above += weight
        return float(high)

    def rescale(self, by: float) -> float:
        self._replace(self.table.withColumn("f", F.col("f") * F.lit(by)))
        return float(self.table.agg(F.sum(F.col("w") * F.least("f", F.lit(1.0)))).first()[0])


def category(value: Column, targets: Mapping[str, float] | None) -> Column:
    """Key of a category: NULL is one of its own; with targets, what has none is ``REST``."""
    value = value.cast("string")
    if targets is None:
        return F.coalesce(F.concat(F.lit("="), value), F.lit(""))
    return F.concat(F.lit("="), F.when(value.isin(list(targets)), value).otherwise(REST))


def calibrate(
    docs: DataFrame,
    weight: Column,
    keys: list[Column],
    targets: list[Mapping[str, float] | None],
    power: float = 0.85,
    kept: float | None = None,
    driver_cells: int = DRIVER_CELLS,
) -> tuple[DataFrame, int]:
    """Cells (``k0``, ``k1``...) with their ``probability``, and how many there are.

    One aggregation gives the cells, with every category told apart. Up to
    ``driver_cells`` are raked as arrays on the driver, more of them as a table, to a
    tolerance of a millionth. How much is kept is said at ``draw_shares``.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "cells")
    names = [f"k{axis}" for axis in range(len(keys))]
    sums = docs.groupBy(*[k.alias(n) for n, k in zip(names, keys, strict=True)]).agg(F.sum(weight).cast("double").alias("w"))
    every = scratch.keep(sums.filter("w > 0"))
    n = every.count()
    stated = [axis for axis, given in enumerate(targets) if given is not None]
    if not n:
        return every.select(*names, F.lit(0.0).alias("probability")), 0
    if n <= driver_cells:
        rows = every.toArrow().combine_chunks()
        codes = [rows[name].combine_chunks().dictionary_encode() for name in names]
        w = rows["w"].to_numpy()
        cells = Cells([c.indices.to_numpy() for c in codes], w / w.sum())
        shares = []
        for axis, given in enumerate(targets):
            found = codes[axis].dictionary.to_pylist()
            has = cells.sums(axis, cells.weight)
            shares.append(has**power if given is None else np.array([float(given.get(k[1:], 0.0)) for k in found]))
        draw_shares(cells, shares, stated, kept)
        out = spark.createDataFrame(rows.drop_columns("w").append_column("probability", [np.minimum(cells.factor, 1.0)]))
    else:
        cells = SparkCells(every, scratch)
        shares = [cells.shares(axis, given, power) for axis, given in enumerate(targets)]
        draw_shares(cells, shares, stated, kept)
        out = cells.table.select(*names, F.least("f", F.lit(1.0)).alias("probability"))
    # written, so that Catalyst knows how small it is
    result = scratch.keep(out)
    scratch.free(*[t for t, _ in list(scratch.paths.values()) if t is not result])
    return result, n


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    language_col: str = "lang",
    topic_col: str | None = None,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    power: float = 0.85,
    seed: int = 1,
    kept: float | None = None,
    driver_cells: int = DRIVER_CELLS,
) -> DataFrame:
    """``docs`` with ``topic``, ``tokens``, ``probability`` and ``sampled``.

    ``targets`` gives shares by category for any of ``source``, ``language`` and
    ``topic``; a dimension without is tempered to the given ``power``. Without a
    ``topic_col`` the topic is ``topic_of`` the text. A category without target is never
    sampled, nor is a row of no tokens where no cell has weight (probability 0); rows
    without tokens share the probability of their cell where it has any. The draw is a
    function of the id and ``seed``, so a rerun keeps the same documents and rows with
    one id fare alike; NULL ids are drawn by their text. An empty table gives an empty result.
    A very long text weighs what it holds; its cell is raked like others.

    ``kept`` is the share of the tokens to keep. Without it as many are kept as the given
    targets allow; without targets, as many as the tempered shares allow when cells with
    ``SPARED`` of the tokens may miss them. A category whose target is more than it has is
    kept whole, and the others share the rest in proportion to their targets.
    """
    if kept is not None and not 0 < kept <= 1:
        raise ValueError("kept must be above 0 and at most 1")
    refuse_taken(docs, *[x for x in RESULTS if x != "topic" or topic_col != x])
    text = text_of(docs, text_col)
    topic = quoted(topic_col).cast("string") if topic_col else topic_of(text)
    dims = {"source": quoted(source_col), "language": quoted(language_col), "topic": topic}
    weight = token_weight(text)
    given = [dict(targets[d]) if targets and d in targets else None for d in dims]
    keys = [category(value, shares) for value, shares in zip(dims.values(), given, strict=True)]
    cells, n = calibrate(docs, weight, keys, given, power, kept, driver_cells)
    inner = fresh(docs, "cell_source", "cell_language", "cell_topic", "cell_probability")
    keyed = docs.withColumns(dict(zip(inner, keys, strict=False)))
    cells = cells.toDF(*inner)
    joined = keyed.join(F.broadcast(cells) if n <= BROADCAST_CELLS else cells, inner[:3], "left")
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(quoted(id_col).cast("string"), text), F.lit(f":{seed}"))), 1, 8), 16, 10)
    share = F.coalesce(quoted(inner[3]), F.lit(0.0))
    return joined.select(
        *[quoted(c) for c in docs.columns],
        *([] if topic_col == "topic" else [topic.alias("topic")]),
        weight.cast("long").alias("tokens"),
        share.alias("probability"),
        (draw.cast("double") / float(1 << 32) < share).alias("sampled"),
    )
