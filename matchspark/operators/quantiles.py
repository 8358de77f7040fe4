"""Exact percentiles of one column without sorting it in one place."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchspark.operators.columns import quoted

# Rows of a bracket that one task may rank; larger brackets are narrowed first.
RANKED_ROWS = 1_000_000
ROUNDS = 6


@dataclass
class Bracket:
    """Values [low, high] that should hold the wanted fractional rank, and what a count found."""

    rank: float
    low: float
    high: float
    below: int = 0
    inside: int = 0

    @property
    def holds(self) -> bool:
        return self.below <= floor(self.rank) and ceil(self.rank) < self.below + self.inside

    def inner(self, c: str = "v") -> str:
        return f"{c} BETWEEN {_text(self.low)} AND {_text(self.high)}"


def _text(value: float) -> str:
    return f"double('{value!r}')"


def exact_percentiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = 10_000, ranked_rows: int = RANKED_ROWS
) -> dict[float, float | None]:
    """Linearly interpolated percentiles, as many as asked for.

    A sketch with rank error n/accuracy brackets every wanted rank, and a count tells exactly
    which ranks the bracket holds. While it holds more rows than one task should rank it is
    narrowed by a sketch of its own rows; then its distinct values are ranked. A bracket that
    misses its rank falls back to the one before it, so the answer is always exact. NULL and
    NaN are left out.
    """
    value = quoted(column).cast("double")
    known = df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    ends = known.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    n = ends["n"]
    if n == 0:
        return {p: None for p in probabilities}
    wanted = list(dict.fromkeys(probabilities))
    settled = [Bracket(p * (n - 1), ends["low"], ends["high"], 0, n) for p in wanted]
    for _ in range(ROUNDS):
        large = [i for i, b in enumerate(settled) if b.inside > ranked_rows and b.low < b.high]
        if not large:
            break
        narrower = _counted(known, _narrowed(known, [settled[i] for i in large], accuracy))
        shrunk = False
        for i, b in zip(large, narrower):
            if b.holds and b.inside < settled[i].inside:
                settled[i], shrunk = b, True
        if not shrunk:
            break
    return dict(zip(wanted, _interpolated(known, settled)))


def _narrowed(known: DataFrame, brackets: list[Bracket], accuracy: int) -> list[Bracket]:
    """Brackets around the same ranks from a sketch of the rows inside each."""
    sketches = []
    for i, b in enumerate(brackets):
        slack = 2.0 / accuracy + 2.0 / b.inside
        at = (b.rank - b.below) / b.inside
        edges = [max(0.0, at - slack), min(1.0, at + slack)]
        sketches.append(f"percentile_approx(CASE WHEN {b.inner()} THEN v END, array({edges[0]!r}D, {edges[1]!r}D), {accuracy}) AS s{i}")
    row = known.selectExpr(*sketches).first()
    return [Bracket(b.rank, row[i][0], row[i][1]) for i, b in enumerate(brackets)]


def _counted(known: DataFrame, brackets: list[Bracket]) -> list[Bracket]:
    counts = [
        text
        for i, b in enumerate(brackets)
        for text in (f"count_if(v < {_text(b.low)}) AS below{i}", f"count_if({b.inner()}) AS inside{i}")
    ]
    row = known.selectExpr(*counts).first()
    return [Bracket(b.rank, b.low, b.high, row[f"below{i}"], row[f"inside{i}"]) for i, b in enumerate(brackets)]


def _interpolated(known: DataFrame, brackets: list[Bracket]) -> list[float]:
    """The value at each bracket's rank, from the distinct values inside it."""
    tags = ", ".join(f"CASE WHEN {b.inner()} THEN {i} END" for i, b in enumerate(brackets))
    counts = known.selectExpr("v", f"explode(array_compact(array({tags}))) AS b").groupBy("b", "v").agg(
        F.count(F.lit(1)).alias("c")
    )
    upto = F.sum("c").over(Window.partitionBy("b").orderBy("v"))
    ends = counts.select("b", "v", (upto - F.col("c")).alias("first"), upto.alias("past"))
    picks = [
        f"max(CASE WHEN b = {i} AND first <= {r - b.below} AND past > {r - b.below} THEN v END) AS {side}{i}"
        for i, b in enumerate(brackets)
        for side, r in (("a", floor(b.rank)), ("b", ceil(b.rank)))
    ]
    row = ends.selectExpr(*picks).first()
    return [row[f"a{i}"] + (row[f"b{i}"] - row[f"a{i}"]) * (b.rank - floor(b.rank)) for i, b in enumerate(brackets)]
