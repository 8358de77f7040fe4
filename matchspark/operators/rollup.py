"""Many player rows to one row per match."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.functions.text import aggregate, named, project, tick
from matchspark.operators.columns import numeric_columns, quoted

# Widest single aggregate worth generating code for; see the timings in README.md.
DIRECT_LIMIT = 20
CHUNK_SIZE = 16
MOMENTS = ("sample", "population_rows")
STRATEGIES = ("auto", "direct", "chunked")


def chunks(items: Sequence[str], size: int) -> list[list[str]]:
    it = iter(items)
    return list(iter(lambda: list(islice(it, size)), []))


def moment_aggregates(x: str, moments: str, tag: object) -> dict[str, str]:
    """The mergeable state of one column; every entry combines on the map side."""
    x = f"CAST({x} AS double)"
    if moments == "sample":
        return {f"sum_{tag}": f"sum({x})", f"n_{tag}": f"count({x})", f"std_{tag}": f"stddev_samp({x})"}
    return {f"sum_{tag}": f"sum({x})", f"sumsq_{tag}": f"sum({x} * {x})"}


def finish_moments(prefix: str, column: str, moments: str, tag: object, source: str = "", rows: str = "_rows") -> list[str]:
    """sum, mean and std of a column from its state.

    'sample' skips missing values and divides by n-1. 'population_rows' counts every row of
    the match, also those without the value, and divides by that count.
    """
    state = lambda name: f"{source}{name}_{tag}"
    total = f"coalesce({state('sum')}, 0.0D)"
    if moments == "sample":
        # NULL where nothing was summed, and where one value has no spread
        mean, std = f"try_divide({state('sum')}, {state('n')})", state("std")
    else:
        mean = f"{total} / {rows}"
        std = f"sqrt(greatest(coalesce({state('sumsq')}, 0.0D) / {rows} - ({mean}) * ({mean}), 0.0D))"
    return [named(sql, f"{prefix}{column}_{part}") for part, sql in (("sum", total), ("mean", mean), ("std", std))]


def _direct(df: DataFrame, key: str, columns: Sequence[str], prefix: str, moments: str, with_count: bool) -> DataFrame:
    states = {"_rows": "count(1)"}
    out = [tick(key)]
    for i, c in enumerate(columns):
        states |= moment_aggregates(tick(c), moments, i)
        out += finish_moments(prefix, c, moments, i)
    if with_count:
        out.append(named("_rows", f"{prefix}player_count"))
    return aggregate(df, states, key).selectExpr(*out)


def _chunked(
    df: DataFrame, key: str, columns: Sequence[str], prefix: str, moments: str, with_count: bool, size: int
) -> DataFrame:
    """A row per (match, chunk of columns) in between.

    One scan whatever the width, and the aggregate has the states of ``size`` columns however
    many there are, so its generated code stays small. The last chunk is padded with NULL.
    """
    batches = chunks(columns, size)
    return assemble_chunks(fold_chunks(df, key, batches, moments), key, batches, prefix, moments, with_count)


def fold_chunks(df: DataFrame, key: str, batches: Sequence[Sequence[str]], moments: str) -> DataFrame:
    """``_key, _pos, _state``: the state of every chunk of columns, per match."""
    pieces = df.selectExpr(named(tick(key), "_key"), f"posexplode({packed_chunks(batches)}) AS (_pos, _cell)")
    states = {"_rows": "count(1)"}
    for i in range(len(batches[0])):
        states |= moment_aggregates(f"_cell.x{i}", moments, i)
    whole = ", ".join(named(sql, name) for name, sql in states.items())
    return pieces.groupBy("_key", "_pos").agg(F.expr(f"struct({whole}) AS _state"))


def assemble_chunks(
    folded: DataFrame, key: str, batches: Sequence[Sequence[str]], prefix: str, moments: str, with_count: bool = True
) -> DataFrame:
    """The wide roll-up from the states of its chunks."""
    # one entry per chunk and match, so the map is as long as the table has chunks
    rows = folded.groupBy("_key").agg(
        F.expr("max(_state._rows) AS _rows"), F.expr("map_from_entries(collect_list(struct(_pos, _state))) AS _chunks")
    )
    spread = rows.selectExpr("_key", "_rows", *[f"_chunks[{at}] AS _c{at}" for at in range(len(batches))])
    out = [named("_key", key)]
    for at, batch in enumerate(batches):
        for i, c in enumerate(batch):
            out += finish_moments(prefix, c, moments, i, f"_c{at}.")
    if with_count:
        out.append(named("_rows", f"{prefix}player_count"))
    return spread.selectExpr(*out)


def packed_chunks(batches: Sequence[Sequence[str]], prepare: Callable[[str], str] = "CAST({} AS double)".format) -> str:
    """An array with a struct x0, x1, ... per batch of columns, the last one padded with NULL."""
    width = len(batches[0])
    cells = [
        "struct("
        + ", ".join(named(prepare(tick(batch[i])) if i < len(batch) else "NULL", f"x{i}") for i in range(width))
        + ")"
        for batch in batches
    ]
    return f"array({', '.join(cells)})"


def roll_up(
    df: DataFrame,
    key: str = "ID",
    columns: Sequence[str] | None = None,
    *,
    prefix: str = "",
    moments: str = "sample",
    with_count: bool = True,
    strategy: str = "auto",
    chunk_size: int = CHUNK_SIZE,
) -> DataFrame:
    """Sum, mean and standard deviation of every numeric column per key, and the row count.

    Rows without a key are left out and the key is never itself a measure. All state is folded
    on the map side, so a key with very many rows costs no more than any other.
    """
    if moments not in MOMENTS:
        raise ValueError(f"moments must be one of {MOMENTS}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    columns = numeric_columns(df, [key]) if columns is None else [c for c in columns if c != key]
    known = project(df, [key, *columns]).where(quoted(key).isNotNull())
    if strategy == "auto":
        strategy = "direct" if len(columns) <= DIRECT_LIMIT else "chunked"
    if strategy == "direct" or not columns:
        return _direct(known, key, columns, prefix, moments, with_count)
    return _chunked(known, key, columns, prefix, moments, with_count, chunk_size)


def roll_up_mean_first(df: DataFrame, key: str = "ID", *, prefix: str = "", strategy: str = "auto") -> DataFrame:
    """Variant that lists mean, sum, std and leaves the row count out."""
    columns = numeric_columns(df, [key])
    rolled = roll_up(df, key, prefix=prefix, with_count=False, strategy=strategy)
    parts = [f"{prefix}{c}_{part}" for c in columns for part in ("mean", "sum", "std")]
    return project(rolled, [key, *parts])
