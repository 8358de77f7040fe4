"""Helpers the operators share: Arrow batches over whole texts, stable folds and result columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from matchspark.session import workers_find_package

#: Fixed value: the characters between words are the space and U+0009 to U+000D, nothing else.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


class Numbered:
    """``df`` with its columns called by number (c0, c1, ...), so that no name of theirs clashes with a working column."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.df = df.toDF(*[f"c{i}" for i in range(len(self.names))])

    def __getitem__(self, name: str) -> str:
        lower = [c.lower() for c in self.names]
        return f"c{self.names.index(name) if name in self.names else lower.index(name.lower())}"

    def columns(self, leave: Iterable[str] = ()) -> list[Column]:
        """All columns under their own names, but for those called as in ``leave`` (upper or lower case)."""
        taken = {n.lower() for n in leave}
        return [F.col(f"c{i}").alias(n) for i, n in enumerate(self.names) if n.lower() not in taken]

    def back(self, out: DataFrame) -> DataFrame:
        return out.select(*self.columns())


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind)
    return _has_order(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def largest_row(df: DataFrame) -> Column:
    """Aggregate: the largest row as a struct; where a column's type has no order, the row whose JSON comes last."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return F.max(row) if _has_order(df.schema) else F.max_by(row, F.to_json(row))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def map_texts(
    df: DataFrame,
    text: str,
    results: list[tuple[str, str]],
    make: Callable[[], Callable[[list[str | None]], list]],
    keep_text: bool = False,
    chars_per_slice: int = 8_000_000,
) -> DataFrame:
    """Append result columns worked out from whole texts, batch by batch.

    ``make`` is called once per task and gives a function from texts to one list per result column.
    All other columns pass through; one that has the name of a result is replaced. Texts reach the
    function in slices of about ``chars_per_slice`` characters, so a batch of long texts stays bounded.
    """
    workers_find_package(df.sparkSession)
    taken = {n.lower() for n, _ in results}
    kept = [c for c in df.columns if c.lower() not in taken and (keep_text or c != text)]
    source = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").alias("text"))
    fields = [df.schema[c] for c in kept] + [T.StructField(n, T._parse_datatype_string(t), True) for n, t in results]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    arrow = to_arrow_schema(schema)
    n_kept = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = batch.column(n_kept)
            for start, stop in slices(texts, chars_per_slice):
                columns = work(texts.slice(start, stop - start).to_pylist())
                passed = [batch.column(i).slice(start, stop - start) for i in range(n_kept)]
                made = [pa.array(v, type=arrow.field(n_kept + i).type) for i, v in enumerate(columns)]
                cast = [a if a.type == f.type else a.cast(f.type) for a, f in zip(passed + made, arrow)]
                yield pa.RecordBatch.from_arrays(cast, schema=arrow)

    return source.mapInArrow(run, schema)


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``most`` bytes together."""
    import numpy as np
    import pyarrow.compute as pc

    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64"))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield start, stop
        start = stop
