"""Projections decided on column names and types; none of them touches the rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspark.functions.expressions import CLASS_NAMES
from matchspark.functions.text import finite_or_null, named, project, text_to_number, tick

# Name parts that mark a column as identifier-like (case-sensitive).
ID_LIKE_PARTS = ("MATCH", "GAME", "TEAM_ID", "PLAYER_ID", "LEAGUE_ID")

# Explicit identifier columns, and names tried in turn for the label key.
ID_COLUMNS = ("ID", "match_id", "MatchID")
KEY_CANDIDATES = ("id", "ID", "row_id", "match_id", "game_id", "MATCH_ID", "GAME_ID")


def quoted(name: str) -> Column:
    """A column by its exact name, also when it holds dots or spaces."""
    return F.col(tick(name))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def add_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ("ID",)) -> DataFrame:
    return df.selectExpr(*[tick(c) if c in keep else named(tick(c), prefix + c) for c in df.columns])


def key_first(df: DataFrame, key: str = "ID") -> DataFrame:
    return project(df, [key, *[c for c in df.columns if c != key]])


def numeric_only(df: DataFrame, key: str = "ID", as_float: bool = False) -> DataFrame:
    """The key, whatever its type, and every numeric column. The key is never narrowed."""
    cast = (lambda c: named(f"CAST({tick(c)} AS float)", c)) if as_float else tick
    head = [tick(key)] if key in df.columns else []
    return df.selectExpr(*head, *[cast(c) for c in numeric_columns(df, [key])])


def drop_text(train: DataFrame, *others: DataFrame, key: str = "ID") -> list[DataFrame]:
    """Drop from every table the columns that are text in ``train``."""
    names = text_columns(train, [key])
    return [df.drop(*[c for c in names if c in df.columns]) for df in (train, *others)]


def drop_id_like(df: DataFrame, drop: bool = True, parts: Sequence[str] = ID_LIKE_PARTS) -> DataFrame:
    """Drop the columns whose name holds one of ``parts``."""
    if not drop:
        return df
    return project(df, [c for c in df.columns if not any(p in c for p in parts)])


def drop_id_columns(df: DataFrame, names: Sequence[str] = ID_COLUMNS) -> DataFrame:
    return df.drop(*names)


def common_columns(train: DataFrame, test: DataFrame, key: str = "ID") -> tuple[DataFrame, DataFrame]:
    """Both tables on the key and their sorted common columns."""
    shared = [key, *sorted((set(train.columns) & set(test.columns)) - {key})]
    return project(train, shared), project(test, shared)


def match_features(df: DataFrame, features: Sequence[str], key: str | None = "ID") -> DataFrame:
    """Exactly ``features`` in their given (training) order; absent ones are 0.0."""
    have = set(df.columns)
    head = [tick(key)] if key and key in have else []
    return df.selectExpr(*head, *[tick(f) if f in have else named("0.0D", f) for f in features])


def reorder_like(df: DataFrame, template: Sequence[str], needed: Sequence[str] = ("ID", *CLASS_NAMES)) -> DataFrame:
    """Take over the template's column order, but only if it names all ``needed`` columns."""
    if not set(needed) <= set(template):
        return df
    return project(df, [c for c in template if c in df.columns])


def rename_key(df: DataFrame, target: str = "id", candidates: Sequence[str] = KEY_CANDIDATES) -> DataFrame:
    """Rename the first candidate found, else the first column, to ``target``."""
    found = next((c for c in candidates if c in df.columns), df.columns[0])
    return df.selectExpr(*[named(tick(c), target) if c == found else tick(c) for c in df.columns])


def label_roles(columns: Sequence[str]) -> dict[str, str]:
    """Which column holds home, draw and away, told by its name."""
    roles: dict[str, str] = {}
    for name in columns:
        low = name.lower()
        if "home" in low and "prob" not in low:
            roles["home"] = name
        elif "draw" in low:
            roles["draw"] = name
        elif "away" in low:
            roles["away"] = name
    absent = {"home", "draw", "away"} - set(roles)
    if absent:
        raise ValueError(f"no label column for {sorted(absent)} among {list(columns)}")
    return roles


def canonical_labels(df: DataFrame) -> DataFrame:
    """Any one-hot label table as ``id, home, draw, away``."""
    keyed = rename_key(df)
    roles = label_roles([c for c in keyed.columns if c != "id"])
    return keyed.select("id", *[quoted(roles[r]).alias(r) for r in ("home", "draw", "away")])


def find_key(*tables: DataFrame | None) -> str:
    """The common column that looks most like a match identifier; absent tables are skipped."""
    names = [set(t.columns) for t in tables if t is not None]
    shared = set.intersection(*names) if names else set()
    if not shared:
        raise ValueError("the tables have no column in common")

    # The weights of the two hints.
    def likeness(name: str) -> tuple[int, str]:
        low = name.lower()
        return 3 * ("game" in low or "match" in low) + 2 * ("id" in low), low

    return max(sorted(shared), key=likeness)


def forbid_columns(df: DataFrame, names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """Raise if a label column is among the features."""
    leaked = [c for c in df.columns if c in set(names)]
    if leaked:
        raise ValueError(f"label columns among the features: {leaked}")
    return df


def require_columns(df: DataFrame, names: Sequence[str], what: str = "table") -> DataFrame:
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks columns {absent}")
    return df


# -- cleaning -----------------------------------------------------------------------


def _as_double(field: T.StructField) -> str:
    c = tick(field.name)
    if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        return f"CAST({c} AS double)"
    if isinstance(field.dataType, T.StringType):
        return text_to_number(c)
    return "CAST(NULL AS double)"


def coerce_numeric(df: DataFrame, key: str = "ID") -> DataFrame:
    """Every column but the key as a double; what is no number becomes NULL."""
    return df.selectExpr(*[tick(f.name) if f.name == key else named(_as_double(f), f.name) for f in df.schema])


def clean_features(df: DataFrame, key: str = "ID", as_float: bool = True, fill: float | None = 0.0) -> DataFrame:
    """Coerce, narrow to float32, drop NaN and infinities, fill: one projection."""
    kind = "float" if as_float else "double"

    def cleaned(field: T.StructField) -> str:
        if field.name == key:
            return tick(key)
        # narrow first: a double too large for a float becomes infinite
        number = f"CAST({_as_double(field)} AS float)" if as_float else _as_double(field)
        known = finite_or_null(number)
        return named(known if fill is None else f"coalesce({known}, CAST({float(fill)}D AS {kind}))", field.name)

    return df.selectExpr(*[cleaned(f) for f in df.schema])
