"""CSV and parquet in, file discovery, tables and reports out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspark.functions.expressions import CLASS_NAMES
from matchspark.functions.text import NUMBER_PATTERN, literal, matches, named, nan_to_null, project, text_to_number, tick
from matchspark.operators.columns import numeric_only, require_columns
from matchspark.operators.profile import column_measures, schema_summary

# Texts that mean "missing" in a CSV field.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The four raw tables of a split, by the part of the file name that tells them.
SIDES = ("home_team", "away_team", "home_player", "away_player")

INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
TRUTH_PATTERN = r"^(?:True|TRUE|true|False|FALSE|false)$"


MISSING = ", ".join(literal(text) for text in MISSING_TEXTS)


def _known_text(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({MISSING}) THEN {c} END"


def known_texts(texts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns of a table of texts, missing texts as NULL."""
    return texts.selectExpr(*[named(_known_text(tick(c)), c) for c in names])


def _typed(text: str, kind: T.DataType) -> str:
    name = kind.simpleString()
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return f"CASE WHEN {matches(text, TRUTH_PATTERN)} THEN try_cast({text} AS boolean) END"
    if isinstance(kind, T.NumericType):
        number = text_to_number(text, name)
        return nan_to_null(number) if isinstance(kind, (T.DoubleType, T.FloatType)) else number
    return f"try_cast({text} AS {name})"


# A quote inside a quoted field is written twice; spaces at the ends of a field are part of it.
CSV_DIALECT = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _as_texts(spark: SparkSession, path: str | Sequence[str], usecols: Sequence[str] | None, multiline: bool = False) -> DataFrame:
    raw = spark.read.options(**CSV_DIALECT, multiLine=multiline).csv(path, inferSchema=False)
    if usecols is None:
        return raw
    require_columns(raw, usecols, "CSV file")
    wanted = set(usecols)
    return project(raw, [c for c in raw.columns if c in wanted])


# What a known text is, told once per cell: the lower ones are the stricter.
WHOLE, NUMBER, TRUTH, TEXT = range(4)


def _shape(c: str) -> str:
    """The shape of a known text, NULL for a missing one. No cast is tried on a text that isn't matched: failed ones are dear."""
    return (
        f"CASE WHEN {c} IS NULL THEN NULL "
        # a long that overflows is a number, not an integer
        f"WHEN {matches(c, INTEGER_PATTERN)} AND try_cast({c} AS bigint) IS NOT NULL THEN {WHOLE} "
        f"WHEN {matches(c, NUMBER_PATTERN)} THEN {NUMBER} "
        f"WHEN {c} >= 'F' AND {c} < 'u' AND {matches(c, TRUTH_PATTERN)} THEN {TRUTH} ELSE {TEXT} END"
    )


def infer_types(texts: DataFrame) -> T.StructType:
    """Integer, number, truth value or text per column, from all known values of it."""
    # a row per cell, so that the generated code tells one cell whatever the width, and stays small enough to be compiled
    cells = texts.selectExpr(f"posexplode(array({', '.join(map(tick, texts.columns))})) AS (_pos, _cell)")
    shapes = cells.selectExpr("_pos", f"{_known_text('_cell')} AS _cell").selectExpr("_pos", f"{_shape('_cell')} AS _shape")
    found = {r["_pos"]: (r["low"], r["high"]) for r in shapes.groupBy("_pos").agg(F.min("_shape").alias("low"), F.max("_shape").alias("high")).collect()}

    def kind(at: int) -> T.DataType:
        low, high = found.get(at, (None, None))
        if high in (None, NUMBER):
            return T.DoubleType()
        if high == WHOLE:
            return T.LongType()
        return T.BooleanType() if low == high == TRUTH else T.StringType()

    return T.StructType([T.StructField(c, kind(at)) for at, c in enumerate(texts.columns)])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    usecols: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """A CSV table with a header. Missing texts and NaN become NULL.

    Without ``schema`` one pass over all rows decides the types; with it there is none, and a
    value that does not fit its type becomes NULL. ``multiline`` reads fields with line breaks
    inside quotes; such a file cannot be split, so a large table should come in several files.
    """
    texts = _as_texts(spark, path, usecols, multiline)
    kinds = {f.name: f.dataType for f in (schema or infer_types(texts))}
    return typed_texts(texts, T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in texts.columns]))


def sampled_schema(
    spark: SparkSession, path: str, key: str = "ID", rows: int = 2000, numeric: bool = True, multiline: bool = False
) -> T.StructType:
    """Columns by the first rows only, every number column as double; with ``numeric`` the key and the numbers.

    The key keeps a type that all rows fit. This saves the pass over all rows where the columns are
    known to be alike throughout; ``misfits`` tells afterwards whether they were.
    """
    texts = require_columns(_as_texts(spark, path, None, multiline), (key,), "CSV file")
    kinds = infer_types(texts.limit(rows))
    whole_key = infer_types(project(texts, [key]))[key].dataType
    fields = []
    for f in kinds:
        if f.name == key:
            fields.append(T.StructField(key, whole_key))
        elif isinstance(f.dataType, T.NumericType):
            fields.append(T.StructField(f.name, T.DoubleType()))
        elif not numeric:
            fields.append(f)
    return T.StructType(fields)


def typed_texts(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` from a table of texts, as :func:`read_csv` types them."""
    return known_texts(texts, schema.names).selectExpr(*[named(_typed(tick(f.name), f.dataType), f.name) for f in schema])


def checked_texts(texts: DataFrame, schema: T.StructType) -> tuple[DataFrame, dict[str, str]]:
    """As :func:`typed_texts`, with a column more per column, and per column SQL that is true where a known text didn't fit its type."""
    typed = [named(_typed(tick(f.name), f.dataType), f.name) for f in schema]
    known = {f.name: f"_known_{i}" for i, f in enumerate(schema)}
    flags = {c: f"({name} AND {tick(c)} IS NULL)" for c, name in known.items()}
    return known_texts(texts, schema.names).selectExpr(*typed, *[f"{tick(c)} IS NOT NULL AS {name}" for c, name in known.items()]), flags


def misfits(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """``feature, n_misfits``: known texts of each column that its type in ``schema`` turns into NULL."""
    checked, flags = checked_texts(_as_texts(spark, path, schema.names, multiline), schema)
    lost = [named(f"CAST({flag} AS int)", c) for c, flag in flags.items()]
    return column_measures(checked.selectExpr(*lost), schema.names, {"n_misfits": "coalesce(sum({}), 0)"}, prepare="{}")


def read_player_csv(
    spark: SparkSession, path: str, key: str = "ID", rows: int | None = None, multiline: bool = False
) -> DataFrame:
    """Key and numeric columns, typed by all rows.

    ``rows`` is the opt-in to choose the columns by the first rows only; later misfits become NULL.
    """
    if rows is None:
        whole = require_columns(read_csv(spark, path, multiline=multiline), (key,), "CSV file")
        return numeric_only(whole, key)
    schema = sampled_schema(spark, path, key, rows, multiline=multiline)
    return read_csv(spark, path, schema.names, schema, multiline)


def read_table(spark: SparkSession, path: str, usecols: Sequence[str] | None = None, where: str | None = None) -> DataFrame:
    """A parquet table with NaN turned to NULL.

    ``where`` filters the stored columns, before that, so that it reaches the scan.
    """
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    if usecols is not None:
        df = project(require_columns(df, usecols, path), usecols)
    fractional = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.selectExpr(*[named(nan_to_null(tick(c)), c) if c in fractional else tick(c) for c in df.columns])


# -- discovery ------------------------------------------------------------------------


def list_tables(spark: SparkSession, folder: str, token: str, suffix: str = ".csv") -> DataFrame:
    """Paths below ``folder`` whose own name holds ``token`` and ends in ``suffix``.

    A table is one file, or a folder of part files as Spark writes it. No file is opened.
    """
    name = rf"[^/]*\Q{token}\E[^/]*\Q{suffix}\E"
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.col("path").alias("file"))
    )
    table = F.regexp_extract("file", rf"^(.*/{name})(?:/[^/]+)?$", 1)
    return files.select(table.alias("path")).where("path <> ''").distinct()


def discover_file(spark: SparkSession, folder: str, token: str, suffix: str = ".csv") -> str | None:
    """The first such path in folder order, None if there is none."""
    try:
        first = list_tables(spark, folder, token, suffix).orderBy(F.split("path", "/")).first()
    except AnalysisException:
        return None
    return first["path"] if first else None


def discover_split(spark: SparkSession, folder: str | None) -> dict[str, str | None]:
    return {side: discover_file(spark, folder, side) if folder else None for side in SIDES}


def discover_inputs(spark: SparkSession, train_dir: str | None, test_dir: str | None) -> dict[str, str | None]:
    """The eight raw tables, e.g. ``train_home_team``; None for those not found."""
    return {
        f"{split}_{side}": path
        for split, folder in (("train", train_dir), ("test", test_dir))
        for side, path in discover_split(spark, folder).items()
    }


def require_teams(inputs: dict[str, str | None]) -> dict[str, str | None]:
    absent = [f"{s}_{side}" for s in ("train", "test") for side in SIDES[:2] if not inputs.get(f"{s}_{side}")]
    if absent:
        raise FileNotFoundError(f"required team tables not found: {absent}")
    return inputs


def read_optional(spark: SparkSession, folder: str, token: str) -> DataFrame | None:
    """The table of the first matching file, or None without one."""
    path = discover_file(spark, folder, token)
    return None if path is None else read_csv(spark, path)


# -- labels ---------------------------------------------------------------------------


def label_table(df: DataFrame) -> DataFrame:
    return require_columns(df, ("ID", *CLASS_NAMES), "label table").select("ID", *CLASS_NAMES)


def goal_difference_table(df: DataFrame) -> DataFrame:
    names = ("ID", "GOAL_DIFF_HOME_AWAY")
    return require_columns(df, names, "goal difference table").select(*names)


def read_labels(spark: SparkSession, path: str | None, multiline: bool = False) -> DataFrame | None:
    return None if not path else label_table(read_csv(spark, path, multiline=multiline))


def read_goal_differences(spark: SparkSession, path: str | None, multiline: bool = False) -> DataFrame | None:
    return None if not path else goal_difference_table(read_csv(spark, path, multiline=multiline))


# -- sinks ----------------------------------------------------------------------------


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sort_by: str | None = None, partitions: int | None = None) -> str:
    """Write once. ``sort_by`` orders the whole output by ranges of that column."""
    if sort_by and partitions:
        df = df.repartitionByRange(partitions, sort_by).sortWithinPartitions(sort_by)
    elif sort_by:
        df = df.orderBy(sort_by)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(**CSV_DIALECT)
    writer.format(fmt).save(path)
    return path


def read_written(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table that ``write_table`` wrote, with the types it had."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_DIALECT, multiLine=True)
    return reader.format(fmt).load(path)


def write_merged(train: DataFrame, test: DataFrame, out_dir: str, fmt: str = "parquet", key: str = "ID") -> dict[str, str]:
    """Both merged tables and their schema summary. The summary reads what was written."""
    paths = {
        "train": write_table(train, f"{out_dir}/train_merged", fmt, key),
        "test": write_table(test, f"{out_dir}/test_merged", fmt, key),
    }
    spark = train.sparkSession
    written = {name: read_written(spark, paths[name], df.schema, fmt) for name, df in (("train", train), ("test", test))}
    paths["schema"] = write_report(schema_summary(written), f"{out_dir}/schema")
    return paths


def write_report(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A small report (metrics, importances, scenarios, summaries) as one file."""
    return write_table(df.coalesce(1), path, fmt)


def write_submission(df: DataFrame, path: str) -> str:
    return write_table(df, path, "csv")
