"""Readers and writers of the corpus formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from pairloom.functions.text import sentence_line
from pairloom.operators.numbering import number_chunked
from pairloom.operators.rows import open_list
from pairloom.session import materialize
from pairloom.sources.routing import BROKEN, Routed, route


_BROKEN = "_broken"


def read_json_lines(spark: SparkSession, path: str, schema: str, columns: Sequence[str] | None = None) -> DataFrame:
    """JSON lines, plain or compressed, by path or glob; only the named columns are decoded."""
    df = spark.read.schema(schema).json(path)
    return df.select(*columns) if columns else df


def scan_json_lines(spark: SparkSession, path: str, schema: str, required: Sequence[str] = ()) -> Routed:
    """JSON lines, plain or compressed, read once; lines that are no record of the schema are rejected with their text.

    ``broken``: the line is no JSON object, or a field does not have its type. ``missing_<column>``: a required field is missing or null.
    Blank lines are no records.
    """
    fields = spark.createDataFrame([], schema).columns
    lines = spark.read.text(path).select(F.col("value").alias("_line")).where(F.trim("_line") != "")
    parsed = lines.withColumn("_json", F.from_json("_line", f"{schema}, {_BROKEN} string", {"columnNameOfCorruptRecord": _BROKEN}))
    opened = parsed.select("_line", F.col("_json").isNull().alias("_no_json"), "_json.*")
    reasons = {BROKEN: F.col("_no_json") | F.col(_BROKEN).isNotNull()} | {f"missing_{c}": F.col(c).isNull() for c in required}
    return route(opened, reasons, fields, "_line", "json-lines")


def write_lines(lines: DataFrame, path: str, compression: str = "none") -> None:
    """One text column as lines."""
    lines.write.text(path, compression=compression)


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.json(path, compression=compression)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array of records. Such a file is one task: convert it to a table once."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_json_arrays(df: DataFrame, path: str, bucket: Column) -> None:
    """One file per bucket, holding one JSON array; a bucket must be bounded, as one task writes it."""
    records = df.groupBy(bucket.alias("file_no")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    records.write.partitionBy("file_no").text(path)


def _as_cells(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that any flat format can hold them; a text's line breaks as ``\\n`` and ``\\r``."""
    nested = (ArrayType, MapType, StructType)

    def cell(f: StructField) -> Column:
        if isinstance(f.dataType, nested):
            return F.to_json(f.name).alias(f.name)
        return _one_line(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)

    return df.select(*[cell(f) for f in df.schema])


def _swap(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _one_line(text: Column) -> Column:
    return _swap(text, ("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0"))


def _lines_again(text: Column) -> Column:
    """Between two escaped backslashes every other backslash begins the escape of a line break or a NUL."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: _swap(p, ("\\n", "\n"), ("\\r", "\r"), ("\\0", "\x00"))), "\\")


# Blanks stay, and an empty text ("") is told apart from a missing one (nothing).
_CSV = {
    "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    _as_cells(df).write.csv(path, header=True, **_CSV)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """CSV whose cells may hold lists or maps as JSON text; cells are decoded by schema, never evaluated.

    Files of ``write_csv`` have one line per row and are split between tasks. ``multi_line`` reads files from elsewhere
    whose quoted cells may hold line breaks: one task per file, and no line breaks are decoded.
    """
    declared = spark.createDataFrame([], schema).schema
    flat = StructType([StructField(f.name, StringType() if isinstance(f.dataType, _NESTED) else f.dataType) for f in declared])
    rows = spark.read.schema(flat).csv(path, header=True, multiLine=multi_line, **_CSV_BACK)
    return rows.select(*[_cell(f, multi_line) for f in declared])


_NESTED = (ArrayType, MapType, StructType)
_CSV_BACK = _CSV | {"emptyValue": "", "nullValue": "\x00"}  # the reader's mark of nothing must differ from an empty text


def _cell(f: StructField, multi_line: bool) -> Column:
    if isinstance(f.dataType, _NESTED):
        return F.from_json(f.name, f.dataType.simpleString()).alias(f.name)
    return _lines_again(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) and not multi_line else F.col(f.name)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str) -> Routed:
    """CSV of ``write_csv`` with bad rows rejected: ``broken`` rows have too few or too many cells, ``bad_<column>`` ones a cell that is no value of its type."""
    declared = spark.createDataFrame([], schema).schema
    text = StructType([StructField(f.name, StringType()) for f in declared] + [StructField(_BROKEN, StringType())])
    raw = spark.read.schema(text).csv(path, header=True, columnNameOfCorruptRecord=_BROKEN, **_CSV_BACK)
    staged = raw.withColumn("_line", F.coalesce(_BROKEN, F.to_json(F.struct(*declared.names))))

    def value(f: StructField) -> Column:
        if isinstance(f.dataType, StringType | ArrayType | MapType | StructType):
            return _cell(f, False)
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    typed = staged.select("_line", F.col(_BROKEN).isNotNull().alias("_bad"), *[F.col(f.name).isNotNull().alias(f"_given_{f.name}") for f in declared], *map(value, declared))
    reasons = {BROKEN: F.col("_bad")} | {f"bad_{f.name}": F.col(f"_given_{f.name}") & F.col(f.name).isNull() for f in declared}
    return route(typed, reasons, declared.names, "_line", "csv")


def read_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Text lines with ``line_no`` from 1, files in the order of the part numbers in their names, then of their names.

    The lines of a split come in order within its task, so a line's number is the lines of earlier
    splits plus its place. Places are written once with the lines; only a row per split is shuffled.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias(name),
        F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("bigint").alias("_part"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_mark"),
    )
    return number_chunked(materialize(lines, "lines"), "line_no", keys=("_part", "_file", "_split"), place="_mark")


def pair_lines(left: DataFrame, right: DataFrame) -> DataFrame:
    """Line i of one with line i of the other; the shorter one ends it."""
    return left.join(right, "line_no")


def read_parallel_lines(spark: SparkSession, intents: str, snippets: str) -> DataFrame:
    return pair_lines(read_lines(spark, intents, "intent"), read_lines(spark, snippets, "snippet"))


def write_sentences(df: DataFrame, tokens: str, path: str) -> None:
    """One token list per line, between sentence markers."""
    df.select(sentence_line(tokens).alias("value")).write.text(path)


def write_tokens(df: DataFrame, tokens: str, path: str) -> None:
    """One token per line."""
    open_list(df, tokens, item="value").select("value").write.text(path)


def write_results(errors: DataFrame, path: str, run: Sequence[str] = ("dataset", "model", "beam")) -> None:
    """Error table in one folder per run, the run's parameters in the folder names.

    A run that is written again replaces its own folder and leaves those of other runs alone; rows of several runs may come at once.
    """
    errors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*run).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


# One reader per corpus kind; an unknown kind is an error.
READERS = {
    "json_lines": read_json_lines,
    "json_array": read_json_array,
    "csv": read_csv,
    "parallel_lines": read_parallel_lines,
}


def read_corpus(spark: SparkSession, kind: str, *args: str) -> DataFrame:
    if kind not in READERS:
        raise ValueError(f"unknown corpus kind {kind!r}; known: {', '.join(sorted(READERS))}")
    return READERS[kind](spark, *args)
