
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from veilspark import constants as K
from veilspark.operators.cells import _named
from veilspark.sources.records import csv_records, lines_of, quotes_in
from veilspark.sources.stage import stage_path, staged

EXTRA = "__extra"
BROADCAST_BLOCKS = 500_000
_NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|inf|Inf|INF|infinity|Infinity)\s*$"


class InputError(ValueError):
    """The input table cannot be processed."""


@dataclass(frozen=True)
class TableInfo:
    n_rows: int
    n_columns: int


def _csv_options(multi_line: bool) -> dict:
    return {
        "header": True, "multiLine": multi_line, "quote": '"', "escape": '"',
        "mode": "PERMISSIVE", "enforceSchema": True, "nullValue": "", "emptyValue": "",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        "maxCharsPerColumn": -1,
    }


def has_quoted_newlines(spark: SparkSession, path: str) -> bool:
    """Can a record of this file span lines?  (A line with an odd number of quotes.)"""
    return not lines_of(spark, path).filter(quotes_in(F.col("value")) % 2 == 1).isEmpty()


def _fresh(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read_csv(
    spark: SparkSession, path: str, multi_line: bool | None = None, place: str | None = None
) -> DataFrame:
    """A CSV table with every column as text and missing-value tokens as NULL.

    Short rows are padded with NULL.  The sentinel column ``__extra`` is not NULL
    where a row has more fields than the header; ``validate_input`` and
    ``refuse_ragged`` turn that into an error.  Files are split over tasks whether or
    not their cells hold line breaks: without any, line by line; otherwise by records
    (``csv_records``).  With ``place``, a column of that name tells file, block and
    place of every row.
    """
    if multi_line is None:
        multi_line = has_quoted_newlines(spark, path)
    header = spark.read.options(**_csv_options(multi_line)).csv(path).columns
    if not header:
        raise InputError("CSV file is empty")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, EXTRA]])
    if not multi_line:
        lines = spark.read.options(**_csv_options(False)).schema(schema).csv(path)
        if place is None:
            return lines
        at = F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
        return lines.select("*", at.alias(place))
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _csv_options(False).items()}
    del options["header"], options["enforceSchema"], options["multiLine"]
    parsed = csv_records(spark, path).select(
        F.from_csv("record", _ddl(schema), options).alias("r"),
        F.struct("file", "block", "place").alias("at"),
    )
    return parsed.select(
        *[F.col("r").getField(c).alias(c) for c in schema.names], *([F.col("at").alias(place)] if place else [])
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)


def _known(name: str) -> Column:
    c = _named(name)
    return F.when(~c.isin(K.NA_TOKENS), c).alias(name)


def refuse_ragged(df: DataFrame) -> DataFrame:
    """Drop the sentinel column; a task that meets a row with extra fields fails."""
    if EXTRA not in df.columns:
        return df
    columns = [c for c in df.columns if c != EXTRA]
    first = columns[0]
    checked = F.when(
        _named(EXTRA).isNotNull(), F.raise_error(F.lit("CSV row has more fields than the header"))
    ).otherwise(_named(first))
    return df.select(checked.alias(first), *[_named(c) for c in columns[1:]])


def text_like_columns(df: DataFrame) -> list[str]:
    """Columns of an all-string table that hold text: not all numbers, not all
    booleans, not all missing.  A boolean column with gaps counts as text."""
    bounds = []
    for i, name in enumerate(df.columns):
        c = _named(name)
        number = F.rlike(c, F.lit(_NUMBER))
        bounds += [
            F.count(c).alias(f"n{i}"),
            F.count_if(number).alias(f"num{i}"),
            F.count_if(c.isin(K.BOOL_TOKENS)).alias(f"bool{i}"),
        ]
    seen = df.agg(F.count("*").alias("rows"), *bounds).first()
    text = []
    for i, name in enumerate(df.columns):
        n = seen[f"n{i}"]
        if n and n != seen[f"num{i}"] and not (n == seen[f"bool{i}"] == seen["rows"]):
            text.append(name)
    return text


def with_row_id(
    df: DataFrame, name: str = "row_id", place: str = "_at", stage: str | None = None
) -> DataFrame:
    """Number the rows of a frame of ``read_csv`` (with ``place``) 0..N-1 in file order.

    The rows are staged with the file block they came from (block borders may
    change from one read to the next, a written table does not), counted per
    block, and each row adds its place in its block to the count of the blocks
    before.  There is one count per block, so the window and the broadcast stay
    small; the broadcast is checked all the same.
    """
    rest = [c for c in df.columns if c != place]
    placed = staged(
        df.select(F.struct(*[_named(c) for c in rest]).alias("row"), f"{place}.*"),
        stage or stage_path(df.sparkSession),
    )
    blocks = placed.groupBy("file", "block").agg(
        F.count("*").alias("n"), F.min("place").alias("first")
    )
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    if blocks.count() <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    number = F.col("base") + F.col("place") - F.col("first")
    return placed.join(offsets, ["file", "block"]).select(
        number.alias(name), *[F.col("row").getField(c).alias(c) for c in rest]
    )


def load_csv(
    spark: SparkSession,
    path: str,
    multi_line: bool | None = None,
    key: str | None = None,
    stage: str | None = None,
) -> tuple[DataFrame, str, list[str]]:
    """A CSV table ready for analysis: the frame, its key and its text columns.

    Without ``key`` the row position is the key, in a column ``row_id`` (with
    underscores in front where the file has that name itself).  A ``key`` that the
    file does not have is an error.
    """
    place = "\x01at"
    raw = read_csv(spark, path, multi_line, place)
    columns = [c for c in raw.columns if c not in (EXTRA, place)]
    if key is None:
        key = _fresh("row_id", columns)
        table = refuse_ragged(with_row_id(raw, key, place, stage))
    elif key in columns:
        table = refuse_ragged(raw.drop(place))
    else:
        raise InputError(f"unknown key column: {key}")
    names = [c for c in columns if c != key]
    clean = table.select(_named(key), *[_known(c) for c in names])
    return clean, key, text_like_columns(clean.select(*[_named(c) for c in names]))


def source_format(path: str) -> str:
    """The source format by file name; Parquet when the name tells nothing."""
    known = re.search(r"\.(csv|json|parquet|orc)/?$", path)
    return known[1] if known else "parquet"


def read_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Any Spark source; CSV goes through the rules above."""
    fmt = fmt or source_format(path)
    if fmt == "csv":
        return refuse_ragged(read_csv(spark, path))
    return spark.read.format(fmt).load(path)


def input_size(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path``; raises when nothing is there."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        raise InputError(f"CSV file not found: {path}") from e
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def validate_input(
    spark: SparkSession, path: str, max_mb: float | None = None, csv_only: bool = False
) -> TableInfo:
    """Existence, optional size limit, emptiness and ragged CSV rows.

    Returns row and column counts, from one aggregation.
    """
    if csv_only and not path.endswith(".csv"):
        raise InputError("Only CSV files are supported")
    size_mb = input_size(spark, path) / (1024 * 1024)
    if max_mb is not None and size_mb > max_mb:
        raise InputError(f"File too large: {size_mb:.2f}MB (max {max_mb:g}MB)")
    csv = source_format(path) == "csv"
    table = read_csv(spark, path) if csv else read_table(spark, path)
    extra = F.count(EXTRA) if csv else F.lit(0)
    seen = table.agg(F.count("*").alias("rows"), extra.alias("extra")).first()
    if seen["rows"] == 0:
        raise InputError("CSV file is empty")
    if seen["extra"]:
        raise InputError(f"{seen['extra']} CSV rows have more fields than the header")
    return TableInfo(seen["rows"], len(table.columns) - (1 if csv else 0))


def write_masked(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """The masked table, with a header and outer spaces kept when CSV."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(
            header=True, quote='"', escape='"', emptyValue="", nullValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(path)
    else:
        writer.format(fmt).save(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan that comes in fewer partitions than cores one per core.

    Detection is all CPU; a small or single-block file would keep one core busy.
    A large input has more splits than cores and is left as it is, and so is a
    frame that already shuffles (asking for its partitions would run it).
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "AdaptiveSparkPlan" in plan:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, _named(key)) if df.rdd.getNumPartitions() < cores else df
