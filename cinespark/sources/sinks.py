"""Mart sinks (job S4) and the decimal-comma read-back (job S5).

The reference writes its marts as CSV with a decimal comma (``6.92`` is
``"6,92"``), -9999 in every missing cell, and a running index column. Here:
numbers become decimal-comma text in Spark, NULL becomes -9999 only at the
sink, and ``index_by`` writes the running index as the first column (numbered
in two passes, no single task). Large marts are written partitioned, in index
order; ``single_file`` coalesces small statistics to one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.functions.columns import decimal_comma_text, decimal_comma_to_double
from cinespark.operators.numbering import with_dense_index
from cinespark.plans.marts import fill_missing

#: A quote is doubled and blanks stay, as CSV readers elsewhere expect.
CSV_FORMAT = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}


def to_csv_text(df: DataFrame, decimal_comma: bool = True, fill: bool = True) -> DataFrame:
    """Every column as the text the CSV file holds."""
    if fill:
        df = fill_missing(df)
    out = []
    for f in df.schema.fields:
        if decimal_comma and f.dataType.typeName() in ("double", "float", "decimal"):
            out.append(decimal_comma_text(f.name).alias(f.name))
        else:
            out.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*out)


def csv_sink(df: DataFrame, path: str, sep: str = ",", decimal_comma: bool = True,
             fill: bool = True, single_file: bool = False, encoding: str = "UTF-8",
             sort_within: list[str] | None = None, index_by: list[str] | None = None,
             index_name: str = "index") -> None:
    """Write a mart as CSV with a header. ``sep=';'`` is the ML file format.

    ``index_by`` adds the 0-based running index as the first column, under
    the order of these columns and then of all others; equal rows follow one
    another.
    """
    if index_by is not None:
        order = [F.col(c).asc_nulls_last() for c in [*index_by, *[c for c in df.columns if c not in index_by]]]
        df = with_dense_index(df, order, index_name).select(index_name, *df.columns)
    text = to_csv_text(df, decimal_comma, fill)
    if single_file:
        text = text.coalesce(1)
    if sort_within:
        text = text.sortWithinPartitions(*sort_within)
    (text.write.mode("overwrite")
     .options(sep=sep, encoding=encoding, **CSV_FORMAT)
     .csv(path))


def parquet_sink(df: DataFrame, path: str, range_key: str | None = None,
                 partitions: int | None = None) -> None:
    """Write a mart as Parquet; ``range_key`` range-partitions and sorts
    within partitions, giving globally ordered files without a single task."""
    if range_key:
        df = (df.repartitionByRange(partitions, range_key) if partitions
              else df.repartitionByRange(range_key)).sortWithinPartitions(range_key)
    df.write.mode("overwrite").parquet(path)


def read_csv_text(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV mart back as all-text columns."""
    return spark.read.options(sep=sep, inferSchema="false", multiLine="true", **CSV_FORMAT).csv(path)


#: A number as the CSV files write it.
NUMBER = r"^[+-]?\d+([.,]\d+)?([eE][+-]?\d+)?$"


def numeric_columns_of(df: DataFrame) -> list[str]:
    """The text columns that hold numbers: a cell at least, and no other text.

    One aggregate with two counts a column, merged from the tasks' counts.
    """
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    if not text:
        return []
    cell = {c: F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")) for c in text}
    counts = df.agg(*[F.count(cell[c]).alias(f"n{k}") for k, c in enumerate(text)],
                    *[F.count_if(~cell[c].rlike(NUMBER)).alias(f"t{k}") for k, c in enumerate(text)]).first()
    return [c for k, c in enumerate(text) if counts[f"n{k}"] and not counts[f"t{k}"]]


def decimal_comma_cast(df: DataFrame, numeric_columns: list[str] | None = None) -> DataFrame:
    """',' -> '.' and cast to double, in the listed columns only, or without
    a list in every column that holds numbers alone (repair: the reference
    replaced commas in every text cell, genre lists too)."""
    if numeric_columns is None:
        numeric_columns = numeric_columns_of(df)
    return df.select(*[decimal_comma_to_double(c).alias(c) if c in numeric_columns
                       else F.col(c) for c in df.columns])
