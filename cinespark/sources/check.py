"""Completeness of the inputs (job S2).

The reference only proceeds when every required file is present. Here the
check is a small table: one row per required table, whether it is present
and how many rows it has. Counts are plain aggregates (Parquet answers
them from footers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from cinespark.plans.catalog import TABLE_FILES, view_name

REQUIRED = [view_name(n) for n in TABLE_FILES]


def source_check(spark: SparkSession, tables: dict[str, DataFrame | None],
                 required: list[str] | None = None) -> DataFrame:
    """``table_name, present, n_rows`` for each required table name."""
    required = required or REQUIRED
    counts = None
    for name in required:
        df = tables.get(name)
        if df is None:
            continue
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows")
        counts = c if counts is None else counts.unionByName(c)
    names = spark.createDataFrame([(n,) for n in required], "table_name string")
    if counts is None:
        return names.select("table_name", F.lit(False).alias("present"),
                            F.lit(None).cast("bigint").alias("n_rows"))
    # both sides hold one row per required name
    return (names.join(F.broadcast(counts), "table_name", "left")
            .select("table_name", F.col("n_rows").isNotNull().alias("present"), "n_rows"))


def source_check_path(spark: SparkSession, path: str, ext: str = "tsv.gz",
                      names: list[str] | None = None) -> DataFrame:
    """The same check for files ``{path}/{name}.{ext}``; a missing file
    gives ``present = false``."""
    from cinespark.sources.tsv import read_raw_tsv

    found = {}
    for n in names or TABLE_FILES:
        try:
            found[view_name(n)] = read_raw_tsv(spark, f"{path.rstrip('/')}/{n}.{ext}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            found[view_name(n)] = None
    return source_check(spark, found, [view_name(n) for n in names or TABLE_FILES])
