"""Tab-separated source tables (job S1).

Read rule: header row, tab separator, quoting off, every column text, no
``nullValue``: the ``\\N`` sentinel arrives as a two-character string and is
turned into NULL only where a numeric column is cast (``type_table``). The
``.gz`` files are not splittable; ``partitions`` spreads the rows after the
read (or convert once with ``to_parquet``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinespark.plans.catalog import TABLE_FILES, FilmTables, view_name

TSV_OPTIONS = {"sep": "\t", "header": "true", "quote": "", "inferSchema": "false",
               "mode": "FAILFAST", "enforceSchema": "false", "columnPruning": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: Column with a row's place in the source: file, block of the file, row; ordered as the rows stand there.
ORDINAL = "__ordinal"


def _header(spark: SparkSession, path: str) -> list[str]:
    head = spark.read.text(path).first()
    if head is None:
        raise ValueError(f"no header in {path}")
    return head[0].split("\t")


def _place():
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_raw_tsv(spark: SparkSession, path: str, partitions: int | None = None, columns: list[str] | None = None,
                 keep_bad_rows: bool = False, ordinal: bool = False) -> DataFrame:
    """One raw table, all columns text, names from the header of the first
    file (or ``columns``, for files without one). A file with another header
    is an error when it is read, and so is a row with more or fewer cells;
    with ``keep_bad_rows`` missing cells are NULL and cells too many are left
    out, as the reference keeps them (``tsv_rejects`` lists such rows).
    ``ordinal`` adds the place in the source."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or _header(spark, path)])
    options = dict(TSV_OPTIONS)
    if columns:
        options |= {"header": "false", "enforceSchema": "true"}
    if keep_bad_rows:
        options["mode"] = "PERMISSIVE"
    df = spark.read.options(**options).schema(schema).csv(path)
    if ordinal:
        df = df.withColumn(ORDINAL, _place())
    return df.repartition(partitions) if partitions else df


def tsv_rejects(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """(file, offset, n_cells, record): the rows with more or fewer cells than
    the header has (or ``columns``), with the byte at which each starts.

    The lines of a block of a file are numbered up within the block, and the
    sizes of the blocks before it are added; texts of good rows are not moved.
    """
    wanted = len(columns or _header(spark, path))
    lines = spark.read.option("lineSep", "\n").text(path).select("value", _place().alias("at"))
    cells = F.size(F.split("value", "\t"))
    lines = lines.select("at.file", "at.block", "at.row", (F.octet_length("value") + 1).alias("bytes"), cells.alias("n_cells"),
                         F.when((cells != wanted) & (F.col("value") != ""), F.col("value")).alias("record"))
    inside = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (lines.groupBy("file", "block").agg(F.sum("bytes").alias("bytes"))
             .select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")))
    bad = lines.withColumn("start", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).filter("record is not null")
    return bad.join(bases, ["file", "block"]).select("file", (F.col("base") + F.col("start")).alias("offset"), "n_cells", "record")


def read_tables(spark: SparkSession, path: str, names: list[str] | None = None,
                ext: str = "tsv.gz", partitions: int | None = None,
                register: bool = True, keep_bad_rows: bool = False, ordinal: bool = False) -> FilmTables:
    """Read ``{path}/{name}.{ext}`` for each name, type them, and register
    temp views named with '.' -> '_' (``title.akas`` -> ``title_akas``)."""
    raw = {view_name(n): read_raw_tsv(spark, f"{path.rstrip('/')}/{n}.{ext}", partitions, None, keep_bad_rows,
                                      ordinal and n == "name.basics")
           for n in (names or TABLE_FILES)}
    tables = FilmTables.from_raw(raw)
    if register:
        tables.register_views()
    return tables


#: Rows of a written file: a .gz file is read by one task, so long ones are parted.
FILE_ROWS = 1_000_000


def write_raw_tsv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write a raw (text) table in the same format, in files of at most FILE_ROWS rows."""
    (df.write.mode("overwrite").options(sep="\t", header="true", quote="", escape="",
                                        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
                                        compression=compression, maxRecordsPerFile=FILE_ROWS,
                                        **{"zlib.compress.level": "BEST_SPEED"}).csv(path))


def to_parquet(tables: FilmTables, path: str) -> dict[str, str]:
    """Convert typed tables to Parquet once; later runs read the columnar
    copy (splittable, pushed filters, pruned columns)."""
    out = {}
    for n, df in tables.as_dict().items():
        p = f"{path.rstrip('/')}/{n}"
        df.write.mode("overwrite").parquet(p)
        out[n] = p
    return out
