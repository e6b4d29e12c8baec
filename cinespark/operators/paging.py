"""Top-k, the page after a row, and any page by its number.

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
its own best n rows, and only those meet at the end, so no global sort of
the input happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinespark.operators.numbering import with_dense_index
from cinespark.session import scratch_path


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def page_after(df: DataFrame, order: list[tuple[str, bool]], size: int,
               after: dict | None = None) -> DataFrame:
    """The ``size`` rows that follow the row ``after`` under a total order.

    ``order`` lists (column, descending) of non-NULL columns; ``after`` holds
    the order columns of the last row of the page before (None: the first
    page). The filter is pushed to the scan, and every page costs the same.
    """
    if after is not None:
        later, same = F.lit(False), F.lit(True)
        for c, descending in order:
            value = F.lit(after[c])
            later = later | (same & ((F.col(c) < value) if descending else (F.col(c) > value)))
            same = same & (F.col(c) == value)
        df = df.filter(later)
    return df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in order]).limit(size)


class PageIndex:
    """Any page of an ordered table by its number, without the pages before it.

    The rows get their place in the order (``with_dense_index``) and are
    stored in folders of ``block_pages`` whole pages. A second small table
    counts the rows of each block by the ``facets`` (columns that filters may
    use). A plain page reads one folder. A filtered one adds up the counts to
    find the blocks that hold it (at most ``size``, mostly one) and reads only
    these: the join on the folder column prunes the others at run time.
    """

    ROW, BLOCK = "__row", "__block"

    def __init__(self, df: DataFrame, order: list[tuple[str, bool]], size: int, facets: list[str],
                 block_pages: int = 4000):
        self.size, self.columns, self.block_rows = size, df.columns, size * block_pages
        by = [F.col(c).desc() if d else F.col(c).asc() for c, d in order]
        spark = df.sparkSession
        path = scratch_path(spark, "pages")
        rows = with_dense_index(df, by, self.ROW)
        rows = rows.withColumn(self.BLOCK, F.floor(F.col(self.ROW) / self.block_rows).cast("long"))
        rows.write.partitionBy(self.BLOCK).parquet(f"{path}/rows")
        self.rows = spark.read.schema(rows.schema).parquet(f"{path}/rows")
        counts = self.rows.groupBy(self.BLOCK, *facets).agg(F.count(F.lit(1)).alias("__n"))
        counts.write.parquet(f"{path}/counts")
        self.counts = spark.read.schema(counts.schema).parquet(f"{path}/counts")

    def page(self, n: int, keep: Column | None = None) -> DataFrame:
        """The rows ``n * size`` to ``(n + 1) * size - 1`` of those that ``keep`` (over facet columns) lets through."""
        first, end = n * self.size, (n + 1) * self.size
        row, block = F.col(self.ROW), F.col(self.BLOCK)
        if keep is None:
            hit = self.rows.filter((block == first // self.block_rows) & (row >= first) & (row < end))
            return hit.orderBy(row).limit(self.size).select(*self.columns)
        before = Window.orderBy(self.BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        spans = (self.counts.filter(keep).groupBy(self.BLOCK).agg(F.sum("__n").alias("__n"))
                 .withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))))
        held = spans.filter((F.col("__base") < end) & (F.col("__base") + F.col("__n") > first))
        # a block that holds a row of the page: at most ``size`` of them
        hit = self.rows.filter(keep).join(F.broadcast(held.select(self.BLOCK, "__base")), self.BLOCK)
        place = F.col("__base") + F.row_number().over(Window.partitionBy(self.BLOCK).orderBy(self.ROW)) - 1
        hit = hit.withColumn("__place", place).filter((F.col("__place") >= first) & (F.col("__place") < end))
        return hit.orderBy(row).limit(self.size).select(*self.columns)
