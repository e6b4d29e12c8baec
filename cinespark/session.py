"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that matter for the plans in this package. AQE re-plans joins at
# runtime (broadcast when a side measures small, split skewed partitions) and
# coalesces small shuffle partitions; the skew split is forced even when it
# costs an extra shuffle, because one person or title may hold a large share
# of all credit rows.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Bloom filters of the ids on a join's small side prune scans of this size on
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ui.retainedExecutions": "100",
}


# Shuffle partitions of about this size, for an input of known size.
SHUFFLE_PARTITION_BYTES = 256 << 20


def shuffle_partitions_for(input_bytes: int) -> int:
    """Initial shuffle partitions for a run over ``input_bytes``: AQE only
    coalesces, so the start must be fine enough for the largest shuffle."""
    return max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cinespark", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's scale settings.

    On a cluster leave ``master`` unset (the cluster manager supplies it) and
    give ``shuffle_partitions_for(input bytes)``; without a number the
    session's own setting stays.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local master gets a fresh
    local folder (tests); any other master is an error, because executors
    would write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="cinespark-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/cinespark/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "table", sort_within: list[str] | None = None):
    """Write ``df`` as Parquet in the shared checkpoint folder and return a
    frame that reads it back.

    The lineage is cut (a lost executor costs a re-read, not a recompute),
    an intermediate used by several jobs is computed once, and unlike an RDD
    checkpoint the result keeps Parquet's pushed filters, column pruning and
    size statistics. ``sort_within`` orders rows inside each file so row
    group min/max statistics can skip data for filters on those columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A bucket may hold this many times its even share before rows are left unbucketed.
BUCKET_SKEW = 4


class StoredTogether:
    """Frames that are often joined on ``key``, written so that the join needs
    no shuffle: partitioned by ``partition_by`` (a filter on it lists only its
    folders) and bucketed and sorted by ``key``; ``names`` gives the columns
    of each frame to sort by after the key.

    A frame is made (``tables`` holds functions) and written when it is first
    asked for, so a job pays for the tables it reads only. It is read twice,
    so it should be a scan of something stored.

    Buckets cannot be split at run time as shuffled partitions can. So the
    largest number of rows of one key is measured first: where it is more
    than BUCKET_SKEW even shares of a bucket, a frame is only partitioned, and
    from then on the others are read as plain files too, so that AQE splits
    the hot key in the shuffle. A job that joins opens the frames that may
    hold one first.
    """

    def __init__(self, tables: dict[str, Callable], key: str, partition_by: str, names: dict[str, list[str]]):
        self._tables, self._key, self._partition_by, self._names = tables, key, partition_by, names
        self._plain, self._bucketed, self._even = {}, {}, True

    def __getitem__(self, name: str):
        if name not in self._plain:
            self._write(name)
        return self._bucketed[name] if self._even else self._plain[name]

    def _write(self, name: str):
        df, key = self._tables[name](), self._key
        spark = df.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows, most = df.groupBy(key).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
        path = scratch_path(spark, name)
        order = [key, *[c for c in self._names.get(name, []) if c != key]]
        if most <= max(1000, BUCKET_SKEW * rows // buckets):
            table = f"cinespark_{uuid.uuid4().hex}"
            (df.repartition(buckets, key).write.partitionBy(self._partition_by).bucketBy(buckets, key).sortBy(order[0], *order[1:])
             .option("path", path).saveAsTable(table))
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")  # its size, for broadcasts and Bloom filters
            self._bucketed[name] = spark.table(table).select(*df.columns)
        else:
            self._even = False
            df.sortWithinPartitions(self._partition_by, *order).write.partitionBy(self._partition_by).parquet(path)
        self._plain[name] = spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_together(tables: dict, key: str, partition_by: str, names: dict[str, list[str]]) -> dict:
    """``StoredTogether`` of frames, all written at once."""
    kept = StoredTogether({name: lambda df=df: df for name, df in tables.items()}, key, partition_by, names)
    for name in tables:
        kept[name]
    return {name: kept[name] for name in tables}


def input_version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files one or two levels below ``path``:
    a key under which results of the same input may be kept."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for st in fs.listStatus(root):
        found.append((st.getPath().getName(), st.getLen(), st.getModificationTime()))
        if st.isDirectory():
            found += [(x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in fs.listStatus(st.getPath())]
    return tuple(sorted(found))
