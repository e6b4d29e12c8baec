"""Operator 13, mixing sources to target weights.

Sizes (words) are summed by source. Sources in code point order, null last, weigh WEIGHTS in turn and share
the size of all documents; a target stops at CAP times its source's size, and the excess is shared again by
weight until none is above. A source's rate is its target over its size: each document is emitted floor(rate)
times, and once more where its hash-seeded Bernoulli draw with the fraction as probability says so. The draws
of a source come from one of SEEDS hash seeds, each of them a full set of independent draws; the one whose
copies come nearest to the target is taken, so that a few long documents do not move the mix. Hashes are of
doc_id and text, so reruns agree.

Documents are read for their sizes and never shuffled for the sums (partial aggregates, one row a source and
task). Sharing runs over a stored table of sources; each round brings three sums to the driver. The table of
rates is broadcast up to BROADCAST_SOURCES sources (it is counted); beyond, documents meet it in a salted join.

Defined results: null and empty texts have size 0; a source without words has target 0 and none of its
documents is taken; repeated rows draw alike; null doc_ids draw by their text; an empty table gives no rows;
other columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm.common import free_name, stored, table
from cinespark.operators.numbering import with_dense_index
from cinespark.operators.salting import salted_join

WEIGHTS = (1, 2, 3)
CAP = 3
SEEDS = 128
BROADCAST_SOURCES = 100_000


def words(text: str | Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hashed(docs: DataFrame, *carried: Column) -> DataFrame:
    """The carried columns, the key of the source (text and null flag), size, and two 32-bit hashes of each document."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    half = lambda at: F.conv(F.substring("digest", at, 8), 16, 10).cast("long")
    return docs.select(*carried, F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("unnamed"),
                       words("text").alias("size"), digest.alias("digest")).select(
        "*", half(1).alias("a"), half(9).alias("b")).drop("digest")


def _draw(k: int | Column, fraction: Column) -> Column:
    """The Bernoulli draw of a document under seed ``k``."""
    return F.pmod(F.col("a") + F.lit(k) * F.col("b"), F.lit(1 << 32)) < fraction * float(1 << 32)


def shared_targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to rows (weight, size) of sources, whose total size is shared by weight under the cap."""
    fair = lambda left, weights: F.lit(float(left)) * F.col("weight") / F.lit(float(weights or 1))
    total = sources.agg(F.sum("size"), F.sum("weight")).first()
    left, weights, capped = total[0] or 0, total[1] or 0, -1
    while True:
        above = fair(left, weights) > CAP * F.col("size")
        n, held, free = sources.agg(F.count_if(above), F.sum(F.when(above, CAP * F.col("size"))), F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped:
            break
        capped, left, weights = n, (total[0] or 0) - (held or 0), free or 0
    return sources.withColumn("target", F.when(above, (CAP * F.col("size")).cast("double")).otherwise(fair(left, weights)))


def source_rates(hashed: DataFrame) -> DataFrame:
    """(name, unnamed, source_size, target, times, fraction, seed) of every source."""
    sums = hashed.groupBy("name", "unnamed").agg(F.sum("size").alias("size"))
    numbered = with_dense_index(sums, ["unnamed", "name"], "place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    rates = shared_targets(stored(numbered.withColumn("weight", weight)))
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    rates = stored(rates.select("name", "unnamed", F.col("size").alias("source_size"), "target",
                                F.floor(rate).cast("int").alias("times"), (rate - F.floor(rate)).alias("fraction")))
    drawn = _join(hashed, rates).groupBy("name", "unnamed").agg(F.array(*[
        F.sum(F.when(_draw(k, F.col("fraction")), F.col("size")).otherwise(0)) for k in range(SEEDS)]).alias("drawn"))
    aim = F.col("target") - F.col("times") * F.col("source_size")
    best = F.array_min(F.transform("drawn", lambda x, k: F.struct(F.abs(x - aim).alias("off"), k.alias("k"))))
    return stored(rates.join(drawn, ["name", "unnamed"]).withColumn("seed", best["k"]).drop("drawn"))


def _join(hashed: DataFrame, rates: DataFrame) -> DataFrame:
    keys = ["name", "unnamed"]
    if rates.count() <= BROADCAST_SOURCES:
        return hashed.join(F.broadcast(rates), keys)
    return salted_join(hashed, rates, keys)


def _copies() -> Column:
    return F.col("times") + _draw(F.col("seed"), F.col("fraction")).cast("int")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, with all its columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rates = source_rates(stored(_hashed(docs)))
    taken = _join(_hashed(docs, row), rates).select("row", _copies().alias("copies")).filter("copies > 0")
    copy = free_name("copy", docs.columns)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(copy)).select("row.*")


def op13_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hashed = stored(_hashed(docs, F.col("doc_id")))
    out = _join(hashed, source_rates(hashed)).withColumn("copies", _copies())
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


#: The same rows; the capped sources are a prefix of those in order of size over weight.
ORACLE = rf"""
WITH h AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
       md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', md5(coalesce(text, '')))) AS digest FROM documents),
d AS (SELECT doc_id, source, size, CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS a, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS b FROM h),
s AS (SELECT source, sum(size)::BIGINT AS size, [{", ".join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(WEIGHTS)} + 1] AS weight
      FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER by_ratio AS k,
             coalesce(sum({CAP} * size) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(weight) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
      FROM s WINDOW by_ratio AS (ORDER BY size / weight, source)),
f AS (SELECT *, CAST((SELECT sum(size) FROM s) - held AS DOUBLE) AS rest FROM o),
cut AS (SELECT k, rest, free FROM f WHERE NOT rest * weight / CAST(free AS DOUBLE) > {CAP} * size ORDER BY k LIMIT 1),
t AS (SELECT f.source, f.size, CASE WHEN f.k < cut.k THEN CAST({CAP} * f.size AS DOUBLE) ELSE cut.rest * f.weight / CAST(cut.free AS DOUBLE) END AS target
      FROM f, cut),
r AS (SELECT *, CASE WHEN size > 0 THEN target / size ELSE 0.0 END AS rate FROM t),
q AS (SELECT source, size AS source_size, target, CAST(floor(rate) AS INTEGER) AS times, rate - floor(rate) AS fraction FROM r),
w AS (SELECT q.source, i, abs(sum(CASE WHEN (a + i * b) % 4294967296 < fraction * 4294967296.0 THEN d.size ELSE 0 END) - (any_value(target) - any_value(times) * any_value(source_size))) AS off
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source, range({SEEDS}) AS seeds(i) GROUP BY q.source, i),
best AS (SELECT source, i, row_number() OVER (PARTITION BY source ORDER BY off, i) AS place FROM w)
SELECT d.doc_id, d.size, q.source_size, q.target, d.size * (times + CAST((a + best.i * b) % 4294967296 < fraction * 4294967296.0 AS INTEGER)) AS taken,
       times + CAST((a + best.i * b) % 4294967296 < fraction * 4294967296.0 AS INTEGER) AS copies
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source JOIN best ON best.source IS NOT DISTINCT FROM q.source AND best.place = 1"""
