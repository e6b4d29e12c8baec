"""Film-shaped raw tables derived from the test star schema.

The driver's test data is a sales star schema (part, lineitem, orders,
customer, supplier, nation, region). The derivation below gives the five film
tables in their raw all-text form, with the ``\\N`` sentinel where the source
files would have it, so every job runs on data whose volume grows with the
scale factor. The same derivation is written as SQL CTEs for the DuckDB
oracle (``cinespark.oracles``).

Scale notes: ``title_principals`` is lineitem joined to orders on the order
key (a shuffle join of the two largest tables); ``title_akas`` joins lineitem
to supplier, and supplier to nation and region, which the TPC-H spec fixes at
25 and 5 rows, so only those two are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.functions.columns import SENTINEL


def _id(prefix: str, key) -> F.Column:
    """At least seven digits; longer keys stay whole, so ids never merge."""
    text = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(7), F.length(text)), F.lit("0")))


def _sentinel():
    return F.lit(SENTINEL)


def title_basics(part: DataFrame) -> DataFrame:
    k, name, size = F.col("p_partkey"), F.col("p_name"), F.col("p_size")
    spaced = F.replace(name, F.lit(" "), F.lit(","))
    return part.select(
        _id("tt", k).alias("tconst"),
        F.when(F.col("p_type") == "MEDIUM", "tvEpisode")
         .when(F.col("p_type") == "PROMO", "short")
         .when(F.col("p_type") == "STANDARD", "tvSeries")
         .otherwise("movie").alias("titleType"),
        name.alias("primaryTitle"),
        F.concat(F.col("p_brand"), F.lit(" "), name).alias("originalTitle"),
        F.when(k % 41 == 0, "1").otherwise("0").alias("isAdult"),
        F.when(k % 29 == 0, _sentinel())
         .otherwise((F.lit(1920) + (k * 7) % 100).cast("string")).alias("startYear"),
        F.when(k % 23 == 0, _sentinel()).otherwise((size * 8).cast("string")).alias("runtimeMinutes"),
        F.when(k % 31 == 0, _sentinel())
         .when(k % 3 == 0, F.split_part(name, F.lit(" "), F.lit(2)))
         .when(k % 3 == 1, spaced)
         .when(k % 47 == 0, F.concat(F.lit("Adult,"), spaced))
         .otherwise(F.concat(spaced, F.lit(","),
                             F.when(size < 25, "News").otherwise("Sci-Fi"))).alias("genres"),
    )


def title_ratings(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    # every fifth rating belongs to a title that the catalogue does not have
    return part.select(
        F.when(k % 5 == 0, _id("tx", k)).otherwise(_id("tt", k)).alias("tconst"),
        ((F.lit(10) + (k * 13) % 91).cast("double") / 10).cast("string").alias("averageRating"),
        (F.lit(5) + (k * 37) % 5000).cast("string").alias("numVotes"),
    )


def title_akas(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
               region: DataFrame) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size by the TPC-H spec.
    geo = nation.select("n_nationkey", "n_regionkey").join(
        F.broadcast(region.select("r_regionkey", "r_name")),
        F.col("n_regionkey") == F.col("r_regionkey"))
    supp = supplier.select("s_suppkey", "s_nationkey").join(
        F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
    r = F.col("r_name")
    return (lineitem.select("l_partkey", "l_suppkey")
            .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(_id("tt", F.col("l_partkey")).alias("titleId"),
                    F.when(r == "EUROPE", "FR").when(r == "AMERICA", "US")
                     .when(r == "ASIA", "JP").otherwise(_sentinel()).alias("region")))


def title_principals(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    n = F.col("l_linenumber")
    category = (F.when(n == 1, "director").when(n == 2, "actor").when(n == 3, "actor")
                .when(n == 4, "actress").when(n == 5, "actress").when(n == 6, "writer")
                .otherwise("producer"))
    return (lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
            .join(orders.select("o_orderkey", "o_custkey"),
                  F.col("l_orderkey") == F.col("o_orderkey"))
            .select(_id("tt", F.col("l_partkey")).alias("tconst"),
                    _id("nm", F.col("o_custkey")).alias("nconst"),
                    category.alias("category")))


def name_basics(customer: DataFrame) -> DataFrame:
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    return customer.select(
        _id("nm", k).alias("nconst"),
        F.concat(F.lit("Person "), F.floor(k / 2).cast("string")).alias("primaryName"),
        F.when(k % 19 == 0, _sentinel())
         .otherwise((F.lit(1880) + k % 110).cast("string")).alias("birthYear"),
        F.when(k % 3 == 0, (F.lit(1940) + k % 80).cast("string"))
         .otherwise(_sentinel()).alias("deathYear"),
        F.when(seg == "HOUSEHOLD", "actor,miscellaneous")
         .when(seg == "BUILDING", "cinematographer")
         .when(seg == "MACHINERY", _sentinel())
         .otherwise("actor,director").alias("primaryProfession"),
    )


def read_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ["part", "lineitem", "orders", "customer", "supplier", "nation", "region"]
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def raw_film_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw (all-text) film tables, keyed by view name."""
    s = read_star(spark, sf_dir)
    return {
        "title_basics": title_basics(s["part"]),
        "title_ratings": title_ratings(s["part"]),
        "title_akas": title_akas(s["lineitem"], s["supplier"], s["nation"], s["region"]),
        "title_principals": title_principals(s["lineitem"], s["orders"]),
        "name_basics": name_basics(s["customer"]),
    }
