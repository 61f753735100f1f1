"""Small helpers over sessions and DataFrames."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexhull.sources.tables import cut, shared_folder  # noqa: F401

#: A key is hot when it holds one row in HOT or more, so there are at most HOT such keys.
HOT = 1024


def spread_join(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with a table that holds each key once; hot lists the keys (HOT at most) that rows hold too often to meet in one task."""
    own = table.join(F.broadcast(hot.select(key)), key, "left_semi").withColumn("_hot", F.lit(True))
    met = rows.join(F.broadcast(own), key, "left")
    known = met.filter("_hot").drop("_hot")
    rest = met.filter("_hot is null").select(*rows.columns).join(table, key, how)
    return known.unionByName(rest)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str, text_col: str) -> Column:
    """With the id, tells rows apart whose ids are repeated over different texts."""
    return F.xxhash64(F.col(text_col))


def ascii_lower(text: Column) -> Column:
    """A-Z only, as the contracts of the operators have it."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that a result column would clash with, blind to case as Spark is."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def hash_sample(df: DataFrame, id_col: str, rows: int, n: int) -> DataFrame:
    """About the `rows` rows of smallest id hash out of n, and never more.

    A share of the hashes that holds a few more rows is kept first, so that what is sorted has
    that size too and doesn't grow with the number of tasks.
    """
    place = F.xxhash64(id_col).bitwiseAND((1 << 31) - 1)
    share = min(1.0, (rows + 6 * rows**0.5 + 16) / max(n, 1))
    return df.withColumn("_place", place).filter(F.col("_place") < int(share * (1 << 31)) + 1).orderBy("_place", *[c for c in df.columns]).limit(rows).drop("_place")
