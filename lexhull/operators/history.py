"""Change history of entities over ordered snapshots."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grows(df: DataFrame) -> DataFrame:
    """One side of a join as a table that grows with the input: joined by sorted partitions, never broadcast.

    The planner judges by the size of compressed files, of which the rows of a broadcast table take many times as much.
    """
    return df.hint("merge")


def snapshot_history(df: DataFrame, keys: list[str], seen: str, order: list[str] | None = None, first: list[str] = (), last: list[str] = (), last_non_null: list[str] = ()) -> DataFrame:
    """One row per key: first_seen, last_seen, and each attribute by its merge rule.

    first keeps an attribute as it was first written, last as it was last written, nulls
    included, last_non_null the last value that was not null. seen is the snapshot's number and
    order what tells rows of a snapshot apart (default: the snapshot alone). Null keys group
    together. All is one aggregation, partial on the map side, so a key with many snapshots
    sends one row per task.
    """
    at = F.struct(*(order or [seen]))
    aggs = [F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen")]
    if first:
        aggs.append(F.min_by(F.struct(*first), at).alias("_first"))
    if last:
        aggs.append(F.max_by(F.struct(*last), at).alias("_last"))
    # a null ordering value never wins, so rows with a null attribute fall out
    aggs += [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in last_non_null]
    out = df.groupBy(*keys).agg(*aggs)
    picked = [F.col(f"_first.{c}") for c in first] + [F.col(f"_last.{c}") for c in last]
    return out.select(*keys, "first_seen", "last_seen", *picked, *last_non_null)


def partial_history(df: DataFrame, keys: list[str], seen: str, order: list[str] | None = None, first: list[str] = (), last: list[str] = (), last_non_null: list[str] = ()) -> DataFrame:
    """The history of some snapshots as it can be merged with that of others: each value beside the place it was taken from.

    Arguments as in snapshot_history(). One row per key: first_seen, last_seen, _first and _last (place and attributes), and _kept_<attribute> (place and value).
    """
    at = F.struct(*(order or [seen])).alias("at")
    aggs = [F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen")]
    if first:
        aggs.append(F.min_by(F.struct(at, *first), at).alias("_first"))
    if last:
        aggs.append(F.max_by(F.struct(at, *last), at).alias("_last"))
    aggs += [F.max_by(F.when(F.col(c).isNotNull(), F.struct(at, c)), F.when(F.col(c).isNotNull(), at)).alias(f"_kept_{c}") for c in last_non_null]
    return df.groupBy(*keys).agg(*aggs)


def merged_history(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Partial histories of two sets of snapshots as one; the order of the two doesn't matter. Rows of the old ones are not read again, only what was kept of them."""
    rows = old.unionByName(new)
    picked = [F.min_by("_first", "_first.at").alias("_first")] if "_first" in old.columns else []
    picked += [F.max_by(c, f"{c}.at").alias(c) for c in old.columns if c == "_last" or c.startswith("_kept_")]
    return rows.groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), *picked).select(*old.columns)


def told_history(partial: DataFrame, keys: list[str], first: list[str] = (), last: list[str] = (), last_non_null: list[str] = ()) -> DataFrame:
    """What snapshot_history() gives, from a partial history of all snapshots."""
    picked = [F.col(f"_first.{c}") for c in first] + [F.col(f"_last.{c}") for c in last] + [F.col(f"_kept_{c}.{c}") for c in last_non_null]
    return partial.select(*keys, "first_seen", "last_seen", *picked)


#: Snapshots up to which their dates are held in a map.
MAPPED_SNAPSHOTS = 1000


def resolve_dates(df: DataFrame, extracts: DataFrame, **columns: str) -> DataFrame:
    """Adds release dates: each keyword names a new column and the snapshot id column it is looked up by.

    extracts is (extract_id, release_date), one row per snapshot file. Up to MAPPED_SNAPSHOTS, as many as
    make 80 years of months, their dates are one map that each column is looked up in, without a join; beyond, each column is joined.
    """
    listed = extracts.select("extract_id", "release_date").take(MAPPED_SNAPSHOTS + 1)
    if len(listed) <= MAPPED_SNAPSHOTS:
        dates = F.create_map(*[F.lit(x) for r in listed if r["extract_id"] is not None for x in (r["extract_id"], r["release_date"])]) if listed else F.create_map().cast("map<int,string>")
        return df.withColumns({new: F.try_element_at(dates, F.col(by).cast("int")) for new, by in columns.items()})
    for new, by in columns.items():
        df = df.join(extracts.select(F.col("extract_id").alias(by), F.col("release_date").alias(new)), by, "left")
    return df


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order; a struct minimum, no window and no sort."""
    named = [F.col(o).alias(f"_o{i}") if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*named)).alias("_row")).select(*keys, *[F.col(f"_row.{c}") for c in rest])


def union_first_wins(frames: list[DataFrame], keys: list[str], order: list[str] = ()) -> DataFrame:
    """Union by name where an earlier frame's row of a key wins; inside a frame, the first by order (default: all columns)."""
    out = None
    for i, frame in enumerate(frames):
        tagged = frame.withColumn("_rank", F.lit(i))
        out = tagged if out is None else out.unionByName(tagged)
    rest = [c for c in frames[0].columns if c not in keys]
    won = out.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("_rank", *(order or rest))).alias("_row"))
    return won.select(*keys, *[F.col(f"_row.{c}") for c in rest])


def latest_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Upsert: the last row of each key by order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, *[F.col(f"_row.{c}") for c in rest])


def unprocessed(df: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows whose key has not been processed, or all of them if forced."""
    return df if force else df.join(done.select(key).distinct(), key, "left_anti")


def replaced(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows, those of keys that come anew replaced by the new ones."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert(path: str, new: DataFrame, keys: list[str], order: list[str], buckets: int = 64) -> None:
    """Upsert into a Parquet table on disk: of the rows of a key, stored or new, the last by order stays.

    The table is parted by a hash bucket of its keys; only buckets that new rows fall in are read and rewritten,
    each as a whole, the files of the others stay as they are. A rerun with the same rows changes nothing in the table. buckets must
    stay the same for a table; a table that isn't there yet is made. A failed run leaves the table as it was.
    """
    spark = new.sparkSession
    # read twice, and must be the same both times
    fresh = bucketed(latest_wins(new, keys, order), keys, buckets).persist()
    touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # as many as there are buckets, at most
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    rows = fresh
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        old = spark.read.parquet(path).filter(F.col("_bucket").isin(touched))
        rows = latest_wins(old.select(*fresh.columns).unionByName(fresh), [*keys, "_bucket"], order).select(*fresh.columns)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)
    fresh.unpersist()
