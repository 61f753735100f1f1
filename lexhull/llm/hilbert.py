"""Sharding along a Hilbert curve, with DataFrame functions only.

Each metadata dimension is quantised by its own quantiles, the cells are ordered along the
Hilbert curve, and the order is cut into runs of equal length. Neighbours on the curve are
neighbours in every dimension, so the minimum and maximum of each shard are narrow and readers
skip shards by any of the dimensions.

Only narrow columns are sorted: a range exchange deals out the rows, each partition numbers its
own, and the small table of partition sizes turns these numbers into positions. The sorted rows
are materialised first, because a second run of the range exchange may draw other bounds.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import cut

BITS = 8


def curve_index(axes: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a cell, given its coordinates in 0..2**bits-1.

    The usual bitwise form: undo the excess turns from the highest bit down, Gray-encode,
    interleave. One fold over (bit, axis) pairs keeps the expression short.
    """
    n = len(axes)
    if n * bits > 63:
        raise ValueError("the index must fit in 63 bits")
    cell = F.array(*[a.cast("long") for a in axes])
    if n == 1:
        return F.element_at(cell, 1)

    def turn(x: Column, step: Column) -> Column:
        bit = F.lit(bits - 1) - F.floor(step / n)
        axis = (step % n).cast("int")
        ones = F.expr("1L")
        q = F.call_function("shiftleft", ones, bit.cast("int"))
        p = q - 1
        own = F.get(x, axis)
        first = F.get(x, F.lit(0))
        hit = own.bitwiseAND(q) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(p)
        return F.transform(x, lambda v, j: F.when((j == 0) & hit, v.bitwiseXOR(p)).when((~hit) & (axis != 0) & ((j == 0) | (j == axis)), v.bitwiseXOR(swap)).otherwise(v))

    # the lowest bit needs no turn (its mask below is empty)
    turned = F.aggregate(F.sequence(F.lit(0), F.lit((bits - 1) * n - 1)), cell, turn) if bits > 1 else cell

    def gray(x: Column, i: Column) -> Column:
        before = F.get(x, i - 1)
        return F.transform(x, lambda v, j: F.when(j == i, v.bitwiseXOR(before)).otherwise(v))

    coded = F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), turned, gray)

    def finish(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        one = F.expr("1L")

        def fold(t: Column, bit: Column) -> Column:
            q = F.call_function("shiftleft", one, bit.cast("int"))
            return F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)

        t = F.aggregate(F.sequence(F.lit(bits - 1), F.lit(1)), F.expr("0L"), fold) if bits > 1 else F.expr("0L")
        return F.transform(x, lambda v: v.bitwiseXOR(t))

    # binding the array once keeps it from being worked out for every bit
    done = F.transform(F.array(coded), finish)

    def interleave(x: Column) -> Column:
        def put(acc: Column, step: Column) -> Column:
            bit = (F.lit(bits - 1) - F.floor(step / n)).cast("int")
            return F.call_function("shiftleft", acc, F.lit(1)).bitwiseOR(F.call_function("shiftright", F.get(x, (step % n).cast("int")), bit).bitwiseAND(F.expr("1L")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(bits * n - 1)), F.expr("0L"), put)

    return F.transform(done, interleave)[0]


def as_number(field: T.StructField, col: Column) -> Column:
    """A double in the order of a column of numbers, dates or timestamps; NaN is null."""
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_timestamp(col).cast("double")
    number = col.cast("double")
    return F.when(~F.isnan(number), number)


def string_cuts(df: DataFrame, name: str, steps: int) -> list[str]:
    """Quantiles 1/steps, 2/steps, ... of a string column in its own order, whole strings compared; each once.

    Distinct values are counted, dealt out by range, and summed up; at most steps - 1 of them come back.
    """
    counted = df.filter(F.col(f"`{name}`").isNotNull()).groupBy(F.col(f"`{name}`").alias("v")).agg(F.count("*").alias("n"))
    counted = cut(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    before, everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    # one row for each partition, so this window is small at any input size
    parts = counted.groupBy("part").agg(F.sum("n").alias("own")).select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("earlier"), F.sum("own").over(everything).alias("total"))
    own = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counted.withColumn("upto", F.sum("n").over(own)).join(F.broadcast(parts), "part").withColumn("upto", F.col("upto") + F.col("earlier"))
    mark = F.expr(f"((upto - n) * {steps}) div total") + 1
    chosen = summed.filter((F.expr(f"(upto * {steps}) div total") >= mark) & (mark < steps))
    return sorted((r["v"] for r in chosen.select("v").collect()), key=lambda v: v.encode())


def spread_step(x: Column, cuts: list, largest: object, bits: int) -> Column:
    """The number of cuts below x, spread over 0..2**bits-1; 0 for null."""
    if not cuts:
        return F.lit(0)
    # the largest value lies on the last cut or above it
    top = len(cuts) if largest > cuts[-1] else len(cuts) - 1
    step = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda b: b < x))
    return F.floor(F.coalesce(step, F.lit(0)) * ((1 << bits) - 1) / max(top, 1))


def hilbert_shards(df: DataFrame, dims: list[str], tie: list[str], n_shards: int = 16, bits: int = BITS) -> DataFrame:
    """Input columns plus curve long, shard int and slot long.

    dims are numbers, dates or strings (whole strings, in their own order); each is quantised into
    2**bits steps by quantiles, approximate ones for numbers (2**bits - 1 cuts a dimension at most, so
    little reaches the driver), and fewer distinct steps are spread over the whole range, so that
    each dimension reaches the curve's high bits. Rows are ordered by curve index, then by the tie columns, which should tell rows apart; ordered rows fill the shards in
    runs whose sizes differ by one at most, slot being the place in the run.

    Nulls and NaN take the lowest step; rows equal in everything are interchangeable; with
    fewer rows than shards some shards stay empty; an empty table gives an empty table; input
    columns named curve, shard or slot are replaced.
    """
    kept = [c for c in df.columns if c.lower() not in ("curve", "shard", "slot")]
    kinds = {c: isinstance(df.schema[c].dataType, T.StringType) for c in dims}
    values = [F.col(f"`{c}`") if kinds[c] else as_number(df.schema[c], F.col(f"`{c}`")) for c in dims]
    marks = [i / (1 << bits) for i in range(1, 1 << bits)]
    stats = [F.max(x).alias(f"m{i}") for i, x in enumerate(values)]
    stats += [F.percentile_approx(x, marks, 1 << (bits + 4)).alias(f"b{i}") for i, (c, x) in enumerate(zip(dims, values)) if not kinds[c]]
    found = df.select(*stats).first()
    steps = [spread_step(x, string_cuts(df, c, 1 << bits) if kinds[c] else sorted(set(found[f"b{i}"] or [])), found[f"m{i}"], bits) for i, (c, x) in enumerate(zip(dims, values))]
    keyed = df.select(*[F.col(f"`{c}`") for c in kept], curve_index(steps, bits).alias("curve"))
    order = ["curve", *[F.col(f"`{c}`") for c in tie]]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    ranged = cut(ranged)
    part = F.shiftright("_place", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row for each partition of the exchange, so this window is small at any input size
    before, all_rows = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    summed = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(all_rows).alias("_total"))
    placed = ranged.withColumn("_part", part).join(F.broadcast(summed), "_part")
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.expr(f"{(1 << 33) - 1}L"))
    shard = F.expr(f"cast((_rank * {n_shards}) div _total as int)")
    return placed.withColumn("_rank", rank).withColumn("shard", shard).select(
        *[F.col(f"`{c}`") for c in kept], "curve", "shard", F.expr(f"_rank - (shard * _total + {n_shards - 1}) div {n_shards}").alias("slot")
    )
