"""Ordered scans over long series in two levels.

A window partitioned by key puts a key's whole history into one task.  Here a series is cut into blocks of `width` along its
order column; windows run inside blocks, in parallel; each block leaves one row (its sum, its last value, its edge runs), and only
these are scanned by key and carried back to the block's rows.  A task holds a block of a series, or a row or two
for each of its blocks.  Choose `width` so that a block is well under a task's memory.

Keys may be null (a group of their own); rows whose order column is null form the first block.  Results equal those of plain windows, given
an order without ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"


def block_of(at: str, width: float) -> Column:
    return F.floor(F.col(at) / F.lit(width))


def _blocked(rows: DataFrame, at: str, width: float) -> DataFrame:
    return rows.withColumn(BLOCK, block_of(at, width))


def with_carry(rows: DataFrame, carry: DataFrame, on: list[str]) -> DataFrame:
    """rows with carry's columns; one row of carry for each value of `on`, nulls equal to each other."""
    right = carry.select(*[F.col(c).alias(f"_c_{c}") for c in on], *[c for c in carry.columns if c not in on])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    return rows.join(right, same, "left").drop(*[f"_c_{c}" for c in on])


def running_sum(rows: DataFrame, keys: list[str], at: str, value: Column, name: str, width: float, ties: list[str] = ()) -> DataFrame:
    """rows with `name`: the sum of value over a row and all rows before it in its key's order (at, then ties)."""
    own = _blocked(rows.withColumn("_v", value), at, width)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = own.groupBy(*keys, BLOCK).agg(F.sum("_v").alias("_s")).select(*keys, BLOCK, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    made = with_carry(own.withColumn("_r", F.sum("_v").over(inside)), carry, [*keys, BLOCK])
    return made.withColumn(name, F.coalesce("_r", F.lit(0)) + F.col("_before")).drop("_v", "_r", "_before", BLOCK)


def row_numbers(rows: DataFrame, keys: list[str], at: str, name: str, width: float, ties: list[str] = ()) -> DataFrame:
    """rows with `name`: 1 for a key's first row, and so on."""
    return running_sum(rows, keys, at, F.lit(1), name, width, ties).withColumn(name, F.col(name).cast("int"))


def previous(rows: DataFrame, keys: list[str], at: str, value: str, name: str, width: float, ties: list[str] = ()) -> DataFrame:
    """rows with `name`: value of the row before in its key's order, null for the first."""
    own = _blocked(rows, at, width)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(at, *ties)
    last = own.groupBy(*keys, BLOCK).agg(F.max_by(F.struct(value), F.struct(F.lit(0), at, *ties)).alias("_l"))
    carry = last.select(*keys, BLOCK, F.lag("_l").over(Window.partitionBy(*keys).orderBy(BLOCK)).alias("_before"))
    made = with_carry(own.withColumn("_p", F.lag(F.struct(value)).over(inside)), carry, [*keys, BLOCK])
    return made.withColumn(name, F.coalesce("_p", "_before")[value]).drop("_p", "_before", BLOCK)


def runs(rows: DataFrame, keys: list[str], at: str, flag: Column, width: float) -> DataFrame:
    """(keys, flag, lo, hi, begins, ends): the maximal stretches of rows with an equal flag (a null counts as false), by their first and last `at`.

    Runs inside a block are whole; a block's first and last run are joined with those of the blocks beside it.  A key's
    first run `begins` its series, its last one `ends` it.
    """
    own = _blocked(rows.select(*keys, at, F.coalesce(flag, F.lit(False)).alias("flag")), at, width)
    inside, block = Window.partitionBy(*keys, BLOCK).orderBy(at), Window.partitionBy(*keys, BLOCK)
    turned = lambda w: F.coalesce((F.col("flag") != F.lag("flag").over(w)).cast("int"), F.lit(0))
    own = own.withColumn("_c", turned(inside)).withColumn("_run", F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    by_run = own.groupBy(*keys, BLOCK, "_run").agg(F.first("flag").alias("flag"), F.min(at).alias("lo"), F.max(at).alias("hi"))
    by_run = by_run.withColumn("_edge", (F.col("_run") == 0) | (F.col("_run") == F.max("_run").over(block)))
    whole = by_run.filter(~F.col("_edge")).select(*keys, "flag", "lo", "hi", F.lit(False).alias("begins"), F.lit(False).alias("ends"))
    series = Window.partitionBy(*keys).orderBy(BLOCK, "_run")
    edges = by_run.filter("_edge").withColumn("_c", F.greatest(turned(series), F.coalesce(F.col(BLOCK).eqNullSafe(F.lag(BLOCK).over(series)) & F.lag("_run").over(series).isNotNull(), F.lit(False)).cast("int")))
    edges = edges.withColumn("_run", F.sum("_c").over(series.rowsBetween(Window.unboundedPreceding, 0)))
    joined = edges.groupBy(*keys, "_run").agg(F.first("flag").alias("flag"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    order = Window.partitionBy(*keys).orderBy("_run")
    joined = joined.select(*keys, "flag", "lo", "hi", (F.col("_run") == 0).alias("begins"), F.lead("_run").over(order).isNull().alias("ends"))
    return whole.unionByName(joined)


def peak_of_sum(rows: DataFrame, keys: list[str], at: str, value: Column, counted: Column, name: str, width: float, ties: list[Column] = ()) -> DataFrame:
    """(keys, name): the greatest running sum of value at rows where `counted` holds.  Only blocks' sums and peaks pass from level to level."""
    own = _blocked(rows.withColumn("_v", value).withColumn("_t", counted), at, width)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, 0)
    blocks = own.withColumn("_r", F.sum("_v").over(inside)).groupBy(*keys, BLOCK).agg(F.sum("_v").alias("_s"), F.max(F.when(F.col("_t"), F.col("_r"))).alias("_m"))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("_p", F.col("_m") + F.coalesce(F.sum("_s").over(before), F.lit(0))).groupBy(*keys).agg(F.max("_p").alias(name)).filter(F.col(name).isNotNull())


def last_rows(rows: DataFrame, keys: list[str], at: str, made: Column, name: str, last: int, width: float, ties: list[str] = (), most: int = 1 << 16) -> DataFrame:
    """rows with `name`: the aggregate `made` over a row and the up to last - 1 rows before it.

    Rows are numbered first; blocks are then of `most` rows each, and a block's last rows are also guests of the next.
    """
    reach = last - 1
    most = max(most, reach, 1)
    own = row_numbers(rows, keys, at, "_n", width, ties).withColumn("_n", F.col("_n") - 1)
    home = F.floor(F.col("_n") / most)
    own = own.withColumn("_b", F.explode(F.when(F.col("_n") % most >= most - reach, F.array(home, home + 1)).otherwise(F.array(home))))
    w = Window.partitionBy(*keys, "_b").orderBy("_n").rowsBetween(-reach, 0)
    return own.withColumn(name, made.over(w)).filter(F.col("_b") == home).drop("_n", "_b")
