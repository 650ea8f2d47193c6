"""Windows over a few huge keys, cut into slices.

A stream's rows of one day share a key, so a plain window sorts a day in one task. Here rows are cut into slices
of the order column; each slice is worked on alone, one carry row a slice is combined over the key (a small
table), and the carry of earlier slices is joined back. Results don't depend on the slice width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

#: Default width of a slice, in units of the order column.
ARRIVALS, MICROS = 400_000, 3_600_000_000


def _cut(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn("_slice", F.floor(F.col(order) / F.lit(width)))


def by_range(df: DataFrame, order: list[Column]) -> DataFrame:
    """df by ranges of the order (about equal in rows, whatever the keys), each row with its range as slice.

    Written once: ranges come from a sample, and a range that is worked out again has to be the same one.
    """
    return staged(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "ranges")


def _carried(df: DataFrame, keys: list[str], carry: Column, combine) -> DataFrame:
    """(keys, _slice, _before): carries of all earlier slices, combined."""
    w = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return df.groupBy(*keys, "_slice").agg(carry.alias("_carry")).select(*keys, "_slice", combine(F.col("_carry")).over(w).alias("_before"))


def _joined(df: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    other = carried.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"), "_before")
    on = df["_slice"].eqNullSafe(other["_s"])
    for i, k in enumerate(keys):
        on &= df[k].eqNullSafe(other[f"_k{i}"])
    return df.join(other, on, "left").drop(*other.columns[:-1])


def previous(df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: int = ARRIVALS) -> DataFrame:
    """Adds the last non-null value of earlier rows of the key."""
    df = _cut(df, order, width).withColumn("_value", value)
    w = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carried(df, keys, F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))), lambda c: F.last(c, ignorenulls=True))
    out = _joined(df.withColumn("_local", F.last("_value", ignorenulls=True).over(w)), carried, keys)
    return out.withColumn(name, F.coalesce("_local", "_before")).drop("_local", "_before", "_value", "_slice")


def running_sum(df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: int = ARRIVALS) -> DataFrame:
    """Adds the sum of the value up to and with the row."""
    df = _cut(df, order, width).withColumn("_value", value)
    w = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = _joined(df.withColumn("_local", F.sum("_value").over(w)), _carried(df, keys, F.sum("_value"), F.sum), keys)
    return out.withColumn(name, F.coalesce("_local", F.lit(0)) + F.coalesce("_before", F.lit(0))).drop("_local", "_before", "_value", "_slice")


def running_max(df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: int = ARRIVALS) -> DataFrame:
    """Adds the largest value up to and with the row."""
    df = _cut(df, order, width).withColumn("_value", value)
    w = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = _joined(df.withColumn("_local", F.max("_value").over(w)), _carried(df, keys, F.max("_value"), F.max), keys)
    return out.withColumn(name, F.greatest("_local", "_before")).drop("_local", "_before", "_value", "_slice")


def running(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], befores: dict[str, Column], width: int = ARRIVALS) -> DataFrame:
    """Adds several columns in one pass: sums up to and with the row, and last non-null values of earlier rows."""
    cut = _cut(df, order, width).withColumns({f"_v{i}": v for i, v in enumerate([*sums.values(), *befores.values()])})
    added, last = range(len(sums)), range(len(sums), len(sums) + len(befores))
    w = Window.partitionBy(*keys, "_slice").orderBy(order)
    upto, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumns({f"_l{i}": F.sum(f"_v{i}").over(upto) for i in added} | {f"_l{i}": F.last(f"_v{i}", ignorenulls=True).over(earlier) for i in last})
    ends = cut.groupBy(*keys, "_slice").agg(*(F.sum(f"_v{i}").alias(f"_c{i}") for i in added), *(F.max_by(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), F.col(order))).alias(f"_c{i}") for i in last))
    w = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.struct(*(F.sum(f"_c{i}").over(w).alias(f"b{i}") for i in added), *(F.last(f"_c{i}", ignorenulls=True).over(w).alias(f"b{i}") for i in last))
    out = _joined(local, ends.select(*keys, "_slice", before.alias("_before")), keys)
    found = {n: F.coalesce(f"_l{i}", F.lit(0)) + F.coalesce(f"_before.b{i}", F.lit(0)) for i, n in zip(added, sums)} | {n: F.coalesce(f"_l{i}", f"_before.b{i}") for i, n in zip(last, befores)}
    return out.withColumns(found).drop("_before", "_slice", *(f"{k}{i}" for i in range(len(sums) + len(befores)) for k in ("_v", "_l")))


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Adds the row's place (from 1) in its key by the order, counted in ranges and moved on by the rows of earlier ranges."""
    cut = by_range(df, [*map(F.col, keys), *order])
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    out = _joined(cut.withColumn("_local", F.row_number().over(w)), _carried(cut, keys, F.count("*"), F.sum), keys)
    return out.withColumn(name, F.col("_local") + F.coalesce("_before", F.lit(0))).drop("_local", "_before", "_slice")


def run_steps(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds step (the row's place in its key by the order) and before (the value of the row before it), range by range.

    Keys may be many here, and so are the ends of ranges (one a key and range at least): they aren't broadcast.
    """
    cut = by_range(df, [F.col(c) for c in [*keys, *order]])
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    rows = cut.withColumns({"_local": F.row_number().over(w), "_lag": F.lag(value).over(w)})
    ends = cut.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"), F.max_by(value, F.struct(*order)).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.struct(F.sum("_n").over(earlier).alias("n"), F.last("_end").over(earlier).alias("end"))
    out = _joined(rows, ends.select(*keys, "_slice", carry.alias("_before")).hint("merge"), keys)
    first = F.col("_local") == 1
    out = out.withColumns({"step": F.col("_local") + F.coalesce("_before.n", F.lit(0)), "before": F.when(first, F.col("_before.end")).otherwise(F.col("_lag"))})
    return out.drop("_local", "_lag", "_before", "_slice")
