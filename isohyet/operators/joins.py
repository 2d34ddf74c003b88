"""Joins by order and by overlap, as equi-joins and windows: no side is compared with all of the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(moment: Column, days: int) -> Column:
    """The number of a stretch of so many days, by which a key's rows are split."""
    return F.floor(F.unix_timestamp(moment.cast("timestamp")) / (86_400 * days)).cast("long")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], moment: str, values: list[str], ties: list[str] | None = None, tolerance_days: float | None = None, bucket_days: int = 30) -> DataFrame:
    """Each row of left with the values of the last row of right of the same keys at or before its moment, or NULL.

    Of rows of right at one moment, the greatest by `ties` (the values, unless named) counts; beyond the tolerance none
    does. Both sides are stacked and dealt by key and stretch of days, so a key that holds half of all rows is many groups,
    and within each the last row is carried along one sort. What a stretch begins with comes from a table of the last rows of
    each stretch. NULL keys are equal to each other; a NULL moment meets nothing.
    """
    taken = {c.lower() for c in (*left.columns, *values)}

    def fresh(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        return name

    side, bucket, found, row, carried, at = (fresh(n) for n in ("side", "bucket", "found", "row", "carried", "at"))
    ties = values if ties is None else ties
    held = F.struct(F.col(moment).alias(at), *(F.col(c).alias(f"v{k}") for k, c in enumerate(values)))
    order = F.struct(*(F.col(c).alias(f"t{k}") for k, c in enumerate(ties)))
    marked = right.filter(F.col(moment).isNotNull()).select(*keys, F.col(moment), order.alias("order"), held.alias(found), F.lit(0).alias(side), _bucket(F.col(moment), bucket_days).alias(bucket), F.lit(None).alias(row))
    whole = F.struct(*(F.col(c) for c in left.columns))
    asked = left.select(*keys, F.col(moment), F.lit(None).alias("order"), F.lit(None).alias(found), F.lit(1).alias(side), _bucket(F.col(moment), bucket_days).alias(bucket), whole.alias(row))
    lasts = marked.groupBy(*keys, bucket).agg(F.max_by(found, F.struct(F.col(moment), F.col("order"))).alias(found))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    # a row for each stretch of a key in either side
    stretches = lasts.unionByName(asked.select(*keys, bucket).distinct().withColumn(found, F.lit(None)), allowMissingColumns=True).groupBy(*keys, bucket).agg(F.first(found, ignorenulls=True).alias(found))
    carry = stretches.select(*keys, bucket, F.last(found, ignorenulls=True).over(before).alias(carried))
    stacked = marked.withColumn(row, F.lit(None).cast(asked.schema[row].dataType)).unionByName(asked.withColumn("order", F.lit(None).cast(marked.schema["order"].dataType)).withColumn(found, F.lit(None).cast(marked.schema[found].dataType)))
    along = Window.partitionBy(*keys, bucket).orderBy(moment, side, "order").rowsBetween(Window.unboundedPreceding, 0)
    swept = stacked.withColumn(found, F.last(found, ignorenulls=True).over(along)).filter(F.col(side) == 1)
    same = F.lit(True)
    for k in [*keys, bucket]:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    met = swept.alias("l").join(carry.alias("r"), same, "left").select(F.col(f"l.{row}").alias(row), F.coalesce(F.col(f"l.{found}"), F.col(f"r.{carried}")).alias(found))
    near = F.lit(True) if tolerance_days is None else F.unix_timestamp(F.col(f"{row}.{moment}").cast("timestamp")) - F.unix_timestamp(F.col(f"{found}.{at}").cast("timestamp")) <= tolerance_days * 86_400
    known = F.col(f"{row}.{moment}").isNotNull() & near
    return met.select(f"{row}.*", *(F.when(known, F.col(f"{found}.v{k}")).alias(c) for k, c in enumerate(values)))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], bounds: tuple[str, str] = ("start", "end"), other_bounds: tuple[str, str] = ("from", "to"), bin_days: int = 30) -> DataFrame:
    """Pairs of intervals of days, ends included, that share a day: all columns of both, and days, how many they share.

    Intervals are told by the stretches of `bin_days` that they touch and meet by stretch and key; a pair is told in the
    first stretch that both touch, so once. Intervals with a NULL bound, or that end before they start, meet nothing. No
    column but the keys may have one name on both sides.
    """
    if clash := sorted(set(left.columns) & set(right.columns) - set(keys)):
        raise ValueError(f"columns of both sides: {clash}")
    (a, b), (c, d) = bounds, other_bounds
    number = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / bin_days)
    told = lambda df, low, high: df.filter(F.col(low) <= F.col(high)).withColumn("stretch", F.explode(F.sequence(number(F.col(low)), number(F.col(high)))))
    met = told(left, a, b).join(told(right, c, d), [*keys, "stretch"])
    first = F.greatest(number(F.col(a)), number(F.col(c)))
    shared = F.datediff(F.least(b, d), F.greatest(a, c)) + 1
    return met.filter((F.col("stretch") == first) & (F.col(a) <= F.col(d)) & (F.col(c) <= F.col(b))).withColumn("days", shared).drop("stretch")
