"""Exact percentiles whose work is spread over tasks, also for one group that holds most rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraline import scratch

PART_ROWS = 250_000  # different values that one task sorts, about


def value_parts(values: DataFrame, column: str, parts: int) -> Column:
    """The part, from 0, of a value of `column`: about equal numbers of rows a part, cut at approximate quantiles (a job; at most `parts` numbers reach the driver)."""
    if parts < 2:
        return F.lit(0)
    cuts = sorted(set(values.select(F.col(column).cast("double").alias("v")).approxQuantile("v", [k / parts for k in range(1, parts)], 1 / (4 * parts))))
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(column))) if cuts else F.lit(0)


def with_percentiles(grouped: DataFrame, df: DataFrame, value: Column, quantiles: list[float], by: list[str] = [], parts: int | None = None) -> DataFrame:  # noqa: B006
    """grouped (a row for each value of `by`) with p: the exact percentiles of value over df, interpolated as `percentile` does; null without values.

    Values are counted first, at rest, so df is read once, and cut into parts by size, one for PART_ROWS of them. Only the parts in
    which a wanted rank falls are sorted, each for itself, so no task holds a group's distinct values. Nulls don't count, NaN is the
    largest value, a null key is a group. Counting is a job while the plan is built.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], value.cast("double").alias("__v")).where("__v is not null")
    n = scratch.at_rest(rows.groupBy(*keys, "__v").agg(F.count("*").alias("__c")), "value-counts")
    parts = parts or min(1024, 1 + n.count() // PART_ROWS)
    n = n.withColumn("__p", value_parts(n, "__v", parts))
    whole = Window.partitionBy(*keys).orderBy("__p")  # a row a part
    sums = n.groupBy(*keys, "__p").agg(F.sum("__c").alias("__s"))
    sums = sums.withColumns({"__b": F.sum("__s").over(whole) - F.col("__s"), "__n": F.sum("__s").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    at = [(F.col("__n") - 1) * q for q in quantiles]
    ranks = [(F.floor(x), F.ceil(x)) for x in at]
    wanted = reduce(lambda a, b: a | b, [(r >= F.col("__b")) & (r < F.col("__b") + F.col("__s")) for pair in ranks for r in pair])
    few = sums.where(wanted).select(*[F.col(c).alias(f"{c}_") for c in [*keys, "__p"]], "__b", "__n")
    near = n.join(few, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in [*keys, "__p"]]))
    near = near.withColumn("__e", F.col("__b") + F.sum("__c").over(Window.partitionBy(*keys, "__p").orderBy("__v")))
    value_at = lambda r: F.max(F.when((r < F.col("__e")) & (r >= F.col("__e") - F.col("__c")), F.col("__v")))
    got = near.groupBy(*keys).agg(F.max("__n").alias("__n"), *[value_at(r).alias(f"__{side}{i}") for i, pair in enumerate(ranks) for side, r in zip("lh", pair, strict=True)])
    between = [F.when(F.col(f"__l{i}") == F.col(f"__h{i}"), F.col(f"__l{i}")).otherwise((high - x) * F.col(f"__l{i}") + (x - low) * F.col(f"__h{i}")) for i, (x, (low, high)) in enumerate(zip(at, ranks, strict=True))]
    got = got.select(*keys, F.array(*between).alias("p"))
    if not by:
        return grouped.crossJoin(F.broadcast(got))  # one row
    return grouped.join(got, reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys, strict=True)]), "left").drop(*keys)
