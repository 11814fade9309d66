"""Coverage, row loss, profiles, comparison metrics and rankings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraline import scratch
from terraline.operators.quantiles import with_percentiles


def compare_stage_counts(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows per key before and after (0 where missing), rows lost and percent lost."""
    b, a = before.groupBy(key).agg(F.count("*").alias("before_rows")), after.groupBy(key).agg(F.count("*").alias("after_rows"))
    out = b.join(a, key, "full_outer").select(key, F.coalesce("before_rows", F.lit(0)).alias("before_rows"), F.coalesce("after_rows", F.lit(0)).alias("after_rows"))
    return with_loss(out)


def with_loss(counts: DataFrame) -> DataFrame:
    lost = F.greatest(F.lit(0), F.col("before_rows") - F.col("after_rows"))
    return counts.withColumn("lost_rows", lost).withColumn("loss_pct", F.when(F.col("before_rows") > 0, 100.0 * lost / F.col("before_rows")).otherwise(F.lit(0.0)))


def global_loss(counts: DataFrame) -> DataFrame:
    return with_loss(counts.agg(F.sum("before_rows").alias("before_rows"), F.sum("after_rows").alias("after_rows")))


def coverage(raw: DataFrame, stages: dict[str, DataFrame], key: str) -> DataFrame:
    """Every raw key with files and rows of each stage, and whether the stage has it."""
    out = raw
    for name, df in stages.items():
        got = df.groupBy(key).agg(F.count("*").alias(f"{name}_rows"))
        out = out.join(got, key, "left").withColumn(f"{name}_rows", F.coalesce(f"{name}_rows", F.lit(0))).withColumn(f"has_{name}", F.col(f"{name}_rows") > 0)
    return out


def coverage_summary(cov: DataFrame, stages: list[str], by: str | None = None) -> DataFrame:
    """Keys, covered keys and percent of each stage; with `by` for each value and (null) over all."""
    aggs = [F.count("*").alias("keys")]
    for s in stages:
        n = F.sum(F.col(f"has_{s}").cast("long"))
        aggs += [n.alias(f"with_{s}"), F.coalesce(100.0 * n / F.count("*"), F.lit(0.0)).alias(f"pct_{s}")]
    return (cov.rollup(by) if by else cov.groupBy()).agg(*aggs)


def attribution(processed: DataFrame, gps: DataFrame, imu: DataFrame, key: str) -> DataFrame:
    """Rows of three sources by key, what the smaller source allows, what overlap loses, and the source that limits."""
    out = gps.groupBy(key).agg(F.count("*").alias("gps_rows")).join(imu.groupBy(key).agg(F.count("*").alias("imu_rows")), key, "full_outer").join(processed.groupBy(key).agg(F.count("*").alias("out_rows")), key, "full_outer")
    g, i, o = (F.coalesce(c, F.lit(0)) for c in ("gps_rows", "imu_rows", "out_rows"))
    limit = F.when(g < i, "gps").when(i < g, "imu").otherwise("equal")
    return out.select(key, g.alias("gps_rows"), i.alias("imu_rows"), o.alias("out_rows"), F.least(g, i).alias("possible_rows"), F.greatest(F.lit(0), F.least(g, i) - o).alias("overlap_loss"), limit.alias("limited_by"))


def variable_profile(df: DataFrame, variables: list[str], k: float = 1.5) -> DataFrame:
    """rows, valid rows, percent invalid and outside the interquartile fences, mean, sample deviation, min and max by variable."""
    long = df.unpivot([], variables, "variable", "value")
    names = df.sparkSession.createDataFrame([(v,) for v in variables], "variable string")
    q = with_percentiles(names, long, F.col("value"), [0.25, 0.75], ["variable"]).withColumnRenamed("p", "q")
    joined = long.join(F.broadcast(q), "variable")  # one row a variable
    iqr = F.col("q")[1] - F.col("q")[0]
    out = F.coalesce((iqr > 0) & ((F.col("value") < F.col("q")[0] - k * iqr) | (F.col("value") > F.col("q")[1] + k * iqr)), F.lit(False))
    return joined.groupBy("variable").agg(
        F.count("*").alias("n_rows"), F.count("value").alias("valid_rows"), (100.0 * (F.count("*") - F.count("value")) / F.count("*")).alias("invalid_pct"),
        (100.0 * F.sum(out.cast("int")) / F.count("value")).alias("outlier_pct"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )


def describe(df: DataFrame, value: str, quantiles: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99), by: list[str] = []) -> DataFrame:  # noqa: B006
    got = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    return with_percentiles(got, df, F.col(value), list(quantiles), by).select(*by, "n", "mean", "std", "min", *[F.col("p")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(quantiles)], "max")


def comparison_metrics(df: DataFrame, truth: str, guess: str, by: list[str] = []) -> DataFrame:  # noqa: B006
    """mae, rmse, bias (guess - truth) and Pearson r (null for one row)."""
    d = F.col(guess) - F.col(truth)
    return df.where(d.isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(d).alias("bias"), F.corr(guess, truth).alias("r"))


def regression_metrics(df: DataFrame, truth: str, guess: str, by: list[str] = []) -> DataFrame:  # noqa: B006
    d, t = F.col(guess) - F.col(truth), F.col(truth)
    e = F.abs(d)
    got = df.where(d.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(e).alias("mae"), (1 - F.sum(d * d) / (F.var_pop(t) * F.count("*"))).alias("r2"),
        (100 * F.avg(e / F.greatest(F.abs(t), F.lit(1e-6)))).alias("mape"), F.avg(d).alias("bias"), F.max(e).alias("max_error"),
    )
    return with_percentiles(got, df, e, [0.5, 0.9, 0.95], by).select(*by, "n", "rmse", "mae", F.col("p")[0].alias("medae"), "r2", "mape", "bias", F.col("p")[1].alias("p90"), F.col("p")[2].alias("p95"), "max_error")


def error_by_group(df: DataFrame, group: str, truth: str, guess: str, min_n: int) -> DataFrame:
    d = F.col(guess) - F.col(truth)
    got = df.groupBy(group).agg(F.count("*").alias("n"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(d).alias("bias")).where(F.col("n") >= min_n)
    return with_percentiles(got, df, F.abs(d), [0.95], [group]).withColumn("p95", F.col("p")[0]).drop("p")


def least_squares_2(df: DataFrame, y: Column, a: Column, b: Column, by: list[str] = []) -> DataFrame:  # noqa: B006
    """k1, k2 of y = k1 a + k2 b through the origin, from five sums; null where the two are collinear."""
    s = df.groupBy(*by).agg(F.sum(a * a).alias("aa"), F.sum(a * b).alias("ab"), F.sum(b * b).alias("bb"), F.sum(a * y).alias("ay"), F.sum(b * y).alias("by"))
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    return s.select(*by, F.when(det != 0, (F.col("ay") * F.col("bb") - F.col("by") * F.col("ab")) / det).alias("k1"), F.when(det != 0, (F.col("by") * F.col("aa") - F.col("ay") * F.col("ab")) / det).alias("k2"))


def composite_score(df: DataFrame, weights: dict[str, tuple[float, bool]]) -> DataFrame:
    """df with score: each metric over its largest value, or one minus that where less is better, times its weight."""
    top = df.agg(*[F.max(c).alias(f"__{c}") for c in weights])
    parts = [w * (F.col(c) / F.col(f"__{c}") if more else 1 - F.col(c) / F.col(f"__{c}")) for c, (w, more) in weights.items()]
    return df.crossJoin(F.broadcast(top)).withColumn("score", reduce(lambda a, b: a + b, parts)).drop(*[f"__{c}" for c in weights])  # one row is joined


def average_ranks(counts: DataFrame, by: str, value: str, n: str, out: str) -> DataFrame:
    """by, value and its average rank within `by`, from a row for each (by, value) with its count n.

    Values are dealt by ranges, so no task holds a group; each task's counts, a row a group and task, say what comes before it.
    """
    dealt = counts.repartitionByRange(by, value).sortWithinPartitions(by, value)
    rows = scratch.at_rest(dealt.select(by, value, n, F.spark_partition_id().alias("__p")), "ranks")
    before = F.coalesce(F.sum("__s").over(Window.partitionBy(by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = rows.groupBy(by, "__p").agg(F.sum(n).alias("__s")).select(by, "__p", before.alias("__b"))
    upto = F.sum(n).over(Window.partitionBy(by, "__p").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__u", upto).join(sums, [by, "__p"]).select(by, value, (F.col("__b") + F.col("__u") - (F.col(n) - 1) / 2).alias(out))


def rank_average(df: DataFrame, column: str, out: str) -> DataFrame:
    """df with the average rank (ties share theirs) of a numeric column; null where the column is null."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.lit(0).alias("__g"), column).agg(F.count("*").alias("__n"))
    return df.join(average_ranks(counts, "__g", column, "__n", out).drop("__g"), column, "left")


def spearman(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """feature and rho: the rank correlation of each feature with the target, over the rows in which neither is null or NaN.

    All features go through one plan: pairs of values are counted by feature, the values of both sides ranked from their counts.
    Its size doesn't depend on the number of features. A feature that is constant, or has no rows, has a null.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    long = df.select(number(target).alias("__t"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), number(f).alias("v")) for f in features])).alias("__e"))
    long = long.select(F.col("__e.feature").alias("feature"), F.col("__e.v").alias("v"), F.col("__t").alias("t")).where("v is not null and t is not null")
    pairs = scratch.at_rest(long.groupBy("feature", "v", "t").agg(F.count("*").alias("n")), "pairs")
    for value in ("v", "t"):
        counts = pairs.groupBy("feature", value).agg(F.sum("n").alias("n"))
        pairs = pairs.join(average_ranks(counts, "feature", value, "n", f"r{value}"), ["feature", value])
    s = lambda c: F.sum(F.col("n") * c)
    n, a, b = F.sum("n"), F.col("rv"), F.col("rt")
    mid = (n + 1) / 2  # the mean of ranks
    got = pairs.groupBy("feature").agg(n.alias("n"), s(a * b).alias("ab"), s(a * a).alias("aa"), s(b * b).alias("bb"), mid.alias("m"))
    c = lambda x: F.col(x) - F.col("n") * F.col("m") * F.col("m")
    rho = F.try_divide(c("ab"), F.sqrt(c("aa")) * F.sqrt(c("bb")))
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return names.join(got.select("feature", rho.alias("rho")), "feature", "left")


def merge_indicator(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on key with _merge: both, left_only or right_only."""
    l_, r = left.withColumn("__l", F.lit(1)), right.withColumn("__r", F.lit(1))
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    return l_.join(r, key, "full_outer").withColumn("_merge", F.when(both, "both").when(F.col("__l").isNotNull(), "left_only").otherwise("right_only")).drop("__l", "__r")


def duplicate_and_null_rows(df: DataFrame) -> DataFrame:
    n = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    some = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])
    return n.agg(F.sum(F.col("__n") - 1).alias("duplicate_rows"), F.coalesce(F.sum(F.when(some, F.col("__n"))), F.lit(0)).alias("null_rows"))
