"""Training data splits, tree regressors, cross-validation, what makes a trial feasible."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from terraline.operators.audit import regression_metrics
from terraline.operators.ordered import numbered
from terraline.operators.trees import ExtraTrees

MODELS = {"random_forest": RandomForestRegressor, "gradient_boosting": GBTRegressor, "extra_trees": ExtraTrees}
METRICS = "n long, rmse double, mae double, medae double, r2 double, mape double, bias double, p90 double, p95 double, max_error double, fold int"


@dataclass(frozen=True)
class Run:
    model: str
    params: dict = field(default_factory=dict)
    run_id: str = "base"


def random_folds(df: DataFrame, key: list[str], folds: int, seed: int = 42) -> DataFrame:
    """df with fold, near-balanced, without a global order."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(folds)).cast("int"))


def group_folds(df: DataFrame, group: str, folds: int) -> DataFrame:
    """df with fold; no group is in two folds. Groups go, large ones first, round and back over the folds, which keeps sizes
    near even without a sequential pass over the groups. Fewer groups than folds raise.

    A group's place comes from counts: groups are dealt by ranges of size, and what the tasks before hold, a row a task, says where a task begins."""
    sizes = df.groupBy(group).agg((-F.count("*")).alias("__n")).withColumn("__all", F.lit(0))
    if sizes.limit(folds).count() < folds:
        raise ValueError(f"fewer than {folds} groups")
    place = numbered(sizes, "__all", ["__n", group], "__place")
    lap = F.pmod("__place", F.lit(2 * folds))
    fold = F.when(lap < folds, lap).otherwise(2 * folds - 1 - lap).cast("int")
    return df.join(place.select(group, fold.alias("fold")), group)


def holdout_by_group(df: DataFrame, group: str, fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, holdout): max(1, fraction) of the groups, shuffled by a seeded hash, are held out."""
    # the hash is even, so its upper bits cut the groups into parts that are numbered for themselves
    groups = df.select(group).distinct().withColumn("__h", F.xxhash64(F.lit(seed), group)).withColumn("__p", F.shiftright("__h", 56))
    sums = groups.groupBy("__p").agg(F.count("*").alias("__s"))
    whole = Window.orderBy("__p")  # a row a part, 256 at most
    before = sums.select("__p", F.coalesce(F.sum("__s").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"), F.sum("__s").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__n"))
    place = F.col("__b") + F.row_number().over(Window.partitionBy("__p").orderBy("__h", group))
    held = groups.join(F.broadcast(before), "__p").withColumn("__i", place).where(F.col("__i") <= F.greatest(F.lit(1), F.floor(F.col("__n") * fraction))).select(group)
    return df.join(held, group, "left_anti"), df.join(held, group, "left_semi")


def fit(train: DataFrame, features: list[str], target: str, run: Run):
    if run.model not in MODELS:
        raise ValueError(f"unknown model {run.model}")
    vector = VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="skip")
    model = MODELS[run.model](featuresCol="__features", labelCol=target, predictionCol="prediction", seed=42, **run.params)
    return vector, model.fit(vector.transform(train))


def predict(fitted, df: DataFrame) -> DataFrame:
    vector, model = fitted
    return model.transform(vector.transform(df)).drop("__features")


def fold_metrics(df: DataFrame, features: list[str], target: str, run: Run, groups: str | None = None, folds: int = 5) -> Iterator[Row]:
    """Regression metrics of fold after fold, each predicted by a model of the others; a fold is fitted when it is asked for."""
    dealt = group_folds(df, groups, folds) if groups else random_folds(df, features, folds)
    dealt = dealt.persist()  # read by every fit; rows that a lost executor held are dealt again
    try:
        for k in range(folds):
            fitted = fit(dealt.where(F.col("fold") != k), features, target, run)
            yield regression_metrics(predict(fitted, dealt.where(F.col("fold") == k)), target, "prediction").withColumn("fold", F.lit(k)).first()
    finally:
        dealt.unpersist()


def cross_validate(df: DataFrame, features: list[str], target: str, run: Run, groups: str | None = None, folds: int = 5) -> DataFrame:
    """A row of metrics for each fold. The folds are fitted here, one after the other, and nothing stays on the executors."""
    return df.sparkSession.createDataFrame([tuple(r) for r in fold_metrics(df, features, target, run, groups, folds)], METRICS)


def fold_summary(metrics: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return metrics.groupBy(*by).agg(*[f("r2").alias(f"r2_{n}") for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))], F.avg("rmse").alias("rmse_mean"), F.avg("mae").alias("mae_mean"))


def importances(fitted, features: list[str]) -> list[tuple[str, float]]:
    return sorted(zip(features, fitted[1].featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1])


@dataclass(frozen=True)
class SearchLimits:
    target_r2: float = 0.70
    max_gap: float = 0.08
    max_std: float = 0.08
    max_trials: int = 80
    patience: int = 25


def is_feasible(trial: dict, limits: SearchLimits) -> bool:
    return trial["cv_r2"] >= limits.target_r2 and trial["gap"] <= limits.max_gap and trial["cv_std"] <= limits.max_std


def best_trial(trials: list[dict], limits: SearchLimits) -> dict | None:
    """Feasible ones first, then hold-out r2, cross-validated r2, the earlier trial."""
    return max(trials, key=lambda t: (is_feasible(t, limits), t["holdout_r2"], t["cv_r2"], -t["trial"]), default=None)


def permutation_importance(fitted, df: DataFrame, features: list[str], target: str, seed: int = 42) -> dict[str, float]:
    """Loss of r2 when a feature's values are dealt to other rows, by a join on two seeded row numbers within hash buckets."""
    base = regression_metrics(predict(fitted, df), target, "prediction").first()["r2"]
    buckets = F.pmod(F.xxhash64(*features, target), F.lit(64))
    out = {}
    for f in features:
        number = lambda s: F.row_number().over(Window.partitionBy("__b").orderBy(F.xxhash64(F.lit(s), *features, target)))
        rows = df.withColumn("__b", buckets)
        other = rows.select("__b", F.col(f).alias("__f"), number(seed + 1).alias("__i"))
        mixed = rows.withColumn("__i", number(seed)).join(other, ["__b", "__i"]).withColumn(f, F.col("__f")).drop("__b", "__i", "__f")
        out[f] = base - regression_metrics(predict(fitted, mixed), target, "prediction").first()["r2"]
    return out


def holdout_table(predicted: DataFrame, target: str) -> DataFrame:
    """Predictions with residual: the true value less the predicted one."""
    return predicted.withColumn("residual", F.col(target) - F.col("prediction"))


def save_bundle(fitted, trials: DataFrame, path: str) -> None:
    """The vector stage and the model, the trials as JSON and the leaderboard as CSV, below path."""
    for name, stage in zip(("features", "model"), fitted, strict=True):
        stage.write().overwrite().save(f"{path}/{name}")
    trials.write.mode("overwrite").json(f"{path}/metrics")
    trials.orderBy(F.desc_nulls_last("holdout_r2"), F.desc_nulls_last("cv_r2"), "trial").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/leaderboard")


def device_averages(trials: DataFrame, device: str = "device", target: float = 0.70) -> DataFrame:
    """Models, mean hold-out r2 and rmse, and how many reach the target, by device."""
    return trials.groupBy(device).agg(F.count("*").alias("models"), F.avg("holdout_r2").alias("avg_r2"), F.avg("rmse").alias("avg_rmse"), F.count(F.when(F.col("holdout_r2") >= target, 1)).alias("on_target"))
