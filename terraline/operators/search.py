"""Constrained search over tree regressors: a tree-structured Parzen sampler, a median pruner, and trials that outlive the run.

Every trial is a row of a Parquet table, COMPLETE or PRUNED. What is suggested next depends on the seed, the number of the trial
and the trials at rest alone, so a search that was interrupted goes on with the trials it would have made.
"""

from __future__ import annotations

import json
import math
import random
from dataclasses import asdict, dataclass, field
from statistics import fmean, median, pstdev

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraline.operators.audit import regression_metrics
from terraline.operators.learning import Run, SearchLimits, best_trial, fit, fold_metrics, holdout_by_group, is_feasible, predict

COMPLETE, PRUNED = "COMPLETE", "PRUNED"
#: Names and ranges: (least, greatest) of whole numbers, or a list of choices.
SPACE = {
    "random_forest": {"numTrees": (10, 60), "maxDepth": (3, 12), "minInstancesPerNode": (2, 12), "featureSubsetStrategy": ["sqrt", "log2", "0.5", "0.8"]},
    "extra_trees": {"numTrees": (10, 60), "maxDepth": (3, 12), "minInstancesPerNode": (2, 11), "minInstancesToSplit": (4, 24), "maxFeatures": ["sqrt", "log2", 0.5, 0.8]},
    "gradient_boosting": {"maxIter": (10, 60), "maxDepth": (2, 6), "minInstancesPerNode": (2, 15), "stepSize": [0.02, 0.03, 0.05, 0.08, 0.10], "subsamplingRate": [0.65, 0.75, 0.85, 0.95]},
}
_SCHEMA = "trial int, model string, params string, state string, fold_r2 array<double>, cv_r2 double, cv_std double, cv_rmse double, cv_mae double, holdout_r2 double, holdout_rmse double, holdout_mae double, gap double, feasible boolean"


@dataclass(frozen=True)
class Sampler:
    """startup: trials drawn evenly, and completed trials that pruning waits for. good: the share of trials that the first density is of."""

    kind: str = "tpe"
    startup: int = 10
    good: float = 0.25
    candidates: int = 24


@dataclass
class Trial:
    trial: int
    model: str
    params: dict
    state: str
    fold_r2: list[float]
    cv_r2: float
    cv_std: float
    cv_rmse: float
    cv_mae: float
    holdout_r2: float | None = None
    holdout_rmse: float | None = None
    holdout_mae: float | None = None
    gap: float | None = None
    feasible: bool = False
    run: Run | None = field(default=None, compare=False)


def density(choices, seen: list, value) -> float:
    """Parzen estimate at a value: counts and one for each choice, or a normal kernel at each seen number and a broad one in the middle."""
    if isinstance(choices, list):
        return (seen.count(value) + 1 / len(choices)) / (len(seen) + 1)
    low, high = choices
    span = high - low or 1
    width = max(span / (1 + len(seen)), 0.5)
    bell = lambda m, w: math.exp(-0.5 * ((value - m) / w) ** 2) / w
    return (sum(bell(m, width) for m in seen) + bell((low + high) / 2, span)) / (len(seen) + 1)


def drawn(choices, seen: list, rng: random.Random):
    """A value from that estimate."""
    k = rng.randrange(len(seen) + 1)
    if isinstance(choices, list):
        return seen[k] if k < len(seen) else rng.choice(choices)
    low, high = choices
    if k == len(seen):
        return rng.randint(low, high)
    width = max((high - low) / (1 + len(seen)), 0.5)
    return min(high, max(low, round(rng.gauss(seen[k], width))))


def suggest(model: str, past: list[Trial], number: int, seed: int, sampler: Sampler = Sampler()) -> dict:
    """Parameters of the next trial. Past trials are ranked by their cross-validated r2, pruned ones behind all complete ones; of
    some candidates drawn near the good ones, the one with the highest ratio of both densities, all parameters together, is taken."""
    rng = random.Random(f"{seed}/{model}/{number}")
    space = SPACE[model]
    past = [t for t in past if t.model == model]
    if sampler.kind == "random" or len(past) < sampler.startup:
        return {p: rng.choice(c) if isinstance(c, list) else rng.randint(*c) for p, c in space.items()}
    ranked = sorted(past, key=lambda t: (t.state == COMPLETE, t.cv_r2), reverse=True)
    cut = max(1, math.ceil(sampler.good * len(ranked)))
    good, bad = ([t.params for t in part] for part in (ranked[:cut], ranked[cut:]))
    best, top = None, -math.inf
    for _ in range(sampler.candidates):
        one = {p: drawn(c, [g[p] for g in good], rng) for p, c in space.items()}
        ratio = sum(math.log(density(c, [g[p] for g in good], one[p])) - math.log(density(c, [b[p] for b in bad], one[p])) for p, c in space.items())
        if ratio > top:
            best, top = one, ratio
    return best


def should_prune(folds: list[float], past: list[Trial], startup: int, warm_up: int = 2) -> bool:
    """From fold `warm_up` on: the best running mean so far lies below the median of the completed trials' running means at this fold."""
    done = [t for t in past if t.state == COMPLETE and len(t.fold_r2) >= len(folds)]
    if len(folds) < warm_up or len(done) < max(1, startup):
        return False
    return max(fmean(folds[: i + 1]) for i in range(len(folds))) < median(fmean(t.fold_r2[: len(folds)]) for t in done)


def read_trials(spark: SparkSession, path: str) -> list[Trial]:
    """The trials at rest, in order; none where there is no table yet."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(conf).exists(p):
        return []
    rows = spark.read.schema(_SCHEMA).parquet(path).orderBy("trial").collect()  # a row a trial
    return [Trial(**(r.asDict() | {"params": json.loads(r["params"]), "fold_r2": list(r["fold_r2"])})) for r in rows]


def histories(trials: list[Trial]) -> tuple[list[Trial], list[Trial]]:
    """(complete, pruned)."""
    return [t for t in trials if t.state == COMPLETE], [t for t in trials if t.state == PRUNED]


def out_of_patience(trials: list[Trial], patience: int) -> bool:
    """Whether the last `patience` complete trials brought no better hold-out r2."""
    best, since = -math.inf, 0
    for t in histories(trials)[0]:
        best, since = (t.holdout_r2, 0) if t.holdout_r2 > best else (best, since + 1)
    return since >= patience


def search(df: DataFrame, features: list[str], target: str, groups: str, path: str, model: str = "random_forest", limits: SearchLimits = SearchLimits(), sampler: Sampler = Sampler(), prune: bool = True, folds: int = 5, seed: int = 42, trials: int | None = None) -> list[Trial]:
    """All trials at rest below path after this run. It ends when a trial is feasible, patience runs out, limits.max_trials are made,
    or `trials` were added. A pruned trial's later folds are not fitted, and it has no hold-out."""
    spark = df.sparkSession
    train, held = (part.persist() for part in holdout_by_group(df, groups, seed=seed))  # read by each fit of each trial
    past, added = read_trials(spark, path), 0
    try:
        while len(past) < limits.max_trials and (trials is None or added < trials) and not any(t.feasible for t in past) and not out_of_patience(past, limits.patience):
            made = one_trial(train, held, features, target, groups, model, past, limits, sampler, prune, folds, seed)
            row = asdict(made) | {"params": json.dumps(made.params)}
            spark.createDataFrame([tuple(row[c.split()[0]] for c in _SCHEMA.split(", "))], _SCHEMA).coalesce(1).write.mode("append").parquet(path)
            past, added = [*past, made], added + 1
    finally:
        train.unpersist()
        held.unpersist()
    return past


def one_trial(train: DataFrame, held: DataFrame, features: list[str], target: str, groups: str, model: str, past: list[Trial], limits: SearchLimits, sampler: Sampler, prune: bool, folds: int, seed: int) -> Trial:
    run = Run(model, suggest(model, past, len(past), seed, sampler), f"trial{len(past)}")
    got = {"r2": [], "rmse": [], "mae": []}
    for row in fold_metrics(train, features, target, run, groups, folds):
        for c, values in got.items():
            values.append(float(row[c]))
        if prune and len(got["r2"]) < folds and should_prune(got["r2"], past, sampler.startup):
            break
    r2 = got["r2"]
    made = Trial(len(past), model, run.params, COMPLETE if len(r2) == folds else PRUNED, r2, fmean(r2), pstdev(r2), fmean(got["rmse"]), fmean(got["mae"]), run=run)
    if made.state == COMPLETE:
        out = regression_metrics(predict(fit(train, features, target, run), held), target, "prediction").first()
        made.holdout_r2, made.holdout_rmse, made.holdout_mae, made.gap = out["r2"], out["rmse"], out["mae"], made.cv_r2 - out["r2"]
        made.feasible = is_feasible(asdict(made), limits)
    return made


def chosen(trials: list[Trial], limits: SearchLimits = SearchLimits()) -> Trial | None:
    """The best of the complete trials."""
    done = histories(trials)[0]
    best = best_trial([asdict(t) for t in done], limits)
    return next((t for t in done if best and t.trial == best["trial"]), None)


def leaderboard(spark: SparkSession, path: str) -> DataFrame:
    """Complete trials, the best hold-out first."""
    return spark.read.schema(_SCHEMA).parquet(path).where(F.col("state") == COMPLETE).orderBy(F.desc("holdout_r2"), F.desc("cv_r2"), "trial")
