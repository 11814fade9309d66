"""Stage tables and artifacts: CSV and Parquet scans with provenance, file selection, JSON reports, sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraline.functions.naming import base_name, clean_double, file_key
from terraline.operators.filters import drop_summary
from terraline.operators.quantiles import with_percentiles


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, file, stem, length of the files below a folder; contents aren't read."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").load(path).select("path", name.alias("file"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "length")


def select_files(files: DataFrame, contains: list[str] = [], most: int | None = None, seed: int = 42) -> DataFrame:  # noqa: B006
    """Distinct files whose path holds all the given strings; with `most` so many of them, shuffled by a seeded hash. None at all raises, which takes a job."""
    out = files.dropDuplicates(["path"])
    for part in contains:
        out = out.where(F.col("path").contains(part))
    if not out.take(1):
        raise FileNotFoundError(f"no file whose path holds {contains}" if contains else "no file")
    return out.orderBy(F.xxhash64(F.lit(seed), "path"), "path").limit(most) if most else out


def segment_files(files: DataFrame, base: str) -> DataFrame:
    """BASE first, then its segments in number order."""
    n = F.coalesce(F.regexp_extract("stem", r"_seg(\d+)$", 1).try_cast("int"), F.lit(0))
    return files.where(base_name(F.col("stem")) == base).withColumn("segment_id", n).orderBy("segment_id")


def read_stage_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV stage tables with source_file and source_key; malformed lines and unreadable files are skipped. Without a schema all columns are text."""
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    df = (reader.schema(schema) if schema else reader).csv(paths)
    return df.select("*", F.col("_metadata.file_name").alias("source_file")).withColumn("source_key", file_key(F.col("source_file")))


def read_union(spark: SparkSession, groups: list[str | list[str]]) -> DataFrame | None:
    """Stage tables of different columns as one frame, missing columns null; None for no group."""
    out = None
    for paths in groups:
        df = read_stage_csv(spark, paths)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def resolve_column(df: DataFrame, aliases: list[str]) -> str | None:
    """The first alias that is a column, then the first that is one but for case."""
    lower = {c.lower(): c for c in df.columns}
    return next((a for a in aliases if a in df.columns), next((lower[a.lower()] for a in aliases if a.lower() in lower), None))


def numeric(c: Column | str) -> Column:
    return clean_double((F.col(c) if isinstance(c, str) else c).cast("string"))


def has_feature_values(df: DataFrame, features: list[str], count_col: str = "n_points_used") -> DataFrame:
    """One row a source_file: rows, and whether any feature has a value (a count above zero, or a number in another feature)."""
    there = [c for c in features if c in df.columns]
    some = F.lit(False)
    for c in there:
        some = some | F.coalesce((numeric(c) > 0) if c == count_col else numeric(c).isNotNull(), F.lit(False))
    return df.groupBy("source_file").agg(F.count("*").alias("n_rows"), F.coalesce(F.max(some), F.lit(False)).alias("has_values")).withColumn("has_columns", F.lit(len(there) == len(features)))


def rows_by_base(df: DataFrame) -> DataFrame:
    """Files and rows of each base name over its segments."""
    stem = base_name(F.regexp_replace("source_file", r"\.[^.]*$", ""))
    return df.groupBy(stem.alias("base")).agg(F.countDistinct("source_file").alias("files"), F.count("*").alias("n_rows"))


def pair_artifacts(csvs: DataFrame, jsons: DataFrame) -> DataFrame:
    """source_key, csv and json paths; either may be missing."""
    key = F.regexp_replace("stem", r"_(dropped|outliers|summary)$", "")
    return csvs.select(key.alias("source_key"), F.col("path").alias("csv")).join(jsons.select(key.alias("source_key"), F.col("path").alias("json")), "source_key", "full_outer")


FILTER_STEP = "filter_steps array<struct<source_key: string, stage: string, filter_name: string, before_rows: bigint, dropped_rows: bigint, after_rows: bigint>>"


def read_filter_steps(spark: SparkSession, path: str) -> DataFrame:
    steps = spark.read.option("multiLine", True).schema(FILTER_STEP).json(path)
    return steps.select(F.explode("filter_steps").alias("s")).select("s.*")


def explain_discards(summary: DataFrame, steps: DataFrame) -> DataFrame:
    """Drop summary with the retention of the rule of the same stage and name; rules that dropped nothing stay, with 0 rows."""
    s = steps.groupBy("stage", F.col("filter_name").alias("reason")).agg(F.sum("before_rows").alias("before_rows"), F.sum("after_rows").alias("after_rows"))
    return s.join(summary, ["stage", "reason"], "full_outer").withColumn("dropped_rows", F.coalesce("dropped_rows", F.lit(0)))


TRIAL = "trial int, model string, status string, cv_r2 double, holdout_r2 double, gap double, cv_std double, cv_fold_r2s array<double>"


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trials of JSON histories; cv_r2 falls back on the mean of the folds; status COMPLETE where it is missing."""
    df = spark.read.option("multiLine", True).schema(TRIAL).json(path)
    folds = F.when(F.size("cv_fold_r2s") > 0, F.aggregate("cv_fold_r2s", F.lit(0.0), lambda a, x: a + x) / F.size("cv_fold_r2s"))
    return df.select("trial", "model", F.coalesce("status", F.lit("COMPLETE")).alias("status"), F.coalesce(folds, "cv_r2").alias("cv_r2"), "holdout_r2", "gap", "cv_std")


def leaderboard(trials: DataFrame) -> DataFrame:
    return trials.orderBy(F.desc_nulls_last("holdout_r2"), F.desc_nulls_last("cv_r2"), "trial")


def best_by_model(trials: DataFrame, target: float = 0.70) -> DataFrame:
    order = F.struct(F.coalesce("holdout_r2", F.lit(float("-inf"))), F.coalesce("cv_r2", F.lit(float("-inf"))), -F.col("trial"))
    got = trials.groupBy("model").agg(F.max_by(F.struct("trial", "cv_r2", "holdout_r2", "gap"), order).alias("b"), F.count("*").alias("trials"))
    return got.select("model", "trials", "b.*").withColumn("meets_target", F.col("holdout_r2") >= target)


def tile_list(spark: SparkSession, path: str) -> DataFrame:
    """Names of a text list; blank lines and `#` comments are skipped."""
    return spark.read.text(path).select(F.trim("value").alias("tile")).where((F.col("tile") != "") & ~F.col("tile").startswith("#"))


# ------------------------------------------------------------------------------------------------ sinks


def write_stage(df: DataFrame, path: str, by: tuple[str, ...] = ("source_key", "segment_id")) -> None:
    """One Parquet dataset, a folder a route and segment; rows of a folder are gathered first, so files don't multiply."""
    cols = [c for c in by if c in df.columns]
    df.repartition(*cols).write.mode("overwrite").partitionBy(*cols).parquet(path)


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Dropped rows and their summary."""
    ledger.write.mode("overwrite").parquet(f"{path}/dropped")
    drop_summary(ledger).write.mode("overwrite").json(f"{path}/summary")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_fixed(df: DataFrame, path: str, formats: dict[str, str]) -> None:
    """`;` rows of the given printf formats."""
    df.select(F.concat_ws(";", *[F.format_string(f, c) for c, f in formats.items()]).alias("value")).write.mode("overwrite").text(path)


def route_report(rows: DataFrame, key: str = "source_key", segment: str = "segment_id") -> DataFrame:
    """One line a route: its segments and rows."""
    n = rows.groupBy(key, segment).agg(F.count("*").alias("n"))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(segment, "n"))), lambda x: F.concat(F.lit("seg"), x[segment].cast("string"), F.lit("="), x["n"].cast("string"))), ", ")
    return n.groupBy(key).agg(F.sum("n").alias("n_rows"), F.count("*").alias("segments"), parts.alias("detail"))


# ------------------------------------------------------------------------------------------------ feeds of maps


def colored_route(df: DataFrame, by: list[str], order: list[str], si: str, color: Column) -> DataFrame:
    """Mean position and index of each time, in order, with its colour and whether it begins or ends the route."""
    w = Window.partitionBy(*by).orderBy(*order)
    mean = df.groupBy(*by, *order).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.avg(si).alias(si))
    return mean.withColumns({"color": color, "is_start": F.lag("lat").over(w).isNull(), "is_end": F.lead("lat").over(w).isNull()})


def hover_text(fields: dict[str, str]) -> Column:
    """`name: value` lines in HTML, empty values left out."""
    return F.concat_ws("<br>", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), F.format_string(f, F.col(c)))) for c, f in fields.items()])


def color_limits(df: DataFrame, value: str) -> DataFrame:
    return with_percentiles(df.agg(F.count(value).alias("n")), df, F.col(value), [0.02, 0.98]).select(F.col("p")[0].alias("low"), F.col("p")[1].alias("high"))


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """bin (from 0) and rows between the smallest and the largest value."""
    lim = df.agg(F.min(value).alias("__a"), F.max(value).alias("__b"))
    k = F.when(F.col("__b") > F.col("__a"), F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("__a")) / (F.col("__b") - F.col("__a")) * bins))).otherwise(F.lit(0))
    return df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(lim)).groupBy(k.cast("int").alias("bin")).agg(F.count("*").alias("n"))  # one row is joined
