"""What training runs leave behind: leaderboards, histories and hold-out tables below a folder of models."""

from __future__ import annotations

import io
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = ["holdout_r2", "holdout_rmse", "generalization_gap"]
#: Names and the value that stands for a missing one, in the `best` entry of a history.
BEST = ["trial", "holdout_r2", "cv_r2_mean", "cv_r2_std", "cv_rmse_mean", "cv_mae_mean", "holdout_rmse", "holdout_mae", "generalization_gap"]


def number(value) -> float | None:
    try:
        out = float(value)
    except (TypeError, ValueError):
        return None
    return out if out == out else None


def from_table(table: pd.DataFrame) -> dict[str, float | None]:
    """Metrics of the row with the highest hold-out r2, or else objective value, or else of the first row."""
    table = table.rename(columns=str.lower)
    if not len(table):
        return {}
    by = next((c for c in ("holdout_r2", "objective_value") if c in table), None)
    values = pd.to_numeric(table[by], errors="coerce") if by else None
    row = table.loc[values.idxmax()] if by and values.notna().any() else table.iloc[0]
    return {m: number(row.get(m)) for m in METRICS}


def from_history(text: str) -> dict[str, float | None]:
    """Metrics of the trial with the highest hold-out r2 (the first trial's where none has one)."""
    body = json.loads(text)
    trials = [t for t in (body.get("history") if isinstance(body, dict) else body) or [] if isinstance(t, dict)]
    if not trials:
        return {}
    scored = [t for t in trials if number(t.get("holdout_r2")) is not None]
    best = max(scored, key=lambda t: number(t["holdout_r2"])) if scored else trials[0]
    out = {m: number(best.get(m)) for m in METRICS}
    mean = number(best.get("cv_r2_mean"))
    if out["generalization_gap"] is None and None not in (mean, out["holdout_r2"]):
        out["generalization_gap"] = mean - out["holdout_r2"]
    return out


def folder_metrics(files: list[tuple[str, bytes]]) -> dict[str, float | None] | None:
    """A model folder's metrics: the leaderboard's; what it lacks (or has as 0) from the history; if nothing was found, the first other
    table that has such columns. None for a folder that holds no model. Files that can't be read are passed over."""
    files = sorted(files)
    low = [n.lower() for n, _ in files]
    if not any("leaderboard" in n or "holdout" in n or n.endswith(("_history.json", "_report.md")) for n in low):
        return None

    def tried(read, body) -> dict:
        try:
            return read(body)
        except (ValueError, KeyError, AttributeError, UnicodeDecodeError):
            return {}

    table = lambda body: from_table(pd.read_csv(io.BytesIO(body)))
    out = dict.fromkeys(METRICS)
    board = next((b for n, b in files if "leaderboard" in n and n.endswith(".csv")), None)
    if board is not None:
        out |= {m: v for m, v in tried(table, board).items() if v}
    history = next((b for n, b in files if n.endswith("_history.json")), None)
    if history is not None:
        found = tried(lambda body: from_history(body.decode()), history)
        out = {m: found.get(m) if v is None else v for m, v in out.items()}
    if all(v is None for v in out.values()):
        for n, b in files:
            if n.endswith(".csv") and any(m in b.split(b"\n", 1)[0].decode(errors="replace").lower().split(",") for m in METRICS):
                out |= tried(table, b)
                break
    return out


def scan_models(spark: SparkSession, root: str) -> DataFrame:
    """model_dir (below root), full_path and the metrics of every folder below root that holds a model. A folder's artifacts, which are
    a few small files, are one group."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,json,md}").load(root)
    parts = F.regexp_extract("path", r"^(.*)/([^/]+)$", 1).alias("full_path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        got = folder_metrics(list(zip(pdf["name"], pdf["content"], strict=True)))
        rows = [] if got is None else [{"full_path": pdf["full_path"].iloc[0], **got}]
        return pd.DataFrame(rows, columns=["full_path", *METRICS]).astype(dict.fromkeys(METRICS, "Float64"))

    got = files.select(*parts, "content").groupBy("full_path").applyInPandas(one, "full_path string, " + ", ".join(f"{m} double" for m in METRICS))
    plain = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    below = F.regexp_replace(F.substring(plain(F.col("full_path")), len(root.rstrip("/").removeprefix("file://")) + 1, 1 << 20), r"^/+", "")
    return got.select(F.when(below == "", ".").otherwise(below).alias("model_dir"), "full_path", *METRICS)


def device_metrics(spark: SparkSession, root: str) -> DataFrame:
    """device, model and the `best` entry of adaptive_w_model_<model>_history.json below root/doback-<device>; a history in the model's own
    folder comes before one in the device's. Missing entries are 0."""
    schema = "best struct<" + ", ".join(f"{c}: double" for c in BEST) + ">"
    read = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "adaptive_w_model_*_history.json").schema(schema).json(root)
    path = F.col("_metadata.file_path")
    place = r"/doback-([^/]+)/(?:([^/]+)/)?adaptive_w_model_([^/]+)_history\.json$"
    rows = read.select("best", *[F.regexp_extract(path, place, i).alias(n) for i, n in ((1, "device"), (2, "folder"), (3, "model"))])
    rows = rows.where((F.col("device") != "") & ((F.col("folder") == "") | (F.col("folder") == F.col("model"))))
    one = rows.groupBy("device", "model").agg(F.max_by("best", F.col("folder") != "").alias("best"))
    values = [F.coalesce(F.col("best")[c], F.lit(0.0)).alias(c) for c in BEST]
    return one.select("device", "model", values[0].cast("int"), *values[1:])


def best_of_devices(metrics: DataFrame) -> DataFrame:
    """The row of each device with the highest hold-out r2; ties go to the model's name."""
    top = metrics.groupBy("device").agg(F.max("holdout_r2").alias("holdout_r2"))
    return metrics.join(top, ["device", "holdout_r2"]).groupBy("device").agg(F.min_by(F.struct(*[c for c in metrics.columns if c != "device"]), "model").alias("r")).select("device", "r.*")
