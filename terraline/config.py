"""Configuration layer: overrides, run expansion, small parsers. Plain Python on the driver."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import fields, is_dataclass, replace

from terraline.operators.learning import MODELS, Run


def deep_update(base: Mapping, changes: Mapping) -> dict:
    """base with changes on top, mappings merged level by level; neither is altered."""
    out = dict(base)
    for k, v in changes.items():
        out[k] = deep_update(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def override(config, changes: Mapping):
    """A frozen dataclass with changed fields; nested dataclasses take mappings, unknown names raise."""
    known = {f.name for f in fields(config)}
    if unknown := set(changes) - known:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return replace(config, **{k: override(getattr(config, k), v) if is_dataclass(getattr(config, k)) and isinstance(v, Mapping) else v for k, v in changes.items()})


def sanitize_run_id(raw: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]+", "_", raw.strip()).strip("_") or "run"


def parse_max_features(raw: str | None) -> str | int | float | None:
    """none, sqrt, log2, a count or a share."""
    if raw is None or raw.strip().lower() in ("", "none"):
        return None
    text = raw.strip().lower()
    if text in ("sqrt", "log2"):
        return text
    return int(text) if re.fullmatch(r"\d+", text) else float(text)


def forward_slashes(path: str) -> str:
    return path.strip().strip("\"'").replace("\\", "/")


def build_runs(models: list[str], base: Mapping = {}, configs: str | list[Mapping] = ()) -> list[Run]:  # noqa: B006
    """A run a model, or one a config (a list, or its JSON): keys model, run_id and params. Unknown keys or models, and a (model, run_id) given twice, raise."""
    items = json.loads(configs) if isinstance(configs, str) else list(configs)
    runs = []
    for item in items or [{"model": m} for m in models]:
        if unknown := set(item) - {"model", "run_id", "params"}:
            raise ValueError(f"unknown run settings: {sorted(unknown)}")
        for m in [item["model"]] if "model" in item else models:
            if m not in MODELS:
                raise ValueError(f"unknown model {m}")
            runs.append(Run(m, deep_update(base, item.get("params", {})), sanitize_run_id(str(item.get("run_id", "base")))))
    if len({(r.model, r.run_id) for r in runs}) < len(runs):
        raise ValueError("a model and run id is given twice")
    return runs


def minimum_samples(train: int, holdout: int, folds: int) -> None:
    """Raises where the training rows are under max(200, 20 folds) or the held-out ones under 100."""
    if train < max(200, 20 * folds) or holdout < 100:
        raise ValueError(f"too few rows: {train} for training, {holdout} held out")
