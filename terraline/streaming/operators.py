"""Structured Streaming forms of the stateless rules, the tolerance join, tumbling drop counters, time-gap sessions and the ring mean.

The batch pipeline has no streaming side; these are extensions over the same expressions, so batch and stream give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from terraline.operators.filters import REASON, Rule, tag


def rule_filter(stream: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every row with its drop_reason (null: it stays); stateless."""
    return tag(stream, rules)


def tolerance_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, tolerance: str = "1 second", delay: str = "10 seconds") -> DataFrame:
    """All pairs of one key whose times differ by the tolerance at most, with watermarks on both sides, so that state is bounded.
    Column names must differ but for the key. The nearest of a left row's partners is a min_by downstream."""
    l_ = left.withWatermark(left_time, delay).alias("l")
    r = right.withWatermark(right_time, delay).alias("r")
    gap = F.expr(f"INTERVAL {tolerance}")
    on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col(right_time) >= F.col(left_time) - gap) & (F.col(right_time) <= F.col(left_time) + gap)
    return l_.join(r, on).drop(F.col(f"r.{key}"))


def nearest_of_pairs(pairs: DataFrame, left_id: str, left_time: str, right_time: str, right_id: str) -> DataFrame:
    """The nearest partner of each left row, the earlier on ties; for pairs at rest (foreachBatch or a table)."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return pairs.groupBy(left_id).agg(F.min_by(F.struct("*"), F.struct(F.abs(us(left_time) - us(right_time)), us(right_time), -F.col(right_id))).alias("m")).select("m.*")


def drop_counts(tagged: DataFrame, time: str, window: str = "1 minute", delay: str = "1 minute") -> DataFrame:
    """Dropped rows by tumbling window and reason."""
    return tagged.where(F.col(REASON).isNotNull()).withWatermark(time, delay).groupBy(F.window(time, window), REASON).agg(F.count("*").alias("n"))


def gap_sessions(stream: DataFrame, key: str, time: str, gap: str, delay: str = "1 minute") -> DataFrame:
    """Segments that end where a key is silent for the gap: start, end and rows."""
    s = F.session_window(time, gap)
    return stream.withWatermark(time, delay).groupBy(F.col(key), s).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def ring_mean(stream: DataFrame, key: str, order: str, value: str, window: int) -> DataFrame:
    """Mean over a ring of the last `window` values of each key; the ring is the state (window numbers). Rows of a batch are taken in order."""
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ring = list(state.get[0]) if state.exists else [0.0] * window
        for pdf in [pd.concat(list(frames)).sort_values(order)]:
            means = []
            for v in pdf[value]:
                ring = [*ring[1:], float(v)]
                means.append(sum(ring) / window)
            state.update((ring,))
            yield pd.DataFrame({key: k[0], order: pdf[order].to_numpy(), "ring_mean": means})

    return stream.select(key, order, value).groupBy(key).applyInPandasWithState(step, f"{key} {kinds[key]}, {order} {kinds[order]}, ring_mean double", "ring array<double>", "append", GroupStateTimeout.NoTimeout)
