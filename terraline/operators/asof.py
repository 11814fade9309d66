"""Nearest-in-time join by one union and two window scans: one shuffle on the key and a stretch of time, no nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A stretch of time is so many tolerances long, and not under LEAST_US: one right row in eight, at most, stands in two stretches.
STRETCH, LEAST_US = 16, 3_600_000_000


def nearest_asof(left: DataFrame, right: DataFrame, by: list[str], on: str, tolerance_us: int, right_cols: list[str], tiebreak: str, how: str = "inner", suffix: str = "_r") -> DataFrame:
    """For every left row the right row of the same key that is nearest in time, within the tolerance (inclusive).

    An equidistant pair goes to the earlier right row; of equal right times the last by `tiebreak` counts. how: "inner" drops
    left rows without a partner, "left" keeps them. on is a timestamp_ntz column; right columns come back with the suffix, and
    the right time as on + suffix.

    Windows run within a key and a stretch of time, to which the right rows less than a tolerance away are copied, so that a
    key with most of the rows is not one task.
    """
    wide = max(STRETCH * tolerance_us, LEAST_US)
    stretch = lambda t: t - F.pmod(t, F.lit(wide).cast("long"))
    micros = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {c})")
    payload = F.struct(*[F.col(on).alias(on + suffix), *[F.col(c).alias(c + suffix) for c in right_cols]])
    r = right.where(F.col(on).isNotNull()).select(*by, micros(on).alias("__t"), F.lit(0).alias("__side"), F.col(tiebreak).alias("__tie"), payload.alias("__r"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("__l"))
    whole = left.select(F.struct("*").alias("__l"), "*")
    l_ = whole.select(*by, micros(on).alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast(r.schema["__tie"].dataType).alias("__tie"), F.lit(None).cast(r.schema["__r"].dataType).alias("__r"), "__l")
    l_ = l_.withColumn("__k", stretch(F.col("__t")))
    r = r.withColumn("__k", F.explode(F.sequence(stretch(F.col("__t") - tolerance_us), stretch(F.col("__t") + tolerance_us), F.lit(wide).cast("long"))))
    both = r.select(*by, "__k", "__t", "__side", "__tie", "__r", "__l").unionByName(l_)
    seen = F.when(F.col("__side") == 0, F.struct(F.col("__t").alias("t"), F.col("__r").alias("r")))
    back = Window.partitionBy(*by, "__k").orderBy("__t", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    # the first of the following times, and of its rows the last by tiebreak
    ahead = Window.partitionBy(*by, "__k").orderBy(F.col("__t").desc(), F.col("__side").asc(), F.col("__tie").asc()).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__b", F.last(seen, ignorenulls=True).over(back)).withColumn("__f", F.last(seen, ignorenulls=True).over(ahead))
    db, df = F.col("__t") - F.col("__b.t"), F.col("__f.t") - F.col("__t")
    best = F.when(F.col("__b").isNotNull() & (F.col("__f").isNull() | (db <= df)), F.col("__b")).otherwise(F.col("__f"))
    near = F.when(F.abs(F.col("__t") - best["t"]) <= tolerance_us, best["r"])
    out = both.where("__side = 1").select("__l.*", near.alias("__n"))
    out = out if how == "left" else out.where(F.col("__n").isNotNull())
    return out.select(*[F.col(c) for c in left.columns], "__n.*")


def fill_from(joined: DataFrame, columns: list[str], suffix: str = "_r") -> DataFrame:
    """Existing values win, the joined ones fill nulls."""
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.col(c + suffix)))
    return joined
