"""Audited filters: every rule drops rows with a reason, and what was dropped stays accountable.

Stateless rules share one pass: a row's reason is the first rule it breaks. Rules that look at surviving neighbours (jumps,
isolated points) are separate window passes, as they depend on what the earlier ones left.
"""

from __future__ import annotations

import ast
import operator
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraline.functions.geo import planar
from terraline.operators.quantiles import with_percentiles

REASON = "drop_reason"


@dataclass(frozen=True)
class Rule:
    """drop: true where the row goes. A null never triggers a drop; rules that drop nulls say so in their expression."""

    reason: str
    drop: Column


@dataclass(frozen=True)
class GpsLimits:
    """Effective defaults of the cleaning stage."""

    lat: tuple[float, float] = (35.0, 45.0)
    lon: tuple[float, float] = (-10.0, 5.0)
    alt: tuple[float, float] = (0.0, 3000.0)
    speed: tuple[float, float] = (0.0, 200.0)
    max_hdop: float = 5.0
    min_fix: int = 1
    min_satellites: int = 4
    max_jump_m: float = 100.0
    neighbour_m: float = 50.0
    window: int = 2
    min_neighbours: int = 1
    quality: bool = True


def gps_rules(cfg: GpsLimits = GpsLimits(), lat="lat", lon="lon", alt="alt", speed="speed_kmh", hdop="hdop", fix="fix", sats="numsats") -> list[Rule]:
    inside = F.col(lat).between(*cfg.lat) & F.col(lon).between(*cfg.lon)
    rules = [
        Rule("gps_invalid_lat_lon", ~F.coalesce(inside, F.lit(False))),
        Rule("gps_invalid_altitude", ~F.coalesce((F.col(alt) > cfg.alt[0]) & (F.col(alt) < cfg.alt[1]), F.lit(False))),
        Rule("gps_invalid_speed", (F.col(speed) < cfg.speed[0]) | (F.col(speed) > cfg.speed[1])),
    ]
    if cfg.quality:
        rules += [
            Rule(f"gps_hdop_gt_{cfg.max_hdop}", F.col(hdop) > cfg.max_hdop),
            Rule(f"gps_fix_lt_{cfg.min_fix}", F.col(fix) < cfg.min_fix),
            Rule(f"gps_satellites_lt_{cfg.min_satellites}", F.col(sats) < cfg.min_satellites),
        ]
    return rules


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """df with drop_reason: the first rule broken, null for rows that stay."""
    return df.withColumn(REASON, F.coalesce(*[F.when(F.coalesce(r.drop, F.lit(False)), F.lit(r.reason)) for r in rules]))


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def dropped(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def filter_steps(tagged: DataFrame, rules: list[Rule], by: list[str] = []) -> DataFrame:  # noqa: B006
    """by, step, filter_name, before_rows, dropped_rows, after_rows for every rule, those that dropped nothing included."""
    counts = tagged.groupBy(*by).agg(F.count("*").alias("n"), *[F.count(F.when(F.col(REASON) == r.reason, 1)).alias(f"d{i}") for i, r in enumerate(rules)])
    gone = lambda i: reduce(lambda a, b: a + b, [F.col(f"d{j}") for j in range(i)], F.lit(0).cast("long"))
    steps = [F.struct(F.lit(i + 1).alias("step"), F.lit(r.reason).alias("filter_name"), (F.col("n") - gone(i)).alias("before_rows"), F.col(f"d{i}").alias("dropped_rows"), (F.col("n") - gone(i + 1)).alias("after_rows")) for i, r in enumerate(rules)]
    return counts.select(*by, F.explode(F.array(*steps)).alias("s")).select(*by, "s.*")


def jump_filter(df: DataFrame, by: list[str], order: list[str], x: str, y: str, max_jump: float) -> DataFrame:
    """Both ends of a step longer than max_jump get the reason."""
    w = Window.partitionBy(*by).orderBy(*order)
    far = lambda f: planar(F.col(x), F.col(y), f(x).over(w), f(y).over(w)) > max_jump
    return tag(df, [Rule(f"gps_jump_gt_{max_jump}m", F.coalesce(far(F.lag), F.lit(False)) | F.coalesce(far(F.lead), F.lit(False)))])


def isolated_filter(df: DataFrame, by: list[str], order: list[str], x: str, y: str, distance: float = 50.0, window: int = 2, min_neighbours: int = 1) -> DataFrame:
    """A point stays if enough of the `window` rows on either side lie within the distance (inclusive)."""
    w = Window.partitionBy(*by).orderBy(*order)
    near = [F.coalesce((planar(F.col(x), F.col(y), f(x, k).over(w), f(y, k).over(w)) <= distance).cast("int"), F.lit(0)) for f in (F.lag, F.lead) for k in range(1, window + 1)]
    return tag(df, [Rule("gps_isolated_point", reduce(lambda a, b: a + b, near) < min_neighbours)])


def drop_ledger(dropped_rows: DataFrame, stage: str, source_key: str, **metadata: Column) -> DataFrame:
    """source_key, stage, reason, metadata and all source columns; those named like one of the former give way."""
    taken = {REASON, "source_key", "stage", "reason", *metadata}
    return dropped_rows.select(F.col(source_key).cast("string").alias("source_key"), F.lit(stage).alias("stage"), F.col(REASON).alias("reason"), *[v.alias(k) for k, v in metadata.items()], *[c for c in dropped_rows.columns if c not in taken])


def union_ledgers(*ledgers: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ledgers)


def drop_summary(ledger: DataFrame) -> DataFrame:
    """Rows and percent of all by stage and reason; nulls are a group of their own."""
    n = ledger.groupBy("stage", "reason").agg(F.count("*").alias("dropped_rows"))
    total = ledger.agg(F.count("*").alias("total"))
    return n.crossJoin(F.broadcast(total)).select("stage", "reason", "dropped_rows", (100.0 * F.col("dropped_rows") / F.col("total")).alias("pct"))  # one row is joined


def observed_range(ledger: DataFrame, value: str) -> DataFrame:
    return ledger.groupBy("reason").agg(F.count("*").alias("n"), F.format_string("[%.4f, %.4f]", F.min(value), F.max(value)).alias("observed"))


def consecutive_dedupe(df: DataFrame, by: list[str], order: list[str], keys: list[Column]) -> DataFrame:
    """A row goes if its keys equal those of the row before."""
    w = Window.partitionBy(*by).orderBy(*order)
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    return df.withColumn("__k", key).withColumn("__p", F.lag("__k").over(w)).withColumn("__n", F.row_number().over(w)).where((F.col("__n") == 1) | ~F.col("__k").eqNullSafe(F.col("__p"))).drop("__k", "__p", "__n")


def first_dedupe(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def every_nth(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where((F.col("__n") - 1) % n == 0).drop("__n")


def row_slice(df: DataFrame, by: list[str], order: list[str], start: int, most: int) -> DataFrame:
    return df.withColumn("slice_idx", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).where(F.col("slice_idx").between(start, start + most - 1))


def first_n(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rn") <= n)


def seeded_sample(df: DataFrame, by: list[str], key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows of each group, the same ones every time."""
    return first_n(df, by, [F.xxhash64(F.lit(seed), key), key], n).drop("rn")


def iqr_bounds(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    q = with_percentiles(df.agg(F.count(value).alias("n")), df, F.col(value), [0.25, 0.75]).withColumnRenamed("p", "q")
    iqr = F.col("q")[1] - F.col("q")[0]
    return q.select(F.when(iqr > 0, F.col("q")[0] - k * iqr).alias("low"), F.when(iqr > 0, F.col("q")[1] + k * iqr).alias("high"))


def iqr_outliers(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """df with outlier; never true where the interquartile range is zero or null."""
    return df.crossJoin(F.broadcast(iqr_bounds(df, value, k))).withColumn("outlier", F.coalesce((F.col(value) < F.col("low")) | (F.col(value) > F.col("high")), F.lit(False))).drop("low", "high")  # one row is joined


def training_rows(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Features as doubles without nulls or NaN, a finite target."""
    found = [c for c in features if c in df.columns]
    if not found:
        raise ValueError("none of the feature columns is there")
    if target not in df.columns:
        raise ValueError(f"no target column {target}")
    out = df.select(*[F.col(c).cast("string").try_cast("double").alias(c) for c in found], F.col(target).cast("string").try_cast("double").alias(target), *[c for c in df.columns if c not in {*found, target}])
    fine = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in found])
    return out.where(fine & F.col(target).isNotNull() & ~F.isnan(target) & (F.abs(F.col(target)) < float("inf")))


def finite_or_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """All of the columns become null where any isn't finite."""
    good = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")) for c in columns])
    return df.withColumns({c: F.when(good, F.col(c)) for c in columns})


def without_internal(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def _words(text: str) -> tuple[str, list[str]]:
    """Python's reading of a condition: & and | as and/or, names in backticks as names; quoted text is left alone."""
    names: list[str] = []

    def plain(m: re.Match) -> str:
        if m["name"] is not None:
            names.append(m["name"])
            return f" __name{len(names) - 1} "
        return m["quoted"] or {"&": " and ", "|": " or "}[m["sign"][0]]

    out = re.sub(r"""(?P<quoted>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|`(?P<name>[^`]*)`|(?P<sign>&+|\|+)""", plain, text.strip())
    return out.strip(), names


_COMPARE = {"Eq": operator.eq, "NotEq": operator.ne, "Lt": operator.lt, "LtE": operator.le, "Gt": operator.gt, "GtE": operator.ge}


def predicate(text: str) -> Column:
    """A written condition as a column: comparisons (chained ones too), in and not in lists, and/or/not, &, | and ~, arithmetic,
    abs(x) and the like, names in backticks, quoted text. A null compares as nothing: false, but true for != and not in."""
    body, names = _words(text)
    known = {f"__name{i}": n for i, n in enumerate(names)}

    def compared(op: ast.cmpop, a: Column, b: ast.expr) -> Column:
        kind = type(op).__name__
        if kind in ("In", "NotIn"):
            found = F.coalesce(a.isin([value(e) for e in b.elts]), F.lit(False))
            return ~found if kind == "NotIn" else found
        return F.coalesce(_COMPARE[kind](a, column(b)), F.lit(kind == "NotEq"))

    def value(e: ast.expr):
        if isinstance(e, ast.UnaryOp) and isinstance(e.op, ast.USub):
            return -e.operand.value
        return e.value

    def column(e: ast.expr) -> Column:
        match e:
            case ast.Constant():
                return F.lit(e.value)
            case ast.Name():
                return F.col("`" + known.get(e.id, e.id).replace("`", "``") + "`")
            case ast.BoolOp():
                return reduce(operator.and_ if isinstance(e.op, ast.And) else operator.or_, map(column, e.values))
            case ast.UnaryOp(op=ast.Not() | ast.Invert()):
                return ~F.coalesce(column(e.operand), F.lit(False))
            case ast.UnaryOp(op=ast.USub()):
                return -column(e.operand)
            case ast.BinOp(op=ast.Pow()):
                return F.pow(column(e.left), column(e.right))
            case ast.BinOp(op=ast.Add() | ast.Sub() | ast.Mult() | ast.Div() | ast.Mod()):
                sign = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: F.try_divide, ast.Mod: F.try_mod}[type(e.op)]
                return sign(column(e.left), column(e.right))
            case ast.Compare():
                sides = [e.left, *e.comparators]
                return reduce(operator.and_, [compared(op, column(a), b) for op, a, b in zip(e.ops, sides, sides[1:], strict=False)])
            case ast.Call(func=ast.Name()) if not e.keywords:
                return F.call_function(e.func.id, *map(column, e.args))
        raise ValueError(f"not a condition: {text}")

    return column(ast.parse(body, mode="eval").body)


def where_text(df: DataFrame, text: str) -> DataFrame:
    """The rows that a written condition (see predicate) holds for."""
    return df.where(predicate(text))


def audit_drops(ledger: DataFrame, reason: str, contains: str | None = None, prefix: str | None = None, lat: str | None = None, lon: str | None = None) -> DataFrame:
    """Dropped rows whose reason holds a word (in any case) or begins with a prefix; with lat and lon only those at a place on earth."""
    if contains is not None:
        ledger = ledger.where(F.coalesce(F.lower(reason).contains(contains.lower()), F.lit(False)))
    if prefix is not None:
        ledger = ledger.where(F.coalesce(F.col(reason).startswith(prefix), F.lit(False)))
    for c, most in ((lat, 90), (lon, 180)):
        if c is not None:
            ledger = ledger.withColumn(c, F.col(c).try_cast("double")).where(F.col(c).between(-most, most))
    return ledger
