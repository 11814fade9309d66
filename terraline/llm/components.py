"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraline.llm import common


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> tuple[DataFrame, str | None]:
    """(v, root) for every vertex that is not its component's smallest; root is the smallest vertex reachable.

    A hub's neighbours are reduced by a partial minimum and joined back, so no task gathers a neighbourhood. Every round is
    a table in the shared folder; the previous one is deleted. Self links are ignored; no link at all gives an empty frame.
    """
    spark = edges.sparkSession
    cur, path = common.materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "cc")
    mark = _mark(cur)
    while mark[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        cur, new = common.materialize(small, "cc")
        common.discard(spark, path)
        path, before, mark = new, mark, _mark(cur)
        if mark == before:
            break
    return cur.select(F.col("u").alias("v"), F.col("v").alias("root")), path
